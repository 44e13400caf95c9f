"""Results do not change with the number of input partitions."""

import pytest

from checks import job_queries as jobs
from checks import table_queries as tables
from checks.tables import Tables

SF_DIR = "/root/testdata/sf0.001"
BUILDS = (
    jobs.fact_voltage_weather,
    jobs.fact_consumption,
    jobs.current_client,
    jobs.frequency_trusted,
    jobs.power_factor_client,
    jobs.harmonics_vs_voltage,
    jobs.generation_trusted,
    tables.latest_per_zone,
    tables.iqr_band_filter,
    tables.row_index,
)


class Repartitioned(Tables):
    def __init__(self, spark, sf_dir, partitions):
        super().__init__(spark, sf_dir)
        self.partitions = partitions

    def read(self, name):
        return super().read(name).repartition(self.partitions)


@pytest.mark.parametrize("build", BUILDS, ids=lambda build: build.__name__)
def test_same_rows_for_any_partitioning(spark, build):
    results = []
    for partitions in (1, 4, 8):
        df = build(Repartitioned(spark, SF_DIR, partitions))
        results.append(sorted((tuple(row) for row in df.collect()), key=repr))
    assert results[0] and results[0] == results[1] == results[2]
