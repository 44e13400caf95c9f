"""Means and quartiles from stored parts are those of all rows at once."""

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructType

from gridloom.operators import sketches
from gridloom.operators.aggregates import mean_by
from gridloom.streaming import means

KEYS = StructType().add("zone", StringType()).add("instant", LongType())


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def readings(spark):
    draw = random.Random(1)
    rows = [
        (draw.choice(["SUL", "NORTE", None]), draw.randrange(6), draw.choice([None, 0.1, 220.3, 7.5, 1e300, 2e17]))
        for _ in range(400)
    ]
    rows = [(z, i, None if i == 5 else x if i < 3 or x is None or x < 1e6 else 1.1) for z, i, x in rows]
    return spark.createDataFrame(rows, "zone string, instant long, volts double")


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_loads_in_any_order_equal_one_load(spark, readings, folder, order):
    wanted = listed(mean_by(readings, KEYS.names, "volts").select(*KEYS.names, "volts"))
    parts = readings.selectExpr("*", "pmod(hash(*), 3) p")
    for load in (*order, order[0]):  # the first load runs again
        rows = parts.where(f"p = {load}").drop("p")
        means.store(means.partial_sums(rows, KEYS.names, "volts"), f"{folder}/sums", load)
    got = listed(means.means_of(means.read(spark, f"{folder}/sums", KEYS), KEYS.names, "volts"))
    assert [r[:2] for r in got] == [r[:2] for r in wanted]
    assert [r[2] is None for r in got] == [r[2] is None for r in wanted]
    assert [r[2] or 0.0 for r in got] == pytest.approx([r[2] or 0.0 for r in wanted], rel=1e-12)
    exact = [(g, w) for g, w in zip(got, wanted) if w[2] is not None and w[2] < 1e6]
    assert exact and all(g == w for g, w in exact)


def test_a_late_reading_amends_its_mean_after_compaction(spark, folder):
    load = lambda x, n, path: means.store(
        means.partial_sums(spark.createDataFrame([("SUL", 1, x)], "zone string, instant long, volts double"), KEYS.names, "volts"),
        path, n,
    )
    load(1.0, 1, f"{folder}/a")
    load(2.0, 2, f"{folder}/a")
    means.compact(spark, f"{folder}/a", KEYS, f"{folder}/b")
    load(6.3, 1, f"{folder}/b")
    assert listed(means.means_of(means.read(spark, f"{folder}/b", KEYS), KEYS.names, "volts")) == [("SUL", 1, 3.1)]


def test_quartiles_over_many_runs(spark):
    runs = spark.range(200_000).selectExpr("pmod(hash(id), 500) run", "cast(pmod(id * 7919, 200000) as double) x")
    stored = sketches.sketched(runs, "x", "run", k=1024)
    assert stored.count() == 500
    row = sketches.quartiles(sketches.merged(stored, k=1024, fan_in=8)).first()
    assert row.rows == 200_000
    bound = 2.3 / 1024**0.9 * 200_000
    assert abs(row.q1 - 50_000) <= bound and abs(row.q3 - 150_000) <= bound


def test_quartiles_of_few_rows_are_exact_and_of_none_null(spark):
    rows = spark.createDataFrame([(k % 3, None if k == 5 else float(k)) for k in range(40)], "run int, x double")
    row = sketches.quartiles(sketches.merged(sketches.sketched(rows, "x", "run"))).first()
    values = sorted(float(k) for k in range(40) if k != 5)
    assert (row.q1, row.q3, row.rows) == (values[9], values[29], 39)
    none = sketches.quartiles(sketches.merged(sketches.sketched(rows.limit(0), "x", "run"))).first()
    assert (none.q1, none.q3, none.rows) == (None, None, 0)
    null = sketches.quartiles(sketches.merged(sketches.sketched(rows.where("x is null"), "x", "run"))).first()
    assert (null.q1, null.q3, null.rows) == (None, None, 0)
