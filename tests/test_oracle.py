"""Every registered query against its oracle SQL on the smallest driver tables."""

import numbers
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.registry import ORACLE, QUERIES
from checks.tables import CUTOFF, Tables
from gridloom import schemas
from gridloom.plans import external, facts, voltage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, numbers.Number) and not isinstance(value, bool):
        return float(value)
    return value


def normalised(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_the_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    result = oracle.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = normalised(names, result.fetchall())
    assert normalised(df.columns, df.collect()) == expected
    assert expected


def test_own_types_are_those_of_the_stored_schemas(spark):
    """Queries are cast to plain types for comparison; the library's own are these."""
    t = Tables(spark, SF_DIR)
    readings = voltage.voltage_trusted(t.voltage_raw, CUTOFF)
    weather = external.weather_trusted(t.weather_documents)
    complaints = external.complaints_trusted(t.complaints_raw)
    made = {
        "VOLTAGE_TRUSTED": readings,
        "WEATHER_TRUSTED": weather,
        "COMPLAINTS_TRUSTED": complaints,
        "FACT_VOLTAGE_WEATHER": facts.voltage_weather_rows(readings, weather, complaints),
    }
    for name, table in made.items():
        wanted = [(f.name, f.dataType) for f in getattr(schemas, name).fields]
        assert [(f.name, f.dataType) for f in table.schema.fields] == wanted


def test_entry(spark):
    df = entry_point.entry(spark)
    assert not df.isEmpty()
