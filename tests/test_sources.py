import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.sources import scans, sinks
from gridloom.sources.consumption import consumption_query
from gridloom.sources.weather import hourly_rows

ROWS = [
    (1, "plain", 1.5, datetime(2024, 1, 1, 10, 11, 12, 345678)),
    (2, 'quote " ; | , \\ and  spaces ', None, datetime(2024, 1, 1)),
    (3, None, -0.1, None),
    (4, "ç á 'x'", 1e-7, datetime(1999, 12, 31, 23, 59, 59, 1)),
]
SCHEMA = "id int, text string, x double, ts timestamp_ntz"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("sep", [";", ",", "|"])
def test_csv_round_trip(spark, table, folder, sep):
    sinks.write_csv(table, f"{folder}/t", sep=sep)
    assert listed(scans.read_csv(spark, f"{folder}/t", table.schema, sep=sep)) == ROWS


def test_csv_with_other_columns_is_an_error(spark, table, folder):
    sinks.write_csv(table.select("text", "id", "x", "ts"), f"{folder}/t")
    with pytest.raises(Exception, match="CSV header"):
        scans.read_csv(spark, f"{folder}/t", table.schema).collect()


def test_json_lines_round_trip(spark, table, folder):
    sinks.write_json(table, f"{folder}/t")
    assert listed(scans.read_json_lines(spark, f"{folder}/t", table.schema)) == ROWS


def test_json_arrays_are_valid_documents(spark, table, folder):
    sinks.write_json_array(table.union(table.where("id < 0")), f"{folder}/t")
    assert listed(scans.read_json_documents(spark, f"{folder}/t", table.schema)) == ROWS
    files = [p for p in Path(folder, "t").glob("part-*") if p.stat().st_size]
    assert sum(len(json.loads(p.read_text())) for p in files) == len(ROWS)


@pytest.mark.parametrize("size", [0, 1, 349, 350, 351, 1000])
def test_json_arrays_of_many_batches(spark, folder, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        sinks.write_json_array(spark.range(0, size, 1, 1), f"{folder}/t", records_per_line=7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    back = scans.read_json_documents(spark, f"{folder}/t", spark.range(1).schema)
    assert sorted(r.id for r in back.collect()) == list(range(size))
    files = [p.read_text() for p in Path(folder, "t").glob("part-*") if p.stat().st_size]
    assert len(files) == -(-size // (7 * sinks.LINES_PER_FILE))
    assert sum(len(json.loads(text)) for text in files) == size


def test_sinks_keep_all_rows_unless_told_otherwise(spark, folder):
    df = spark.range(25_000)
    sinks.write_csv(df, f"{folder}/all")
    sinks.write_csv(df, f"{folder}/top", limit=10, order_by=[F.desc("id")])
    assert scans.read_csv(spark, f"{folder}/all", df.schema).count() == 25_000
    top = scans.read_csv(spark, f"{folder}/top", df.schema)
    assert sorted(r.id for r in top.collect()) == list(range(24_990, 25_000))


def test_newest_file(spark):
    files = spark.createDataFrame(
        [
            ("telemetry_1.json", datetime(2024, 1, 1)),
            ("telemetry_2.json", datetime(2024, 1, 3)),
            ("telemetry_3.json", datetime(2024, 1, 3)),
            ("other.json", datetime(2024, 1, 9)),
        ],
        "key string, modificationTime timestamp",
    ).withColumn("path", F.concat(F.lit("telemetry_zone/"), "key"))
    assert scans.newest_file(files, "telemetry_").first().path == "telemetry_zone/telemetry_3.json"
    assert scans.newest_file(files).first().path == "telemetry_zone/other.json"
    assert scans.newest_file(files, "nothing").first().path is None


def test_latest_file_and_table(spark, folder):
    Path(folder, "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        scans.latest_file(spark, f"{folder}/empty", "x")
    for hour, size in ((1, 3), (2, 5)):
        df = spark.range(size).withColumn("m", F.lit("2024-01"))
        stamp = datetime(2024, 1, 1, hour)
        sinks.publish(df, f"{folder}/zone", "consumo/Fato", stamp, partition_by="m")
    sinks.publish(spark.range(9), f"{folder}/zone", "outro", datetime(2024, 1, 1))
    path = scans.latest_table(spark, f"{folder}/zone", "consumo/Fato")
    assert path.endswith("consumo/Fato/run=20240101T020000000000")
    assert spark.read.parquet(path).count() == 5
    assert scans.latest_table(spark, f"{folder}/zone", "missing") is None


def test_newest_table_goes_by_its_own_name_and_finished_runs(spark, folder):
    zone = f"{folder}/TRUSTED_clima_zone"
    first = sinks.publish(spark.range(2), zone, "TRUSTED_clima1", datetime(2024, 1, 1))
    sinks.publish(spark.range(3), zone, "Tensao_TRUSTED_1", datetime(2024, 1, 2))
    half = sinks.publish(spark.range(4), zone, "TRUSTED_clima1", datetime(2024, 1, 3))
    Path(half, "_SUCCESS").unlink()
    assert scans.latest_table(spark, zone, "TRUSTED_clima").endswith(first)
    newest = scans.latest_file(spark, zone, "TRUSTED_clima1")
    assert "/TRUSTED_clima1/run=20240103" in newest


def test_csv_keeps_line_breaks_quotes_empty_text_and_null(spark, folder):
    rows = [(1, 'a\n;"b"\r\n'), (2, ""), (3, None), (4, "\\ N"), (5, '"'), (6, " x ")]
    df = spark.createDataFrame(rows, "k int, t string")
    sinks.write_csv(df, f"{folder}/t", null_text="\\N")
    back = scans.read_csv(spark, f"{folder}/t", df.schema, free_text=True, null_text="\\N")
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_missing_history_starts_empty_and_other_errors_stay(spark, folder):
    empty = scans.read_table_or_empty(spark, None, schemas.FACT_CONSUMPTION)
    assert empty.columns == schemas.FACT_CONSUMPTION.names and empty.isEmpty()
    with pytest.raises(Exception):
        scans.read_table_or_empty(spark, f"{folder}/no", schemas.FACT_CONSUMPTION).count()


def document(**arrays):
    return json.dumps({"hourly": arrays})


def test_hourly_arrays(spark, folder):
    Path(folder, "w.json").write_text(
        document(
            time=["2024-01-01T00:00", "2024-01-01T01:00"],
            temperature_2m=[1.25, None],
            rain=[0.0, 25.0],
            wind_speed_10m=[3.0, 4.0],
        )
    )
    docs = scans.read_json_documents(spark, f"{folder}/w.json", schemas.WEATHER_DOCUMENT)
    assert [tuple(r) for r in hourly_rows(docs).orderBy("time").collect()] == [
        ("2024-01-01T00:00", 1.25, 0.0, 3.0),
        ("2024-01-01T01:00", None, 25.0, 4.0),
    ]


def test_unequal_hourly_arrays_are_an_error(spark, folder):
    Path(folder, "w.json").write_text(
        document(time=["a", "b"], temperature_2m=[1.0], rain=[0.0, 1.0], wind_speed_10m=[3.0, 4.0])
    )
    docs = scans.read_json_documents(spark, f"{folder}/w.json", schemas.WEATHER_DOCUMENT)
    with pytest.raises(Exception, match="different lengths"):
        hourly_rows(docs).collect()


def test_consumption_query(spark):
    consumption = spark.createDataFrame(
        [
            (2023, 1, "SP", "Comercial", 10, 1.0),
            (2023, 2, "SP", "Residencial", None, 2.0),
            (2023, 2, "SP", "Rural", 1, 2.0),
            (2022, 2, "SP", "Industrial", 1, 2.0),
            (2023, 2, "RJ", "Industrial", 1, 2.0),
        ],
        schemas.CONSUMPTION,
    )
    twice = spark.createDataFrame([("SP", "São Paulo")] * 2, schemas.STATE_DIRECTORY)
    got = consumption_query(consumption, twice).orderBy("mes").collect()
    assert [tuple(r)[1:5] for r in got] == [
        (1, "SP", "Comercial", 10), (2, "SP", "Residencial", None),
    ]
    missing = spark.createDataFrame([("RJ", "Rio")], schemas.STATE_DIRECTORY)
    assert consumption_query(consumption, missing).isEmpty()
