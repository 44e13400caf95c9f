from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregates, columns, filters, sets, sorts


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_column_edits(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "i int, s string, x double")
    assert columns.drop_columns(df, "s", "x").columns == ["i"]
    assert rows(columns.add_constant(df, "c", "k").select("c")) == [("k",), ("k",)]
    assert columns.rename(df, {"i": "id", "missing": "m"}).columns == ["id", "s", "x"]
    assert columns.project(df, "x", "i").columns == ["x", "i"]
    assert columns.project_as(df, {"s": "text", "i": "n"}).columns == ["text", "n"]
    assert rows(columns.replace_value(df, "s", "a", "b").select("s")) == [("b",), (None,)]
    assert rows(columns.uppercase_strings(df)) == [(1, "A", None), (2, None, 2.5)]
    assert rows(columns.fill_null_numbers(df)) == [(1, "a", 0.0), (2, None, 2.5)]


def test_cast_columns_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1",), ("x",), ("99999999999",)], "s string")
    got = columns.cast_columns(df, {"s": "int"})
    assert sorted(r.s or 0 for r in got.collect()) == [0, 0, 1]


def test_keep_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "value string")
    kept = [r.value for r in filters.keep_numeric(df, "value").collect()]
    assert kept[0] == 1.5 and kept[1] != kept[1] and len(kept) == 2


def test_drop_null_rows_drops_nan_too(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert rows(filters.drop_null_rows(df)) == [(1.0, "a")]


def test_time_filters(spark):
    stamps = [datetime(2024, 1, d, h) for d in range(13, 17) for h in (0, 23)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    kept = [r.ts for r in filters.last_day(df, "ts", date(2024, 1, 15)).orderBy("ts").collect()]
    assert kept == [s for s in stamps if s.day in (14, 15)]
    assert filters.up_to(df, "ts", datetime(2024, 1, 13)).count() == 1
    assert filters.up_to(df, "ts").count() == len(stamps)
    future = spark.createDataFrame([(datetime(2999, 1, 1),)], "ts timestamp_ntz")
    assert filters.up_to(future, "ts").isEmpty()


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
def test_time_filters_do_not_depend_on_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(96).selectExpr(
            "timestamp_ntz'2024-01-13 00:00:00' + make_interval(0, 0, 0, 0, id, 0, 0) as ts"
        )
        assert filters.up_to(df, "ts", datetime(2024, 1, 14)).count() == 25
        assert filters.last_day(df, "ts", date(2024, 1, 15)).count() == 48
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_above_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert rows(filters.above(df, "x", 2)) == [(3.0,)]


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_mean_is_the_same_for_any_row_order(spark, partitions):
    data = [("z", i % 7 + 0.1 * (i % 10)) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, x double").withColumn("x", F.bround("x", 1))
    got = aggregates.mean_by(df.repartition(partitions), ["k"], "x").first().x
    tenths = sum(round(round(x, 1) * 10) for _, x in data)
    assert got == tenths / (10 * len(data))


def test_mean_skips_null_values_and_null_keys(spark):
    data = [("a", 1.0), ("a", None), ("a", 2.0), ("b", None), (None, 5.0), ("c", 1e300)]
    got = aggregates.mean_by(spark.createDataFrame(data, "k string, x double"), ["k"], "x")
    assert rows(got) == [("a", 1.5), ("b", None), ("c", 1e300)]


def test_limit_violations(spark):
    data = [("a", -5.0), ("a", 5.0), ("a", 50.0), ("a", float("nan")), ("b", None), (None, 9.0)]
    df = spark.createDataFrame(data, "zone string, value double")
    got = aggregates.limit_violations(df, "zone", "value", 0, 10)
    assert rows(got) == [("a", 1, 1), ("b", 0, 0)]


def test_latest_per_zone_breaks_ties_and_skips_empty_zones(spark):
    data = [
        ("NORTE", "2024-01-01", 1, 1.0),
        ("NORTE", "2024-01-02", 2, 2.0),
        ("NORTE", "2024-01-02", 3, 3.0),
        ("SUL", "2024-01-01", 4, 4.0),
        ("ELSEWHERE", "2024-01-09", 5, 5.0),
    ]
    df = spark.createDataFrame(data, "zone string, instant string, id int, value double")
    got = aggregates.latest_per_zone(df, "value", "instant", ["id"])
    assert rows(got) == [("NORTE", 3.0), ("SUL", 4.0)]
    assert aggregates.last_value(df, "value", ["instant", "id"]).first().value == 5.0


def test_sorts(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (1, "a"), (2, "z"), (1, "a")], "k int, s string")
    asc = [tuple(r) for r in sorts.sort_asc(df, "k", "s").collect()]
    assert asc == [(1, "a"), (1, "a"), (1, "b"), (2, "z"), (3, "a")]
    assert [tuple(r) for r in sorts.sort_desc(df, "k", "s").collect()] == asc[::-1]
    assert [tuple(r) for r in sorts.top_k(df, 2, "k", "s").collect()] == [(3, "a"), (2, "z")]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "c int, a int")
    assert rows(sets.union_by_name(a, b)) == [(1, 2, None), (4, None, 3)]


HISTORY = [("2024-01", 1, None), ("2024-01", 2, 5.0)]


def test_history_merge_is_idempotent_and_keeps_changed_rows(spark):
    names = ["m", "k", "x"]
    schema = "m string, k int, x double"
    new = spark.createDataFrame([*HISTORY, ("2024-01", 2, 6.0), ("2024-01", 2, 6.0)], schema)
    history = spark.createDataFrame(HISTORY, schema)
    once = sets.history_merge(history, new, names)
    assert rows(once) == sorted([*HISTORY, ("2024-01", 2, 6.0)], key=repr)
    assert rows(sets.history_merge(once, new, names)) == rows(once)
    assert rows(sets.history_merge(None, new, names)) == rows(once)
    assert rows(sets.rows_not_in(new, history)) == [("2024-01", 2, 6.0)]
    assert sets.rows_not_in(new, once).isEmpty()
