"""Rules on the shape of the code and of the physical plans."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from gridloom.operators import filters
from gridloom.plans import external, facts, voltage
from checks.registry import QUERIES
from checks.tables import CUTOFF, Tables

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.001"


def sources():
    return {p: p.read_text() for p in (ROOT / "gridloom").rglob("*.py") if p.parent.name != "llm"}


@pytest.mark.parametrize(
    "banned", ["toPandas", "localCheckpoint", r"\.rdd\b", "crossJoin", "F.udf", "toLocalIterator"]
)
def test_not_used_in_the_package(banned):
    assert [p.name for p, text in sources().items() if re.search(banned, text)] == []


def test_the_only_collect_is_bounded():
    lines = [
        line.strip()
        for text in sources().values()
        for line in text.splitlines()
        if ".collect()" in line
    ]
    assert lines == [
        "months = [row[0] for row in batch.select(month).distinct().collect()]"
    ]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return physical(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name, columns, pushed",
    [
        ("filter_equals", {"event_id", "event_type", "value"}, "EqualTo(event_type,view)"),
        ("drop_future_rows", {"event_id", "ts"}, "LessThanOrEqual(ts,"),
        ("last_day_window", {"event_id", "ts"}, "GreaterThanOrEqual(ts,"),
        ("project_columns", {"o_orderkey", "o_totalprice"}, "PushedFilters: []"),
        ("mean_by_zone_instant", {"ts", "user_id", "event_type", "value"}, "EqualTo(event_type,click)"),
    ],
)
def test_pushdown_and_pruning(spark, name, columns, pushed):
    plan = physical(entry_point.queries()[name](spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == columns
    assert pushed in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_readings_are_shuffled_once_by_their_own_key(spark):
    """The joins to ratings and weather add no shuffle of the readings."""
    t = Tables(spark, SF_DIR)
    readings = voltage.voltage_trusted(t.voltage_raw, CUTOFF)
    joined = facts.voltage_weather_rows(
        readings,
        external.weather_trusted(t.weather_documents),
        external.complaints_trusted(t.complaints_raw),
    )
    plan = executed(joined)
    assert "SortMergeJoin" not in plan
    assert len(re.findall(r"hashpartitioning\(ZONA_GERACAO#\d+, DATA_HORA_GERACAO#\d+", plan)) == 1
    assert not re.search(r"hashpartitioning\(DATA_GERACAO", plan)


def test_without_broadcast_one_join_shuffles_the_readings_once_more(spark):
    t = Tables(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = facts.voltage_weather_rows(
            voltage.voltage_trusted(t.voltage_raw, CUTOFF),
            external.weather_trusted(t.weather_documents),
            external.complaints_trusted(t.complaints_raw),
        )
        plan = executed(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    by_day_and_hour = r"hashpartitioning\(DATA_GERACAO#\d+, hour\(DATA_HORA_GERACAO#\d+"
    assert len(re.findall(by_day_and_hour, plan)) == 1
    assert not re.search(r"hashpartitioning\(DATA_GERACAO#\d+, \d+\)", plan)


def test_quartiles_run_nothing_while_the_plan_is_built(spark):
    jobs = spark.sparkContext.statusTracker()
    t = Tables(spark, SF_DIR)
    prices = t.lineitem.select("l_extendedprice")
    spark.sparkContext.setJobGroup("quartiles", "plan only")
    filters.within_quartiles(prices, "l_extendedprice")
    assert len(jobs.getJobIdsForGroup("quartiles")) == 0
    spark.sparkContext.setJobGroup("rest", "")


def test_top_k_does_not_sort_the_table(spark):
    assert "TakeOrderedAndProject" in physical(entry_point.queries()["top_k"](spark, SF_DIR))


def test_means_combine_before_the_shuffle(spark):
    plan = physical(entry_point.queries()["mean_by_zone_instant"](spark, SF_DIR))
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("partial_count")
