import gc
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators.filters import scenario_by_position
from gridloom.operators.rowindex import with_row_index
from gridloom.plans.harmonics import LAST_SCENARIO, SCENARIO_SHARES


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_numbers_follow_the_order_for_any_partitioning(spark, partitions):
    rows = [(i * 37 % 101, f"r{i}") for i in range(101)]
    df = spark.createDataFrame(rows, "k int, name string").repartition(partitions)
    got = {r.name: (r.row_id, r.n) for r in with_row_index(df, ["k"], total="n").collect()}
    expected = {name: (k + 1, 101) for k, name in rows}
    assert got == expected


def test_many_copies_spread_over_partitions_and_stay_whole(spark):
    copies = spark.range(30_000).select(F.lit(7).alias("k"))
    others = spark.range(60_000).select(F.col("id").cast("int").alias("k"))
    df = copies.union(others).repartition(8)
    numbered = with_row_index(df, ["k"], first=0)
    ids = [r.row_id for r in numbered.select("row_id").orderBy("row_id").collect()]
    assert ids == list(range(90_000))
    sevens = numbered.where("k = 7").agg(F.min("row_id"), F.max("row_id"), F.count("*")).first()
    assert tuple(sevens) == (7, 30_007, 30_001)


def test_each_kind_is_numbered_on_its_own(spark):
    rows = [("a" if i % 3 else "b", i) for i in range(60)] + [("other", 1), (None, 2)]
    df = spark.createDataFrame(rows, "kind string, k int").repartition(5)
    got = with_row_index(df, [F.col("k").desc()], total="n", kind="kind", kinds=("a", "b"))
    for kind in ("a", "b"):
        keys = sorted((k for name, k in rows if name == kind), reverse=True)
        numbered = sorted((r.row_id, r.k, r.n) for r in got.collect() if r.kind == kind)
        assert numbered == [(i, k, len(keys)) for i, k in enumerate(keys, 1)]
    assert got.where("kind = 'other' or kind is null").isEmpty()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k int")
    assert with_row_index(empty, ["k"], total="n").collect() == []


def test_calls_leave_no_folder_behind(spark):
    with_row_index(spark.range(10), ["id"]).count()
    root = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    before = {p.name for p in root.iterdir()}
    for _ in range(2):
        assert with_row_index(spark.range(100), ["id"]).count() == 100
    for _ in range(40):
        gc.collect()
        spark._jvm.System.gc()
        left = {p.name for p in root.iterdir()} - before
        if not left:
            break
        time.sleep(0.5)
    assert not left


def expected_scenarios(rows):
    n, kept = len(rows), []
    for i, row in enumerate(sorted(rows)):
        if i <= n * 2 // 5:
            wanted = "NORMAL"
        elif i <= n * 3 // 5:
            wanted = "EXCEPCIONAL"
        elif i <= n * 9 // 10:
            wanted = "TERRIVEL"
        else:
            wanted = "NORMAL"
        if row[1] == wanted:
            kept.append(row)
    return kept


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 9), st.sampled_from(["NORMAL", "EXCEPCIONAL", "TERRIVEL"])),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([1, 4]),
)
def test_positional_scenarios(spark, rows, partitions):
    df = spark.createDataFrame(rows, "instant int, scenery string").repartition(partitions)
    kept = scenario_by_position(
        df, ["instant", "scenery"], "scenery", SCENARIO_SHARES, LAST_SCENARIO
    )
    assert sorted(tuple(r) for r in kept.collect()) == expected_scenarios(rows)


@pytest.mark.parametrize("n", [1, 10, 11])
def test_positional_scenarios_at_small_sizes(spark, n):
    names = ("NORMAL", "EXCEPCIONAL", "TERRIVEL")
    rows = [(i, name) for i in range(n) for name in names][:n]
    df = spark.createDataFrame(rows, "instant int, scenery string")
    kept = scenario_by_position(
        df, ["instant", "scenery"], "scenery", SCENARIO_SHARES, LAST_SCENARIO
    )
    assert sorted(tuple(r) for r in kept.collect()) == expected_scenarios(rows)
