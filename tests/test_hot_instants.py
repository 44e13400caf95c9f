"""Hot instants in joins, documents that do not fit, and the latest value as a stream."""

import json
import random
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom import constants as c
from gridloom import schemas
from gridloom.operators import joins
from gridloom.operators.aggregates import latest_per_zone
from gridloom.sources import scans, weather
from gridloom.streaming.latest import keep_latest, read_latest


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, hot):
    draw = random.Random(1)
    instants = lambda n: [("hot" if draw.random() < 0.33 else f"i{draw.randrange(60)}") for _ in range(n)]
    sizes = (hot, 12, 6)
    return [
        spark.createDataFrame(
            [(None if k % 50 == 7 else i, "s", k) for k, i in enumerate(instants(n))], f"instant string, scenery string, v{j} int"
        )
        for j, n in enumerate(sizes)
    ]


def test_a_hot_instant_is_joined_in_many_parts_and_nothing_changes(spark):
    sides = frames(spark, 900)
    keys = ["instant", "scenery"]
    plain = reduce(lambda a, b: a.join(b, keys), sides)
    got = joins.inner_join_all(sides, keys, share=30)
    assert got.columns == plain.columns and listed(got) == listed(plain)
    hot = {r._key: r._parts for r in joins.hot_keys(sides[0], keys, share=30).collect()}
    key = json.dumps({"instant": "hot", "scenery": "s"}, separators=(",", ":"))
    assert hot[key] >= 9 and len(hot) <= 30
    # Its rows meet their partners in several tasks.
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        tasks = joins.inner_join_all(sides, keys, share=30).where("instant = 'hot'").select(F.spark_partition_id()).distinct()
        assert tasks.count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_small_parts_of_a_hot_instant_stay_tasks_of_their_own(spark):
    sides = frames(spark, 900)
    joined = joins.inner_join_all(sides, ["instant", "scenery"], share=30)
    # The adaptive planner merges small partitions; those of a hot key's parts make most of the result.
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert joined.where("instant = 'hot'").select(F.spark_partition_id()).distinct().count() > 3
    # The sketch has run once; both halves of the join read what it said.
    assert "top_k" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_the_pairs_of_a_hot_instant_take_little_room_in_files(spark, folder):
    rows, others = 1500, 6000
    instant = F.when(F.col("id") >= 0, "hot").otherwise(F.col("id").cast("string")).alias("instant")
    first = spark.range(rows).select(instant, (3 * F.col("id")).alias("a"))
    second = spark.range(others).select(instant, (F.col("id") * 4000).alias("b"), F.lit(None).cast("int").alias("a"))
    joined = joins.inner_join_all([first, second], ["instant"], share=2)
    assert joined.columns == ["instant", "a", "b", "a"]
    # As with frames too large to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined.toDF("instant", "a", "b", "c").write.parquet(f"{folder}/pairs")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = spark.read.parquet(f"{folder}/pairs")
    totals = stored.agg(F.count("*"), F.sum("a"), F.sum("b"), F.count("c")).first()
    sums = 3 * others * rows * (rows - 1) // 2, 4000 * rows * others * (others - 1) // 2
    assert tuple(totals) == (rows * others, *sums, 0)
    # Each row of the first frame beside all of the second, a pair took 1.58 bytes here; now it takes 0.16.
    size = sum(f.stat().st_size for f in Path(folder, "pairs").glob("*.parquet"))
    assert size < 0.3 * rows * others


@pytest.mark.parametrize("rows", [0, 5])
def test_few_rows_join_as_ever(spark, rows):
    sides = [df.limit(rows) for df in frames(spark, 20)]
    assert listed(joins.inner_join_all(sides, ["instant", "scenery"])) == listed(
        reduce(lambda a, b: a.join(b, ["instant", "scenery"]), sides)
    )


def test_documents_of_unequal_arrays_are_stored_and_counted(spark, folder):
    hours = {"time": ["t1", "t2"], "temperature_2m": [1.0, 2.0], "rain": [0.0, None], "wind_speed_10m": [3.0, 4.0]}
    rows = [hours, hours | {"rain": [0.0]}, hours | {"time": None}, {n: [] for n in hours}]
    documents = spark.createDataFrame([(r,) for r in [*rows, None]], schemas.WEATHER_DOCUMENT)
    for _ in range(2):
        good, counts = weather.fitting(documents, f"{folder}/aside", "landed")
        assert counts == {"good": 2, "bad": 2}
        assert weather.hourly_rows(good).count() == 2
        stored = scans.read_json_lines(spark, f"{folder}/aside/*", schemas.WEATHER_DOCUMENT)
        assert sorted((len(r.hourly.time or []), len(r.hourly.rain)) for r in stored.collect()) == [(0, 2), (2, 1)]
    with pytest.raises(Exception, match="different lengths"):
        weather.hourly_rows(documents).collect()


def test_batches_in_any_order_give_the_latest_value(spark, folder):
    draw = random.Random(2)
    rows = [(draw.choice([*c.ZONES[:3], "elsewhere", None]), f"2024-01-{draw.randrange(10, 30)}", k, float(k)) for k in range(90)]
    schema = "zone string, instant string, id int, value double"
    whole = latest_per_zone(spark.createDataFrame(rows, schema), "value", "instant", ["id"])
    late_first = sorted(rows, key=lambda r: r[1], reverse=True)
    for part in (late_first[:30], late_first[60:], [], late_first[30:60]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        landed = spark.readStream.schema(schema).parquet(f"{folder}/in")
        keep_latest(landed, "value", "instant", ["id"], f"{folder}/out", f"{folder}/checkpoint")
    assert listed(read_latest(spark, f"{folder}/out", whole.schema)) == listed(whole)
    assert read_latest(spark, f"{folder}/nowhere", whole.schema).count() == 0
