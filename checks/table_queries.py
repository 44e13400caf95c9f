"""Filters, aggregations, sorts and set operations."""

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.registry import query
from checks.sql import harmonics, voltage
from checks.tables import CUTOFF, HIGHEST, LOWEST, Tables
from gridloom import constants as c
from gridloom.constants import SINE_STEP
from gridloom.functions import numbers
from gridloom.functions.dates import wall_clock
from gridloom.operators import aggregates, filters, joins, sets, sketches, sorts
from gridloom.operators.quantiles import approx_quartiles as quartiles
from gridloom.operators.rowindex import with_row_index
from gridloom.plans import harmonics as harmonic_plans
from gridloom.plans import voltage as voltage_plans
from gridloom.sources.consumption import distinct_directory
from gridloom.staging import new_folder
from gridloom.streaming.latest import keep_latest, read_latest


@query("filter_equals", "SELECT event_id, value FROM events WHERE event_type = 'view'")
def filter_equals(t: Tables):
    return filters.equals(t.events, "event_type", "view").select("event_id", "value")


@query("drop_null_rows", """SELECT event_id, instant, value, "valueType", zone, scenery
       FROM telemetry WHERE value IS NOT NULL""", "telemetry")
def drop_null_rows(t: Tables):
    return filters.drop_null_rows(t.telemetry)


@query("keep_numeric", """SELECT event_id, TRY_CAST(value AS DOUBLE) AS value FROM telemetry
       WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL""", "telemetry")
def keep_numeric(t: Tables):
    return filters.keep_numeric(t.telemetry, "value").select("event_id", "value")


@query("iqr_band_filter", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice,
       CAST(floor(l_extendedprice) AS BIGINT) AS floor_l_extendedprice_imputed,
       CAST(floor(l_extendedprice) AS BIGINT) AS outlier_l_extendedprice_imputed
       FROM lineitem WHERE floor(l_extendedprice) BETWEEN
           (SELECT quantile_disc(l_extendedprice, 0.25) FROM lineitem)
       AND (SELECT quantile_disc(l_extendedprice, 0.75) FROM lineitem)""")
def iqr_band_filter(t: Tables):
    prices = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return filters.within_quartiles(prices, "l_extendedprice")


@query("drop_future_rows", """SELECT event_id, CAST(ts AS VARCHAR) AS ts FROM events
       WHERE ts <= TIMESTAMP '2024-01-20'""")
def drop_future_rows(t: Tables):
    return filters.up_to(t.events.select("event_id", "ts"), "ts", CUTOFF)


@query("filter_conjunction", """SELECT event_id, instant, TRY_CAST(value AS DOUBLE) AS value
       FROM telemetry WHERE "valueType" = 'volts' AND scenery = 'NORMAL'
       AND TRY_CAST(value AS DOUBLE) IS NOT NULL""", "telemetry")
def filter_conjunction(t: Tables):
    return voltage_plans.normal_voltage(t.telemetry).select("event_id", "instant", "value")


@query("positional_scenario_filter", harmonics("telemetry"), "telemetry")
def positional_scenario_filter(t: Tables):
    return harmonic_plans.harmonics_trusted(t.telemetry, ["event_id"])


@query("last_day_window", """SELECT event_id, CAST(ts AS VARCHAR) AS ts FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'""")
def last_day_window(t: Tables):
    return filters.last_day(t.events.select("event_id", "ts"), "ts", date(2024, 1, 15))


@query("row_index", """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id,
       o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_totalprice FROM orders""")
def row_index(t: Tables):
    picked = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return with_row_index(picked, ["o_orderdate", "o_orderkey"])


@query("sine_wave", """SELECT event_id,
       round(value * sin(2 * pi() * user_id * (i * CAST(0.01 AS DOUBLE))), 6) + 0.0 AS wave
       FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)""")
def sine_wave(t: Tables):
    """Each event's value on a wave whose time runs with the rank of the event."""
    ranked = with_row_index(t.events, ["ts", "event_id"], name="rank", first=0)
    seconds = F.col("rank") * SINE_STEP
    wave = numbers.sine_voltage(F.col("value"), F.col("user_id"), seconds)
    return ranked.select("event_id", F.round(wave, 6).alias("wave"))


@query("mean_by_zone_instant", "SELECT zone, CAST(moment AS VARCHAR) AS moment, volts FROM ("
       + voltage("2024-01-20") + ")", "voltage_raw")
def mean_by_zone_instant(t: Tables):
    readings = voltage_plans.parse_readings(t.voltage_raw).withColumn(
        "TENSAO_VALOR", numbers.one_decimal_half_even(F.col("TENSAO_VALOR"))
    )
    means = aggregates.mean_by(
        filters.up_to(readings, "DATA_HORA_GERACAO", CUTOFF),
        ["ZONA_GERACAO", "DATA_HORA_GERACAO"],
        "TENSAO_VALOR",
    )
    return means.toDF("zone", "moment", "volts")


@query("sum_by_zone", """SELECT upper(zona) AS zone, CAST(sum(populacao) AS BIGINT) AS populacao
       FROM population GROUP BY 1""", "population")
def sum_by_zone(t: Tables):
    return voltage_plans.population_by_zone(t.population)


@query("limit_violations_by_zone", """SELECT zone,
       count(*) FILTER (TRY_CAST(value AS DOUBLE) < 5) AS "BaixaTensao",
       count(*) FILTER (TRY_CAST(value AS DOUBLE) > 100) AS "AltaTensao"
       FROM telemetry WHERE "valueType" = 'volts' AND scenery = 'NORMAL'
       GROUP BY zone""", "telemetry")
def limit_violations_by_zone(t: Tables):
    readings = voltage_plans.normal_voltage(t.telemetry)
    return aggregates.limit_violations(readings, "zone", "value", LOWEST, HIGHEST)


@query("quartiles_of_runs", """SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3,
       count(value) AS rows FROM events""")
def quartiles_of_runs(t: Tables):
    """Each day's events are a run with a stored sketch; the quartiles of all come from the sketches."""
    path = new_folder(t.spark, "sketches")
    days = t.events.withColumn("day", F.to_date("ts"))
    sketches.sketched(days, "value", "day", sketches.LARGEST).write.parquet(path)
    return sketches.quartiles(sketches.merged(t.spark.read.parquet(path), sketches.LARGEST))


@query("approx_quartiles", """SELECT quantile_disc(value, 0.25) AS events_q1,
       quantile_disc(value, 0.75) AS events_q3,
       (SELECT quantile_disc(l_extendedprice, 0.25) FROM lineitem) AS lineitem_q1,
       (SELECT quantile_disc(l_extendedprice, 0.75) FROM lineitem) AS lineitem_q3
       FROM events""")
def approx_quartiles(t: Tables):
    prices = quartiles(t.lineitem, "l_extendedprice")
    return (
        quartiles(t.events, "value")
        .withColumnsRenamed({"q1": "events_q1", "q3": "events_q3"})
        .withColumn("lineitem_q1", prices.select("q1").scalar())
        .withColumn("lineitem_q3", prices.select("q3").scalar())
    )


@query("last_value_overall", """SELECT value FROM events
       ORDER BY ts DESC, event_id DESC LIMIT 1""")
def last_value_overall(t: Tables):
    return aggregates.last_value(t.events, "value", ["ts", "event_id"])


@query("latest_per_zone", """SELECT zone, arg_max(value, (instant, event_id)) AS value_harmonicas
       FROM harmonics GROUP BY zone""", "harmonics")
def latest_per_zone(t: Tables):
    trusted = harmonic_plans.harmonics_trusted(t.telemetry, ["event_id"])
    return harmonic_plans.latest_harmonic_per_zone(trusted, ["event_id"])


@query("latest_per_zone_stream", f"""SELECT zone, arg_max(TRY_CAST(value AS DOUBLE), (instant, event_id)) AS value
       FROM telemetry WHERE zone IN {c.ZONES} 
       AND TRY_CAST(value AS DOUBLE) IS NOT NULL GROUP BY zone""", "telemetry")
def latest_per_zone_stream(t: Tables):
    """Readings land the latest first; the stored table has the latest of each zone after every batch."""
    landing, path, checkpoint = (new_folder(t.spark, label) for label in ("landing", "latest", "checkpoint"))
    readings = filters.keep_numeric(t.telemetry, "value")
    for share in (2, 0, 1):
        part = readings.where(F.pmod(F.hour(F.to_timestamp("instant")), F.lit(3)) == share)
        part.write.mode("append").parquet(landing)
        landed = t.spark.readStream.schema(readings.schema).parquet(landing)
        keep_latest(landed, "value", "instant", ["event_id"], path, checkpoint)
    schema = aggregates.latest_per_zone(readings, "value", "instant", ["event_id"]).schema
    return read_latest(t.spark, path, schema)


@query("hot_instant_join", """SELECT hour, a.event_id AS first_id, b.event_id AS second_id
       FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'busy' ELSE CAST(user_id AS VARCHAR) END AS hour FROM events) a
       JOIN (SELECT event_id, CASE WHEN event_id % 4000 = 0 THEN 'busy' ELSE CAST(user_id AS VARCHAR) END AS hour
             FROM events WHERE event_id % 5 = 0) b USING (hour)""")
def hot_instant_join(t: Tables):
    """One key holds a third of the rows of a side; its rows are dealt over many tasks."""
    key, number = F.col("user_id").cast("string"), F.col("event_id")
    first = t.events.select(number.alias("first_id"), F.when(number % 3 == 0, "busy").otherwise(key).alias("hour"))
    second = t.events.where(number % 5 == 0).select(
        number.alias("second_id"), F.when(number % 4000 == 0, "busy").otherwise(key).alias("hour")
    )
    return joins.inner_join_all([first, second], ["hour"])


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(t: Tables):
    return aggregates.row_count(t.lineitem)


@query("distinct_dimension", "SELECT DISTINCT sigla, nome FROM directory", "directory")
def distinct_dimension(t: Tables):
    return distinct_directory(t.directory)


@query("sort_desc", "SELECT l_extendedprice, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem "
       "ORDER BY 1 DESC, 2 DESC, 3 DESC")
def sort_desc(t: Tables):
    picked = t.lineitem.select("l_extendedprice", "l_orderkey", "l_linenumber")
    return sorts.sort_desc(picked, "l_extendedprice", "l_orderkey", "l_linenumber")


@query("sort_asc", "SELECT CAST(ts AS VARCHAR) AS ts, event_id, value FROM events ORDER BY 1, 2")
def sort_asc(t: Tables):
    return sorts.sort_asc(t.events.select("ts", "event_id", "value"), "ts", "event_id")


@query("sort_multi_key", """SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders
       ORDER BY 1 DESC, 2 DESC, 3 DESC""")
def sort_multi_key(t: Tables):
    picked = t.orders.select("o_orderpriority", "o_totalprice", "o_orderkey")
    return sorts.sort_desc(picked, "o_orderpriority", "o_totalprice", "o_orderkey")


@query("top_k", """SELECT l_extendedprice, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem
       ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 100""")
def top_k(t: Tables):
    picked = t.lineitem.select("l_extendedprice", "l_orderkey", "l_linenumber")
    return sorts.top_k(picked, 100, "l_extendedprice", "l_orderkey", "l_linenumber")


def _slice(t: Tables, start: int, end: int):
    days = F.col("o_orderdate")
    return t.orders.where(
        (days >= wall_clock(datetime(start, 1, 1)))
        & (days < wall_clock(datetime(end, 1, 1)))
    )


@query("union_by_name", """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS customer, o_totalprice
       FROM orders WHERE year(o_orderdate) < 1999
       UNION ALL BY NAME SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders
       WHERE year(o_orderdate) BETWEEN 1998 AND 2099""")
def union_by_name(t: Tables):
    customer = F.col("o_custkey").cast("double").alias("customer")
    old = _slice(t, 1900, 1999).select("o_orderkey", customer, "o_totalprice")
    new = _slice(t, 1998, 2100).select("o_totalprice", "o_orderkey", "o_orderstatus")
    return sets.union_by_name(old, new)


@query("dedupe_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount "
       "FROM lineitem")
def dedupe_rows(t: Tables):
    return sets.distinct_rows(
        t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    )


@query("history_merge", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE year(o_orderdate) < 1999
       UNION SELECT o_orderkey, o_custkey, o_totalprice
           + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END FROM orders
       WHERE year(o_orderdate) BETWEEN 1998 AND 2099""")
def history_merge(t: Tables):
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    changed = F.col("o_totalprice") + F.when(
        F.col("o_orderstatus") == "F", 1
    ).otherwise(0)
    new = _slice(t, 1998, 2100).withColumn("o_totalprice", changed)
    return sets.history_merge(_slice(t, 1900, 1999), new, names)
