"""Projections and scalar functions."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.sql import single, two
from checks.tables import Tables, instant_text, ts_text
from gridloom.functions import dates, flags, numbers, text
from gridloom.operators import columns


@query("drop_columns", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, value FROM events")
def drop_columns(t: Tables):
    return columns.drop_columns(t.events, "user_id", "event_type", "props")


@query("add_constant", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, "
       "CAST(n_regionkey AS BIGINT) AS n_regionkey, c_custkey, 'BR' AS pais "
       "FROM customer JOIN nation ON c_nationkey = n_nationkey")
def add_constant(t: Tables):
    joined = t.customer.select("c_custkey", "c_nationkey").join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return columns.add_constant(joined.drop("c_nationkey"), "pais", "BR")


@query("rename_columns", """SELECT c_custkey AS cliente, c_name AS nome, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       c_acctbal AS saldo, c_mktsegment FROM customer""")
def rename_columns(t: Tables):
    names = {"c_custkey": "cliente", "c_name": "nome", "c_acctbal": "saldo"}
    return columns.rename(t.customer, names)


@query("project_alias", """SELECT CAST(ts AS VARCHAR) AS instant, value AS value_fator,
       event_type AS "valueType_fator" FROM events""")
def project_alias(t: Tables):
    return columns.project_as(
        t.events,
        {"ts": "instant", "value": "value_fator", "event_type": "valueType_fator"},
    )


@query("project_columns", "SELECT o_totalprice, o_orderkey FROM orders")
def project_columns(t: Tables):
    return columns.project(t.orders, "o_totalprice", "o_orderkey")


@query("replace_value", """SELECT event_id,
       CASE WHEN event_type = 'view' THEN 'Ampere' ELSE event_type END AS event_type
       FROM (SELECT event_id, nullif(event_type, 'error') AS event_type FROM events)""")
def replace_value(t: Tables):
    kinds = t.events.select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return columns.replace_value(kinds, "event_type", "view", "Ampere")


@query("uppercase_all", """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
       upper(p_type) AS p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def uppercase_all(t: Tables):
    return columns.uppercase_strings(t.read("part"))


@query("cast_columns", """SELECT event_id, CAST(trunc(value) AS BIGINT) AS value,
       TRY_CAST(props AS DOUBLE) AS props FROM events""")
def cast_columns(t: Tables):
    picked = t.events.select("event_id", "value", "props")
    return columns.cast_columns(picked, {"value": "bigint", "props": "double"})


@query("fill_null_zero", """SELECT event_id, event_type, coalesce(value, 0) AS value,
       coalesce(user_id, 0) AS user_id
       FROM (SELECT event_id, nullif(event_type, 'view') AS event_type,
                    CASE WHEN value >= 1 THEN value END AS value,
                    nullif(user_id, 7) AS user_id FROM events)""")
def fill_null_zero(t: Tables):
    return columns.fill_null_numbers(
        t.events.select(
            "event_id",
            F.nullif("event_type", F.lit("view")).alias("event_type"),
            F.when(F.col("value") >= 1, F.col("value")).alias("value"),
            F.nullif("user_id", F.lit(7)).alias("user_id"),
        )
    )


@query("format_two_decimals", f"""SELECT event_id, {two('value / 16')} AS value,
       {two('value * 1000')} AS thousands, {two(single('value / 10'))} AS tenth FROM events""")
def format_two_decimals(t: Tables):
    value = F.col("value")
    return t.events.select(
        "event_id",
        numbers.two_decimals(value / 16).alias("value"),
        numbers.two_decimals(value * 1000).alias("thousands"),
        numbers.two_decimals_single(value / 10).alias("tenth"),
    )


@query("round_half_up", "SELECT event_id, round(value, 1) AS value FROM events")
def round_half_up(t: Tables):
    return t.events.select(
        "event_id", numbers.one_decimal_half_up(F.col("value")).alias("value")
    )


@query("round_half_even", "SELECT event_id, round_even(value, 1) AS value FROM events")
def round_half_even(t: Tables):
    return t.events.select(
        "event_id", numbers.one_decimal_half_even(F.col("value")).alias("value")
    )


@query("derived_currents", """SELECT event_id,
       CAST(trunc(CAST(amperes AS FLOAT) * CAST(160 AS FLOAT)) AS BIGINT) AS primary_current,
       CAST(trunc(CAST(CAST(volts AS FLOAT) AS DOUBLE) / 40) AS BIGINT) AS short_circuit_current
       FROM (SELECT event_id, round(value, 1) AS amperes, round(value * 60, 1) AS volts
             FROM events)""")
def derived_currents(t: Tables):
    amperes = numbers.one_decimal_half_up(F.col("value"))
    volts = numbers.one_decimal_half_up(F.col("value") * 60)
    return t.events.select(
        "event_id",
        numbers.primary_current(amperes).alias("primary_current"),
        numbers.short_circuit_current(volts).alias("short_circuit_current"),
    )


@query("severity_flags", """SELECT event_id, coalesce(v - 20 <= 0, false) AS low,
       coalesce(v >= 25, false) OR coalesce(user_id >= 25, false) AS severe
       FROM (SELECT event_id, user_id, CASE WHEN value >= 1 THEN value END AS v FROM events)""")
def severity_flags(t: Tables):
    value = F.when(F.col("value") >= 1, F.col("value"))
    return t.events.select(
        "event_id",
        flags.low_voltage(value - 20).alias("low"),
        flags.severe_weather(value, F.col("user_id")).alias("severe"),
    )


@query("weather_event_label", """SELECT event_id, CASE WHEN v >= 25 THEN 'CHUVA'
       WHEN user_id >= 25 THEN 'VENTO' ELSE 'SEM EVENTO' END AS event
       FROM (SELECT event_id, user_id, CASE WHEN value >= 1 THEN value END AS v FROM events)""")
def weather_event_label(t: Tables):
    rain = F.when(F.col("value") >= 1, F.col("value"))
    return t.events.select(
        "event_id", flags.weather_event(rain, F.col("user_id")).alias("event")
    )


@query("parse_timestamp", f"""SELECT event_id, CAST(TRY_CAST(
       CASE event_type WHEN 'click' THEN {"replace(CAST(ts AS VARCHAR), ' ', 'T')"}
            WHEN 'view' THEN substr(CAST(ts AS VARCHAR), 1, 10)
            WHEN 'error' THEN props ELSE CAST(ts AS VARCHAR) END
       AS TIMESTAMP) AS VARCHAR) AS at FROM events""")
def parse_timestamp(t: Tables):
    kind = F.col("event_type")
    written = (
        F.when(kind == "click", instant_text())
        .when(kind == "view", F.substring(ts_text(), 1, 10))
        .when(kind == "error", F.col("props"))
        .otherwise(ts_text())
    )
    return t.events.select("event_id", dates.parse_timestamp(written).alias("at"))


@query("date_parts", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m') AS month, strftime(ts, '%H:%M') AS minute FROM events""")
def date_parts(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dates.date_text(ts).alias("day"),
        dates.year_month(ts).alias("month"),
        dates.hour_minute(ts).alias("minute"),
    )


@query("hour_bucket", "SELECT event_id, strftime(ts, '%Y-%m-%d %H') AS hour FROM events")
def hour_bucket(t: Tables):
    return t.events.select("event_id", dates.hour_bucket(F.col("ts")).alias("hour"))


@query("split_iso_instant", """SELECT event_id, nullif(split_part(x, 'T', 1), '') AS day,
       nullif(substr(split_part(x, 'T', 2), 1, 8), '') AS time,
       nullif(split_part(x, 'T', 1), '') || ' '
           || nullif(substr(split_part(x, 'T', 2), 1, 8), '') AS day_time
       FROM (SELECT event_id, CASE event_type
                 WHEN 'click' THEN replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z'
                 WHEN 'view' THEN substr(CAST(ts AS VARCHAR), 1, 10)
                 ELSE replace(CAST(ts AS VARCHAR), ' ', 'T') END AS x FROM events)""")
def split_iso_instant(t: Tables):
    kind = F.col("event_type")
    instant = (
        F.when(kind == "click", F.concat(instant_text(), F.lit("Z")))
        .when(kind == "view", F.substring(ts_text(), 1, 10))
        .otherwise(instant_text())
    )
    return t.events.select(
        "event_id",
        dates.iso_date(instant).alias("day"),
        dates.iso_time(instant).alias("time"),
        dates.iso_date_time(instant).alias("day_time"),
    )


@query("truncate_fraction", """SELECT event_id, split_part(CASE event_type
       WHEN 'click' THEN CAST(ts AS VARCHAR) ELSE substr(CAST(ts AS VARCHAR), 1, 19) END,
       '.', 1) AS instant FROM events""")
def truncate_fraction(t: Tables):
    instant = F.when(F.col("event_type") == "click", ts_text()).otherwise(
        F.substring(ts_text(), 1, 19)
    )
    return t.events.select(
        "event_id", dates.truncate_fraction(instant).alias("instant")
    )


@query("day_period", """SELECT event_id, CASE WHEN h < 5 THEN 'Madrugada' WHEN h < 11 THEN 'Manhã'
       WHEN h < 14 THEN 'Meio dia' WHEN h < 16 THEN 'Início da tarde'
       WHEN h < 18 THEN 'Fim da tarde' ELSE 'Noite' END AS period
       FROM (SELECT event_id, hour(ts) AS h FROM events)""")
def day_period(t: Tables):
    return t.events.select("event_id", dates.day_period(F.hour("ts")).alias("period"))


@query("year_month_key", """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-'
       || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month FROM orders""")
def year_month_key(t: Tables):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return t.orders.select(
        "o_orderkey", dates.year_month_key(year, month).alias("month")
    )


@query("compose_timestamp_text", """SELECT event_id,
       strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M') || ':00.00000' AS at
       FROM events""")
def compose_timestamp_text(t: Tables):
    ts = F.col("ts")
    composed = dates.compose_timestamp_text(dates.date_text(ts), dates.hour_minute(ts))
    return t.events.select("event_id", composed.alias("at"))


@query("strip_accents_upper", """SELECT doc_id,
       upper(replace(strip_accents(text), 'ß', 'SS')) AS text FROM documents""")
def strip_accents_upper(t: Tables):
    return t.read("documents").select(
        "doc_id", text.strip_accents_upper(F.col("text")).alias("text")
    )
