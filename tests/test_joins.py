from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions.flags import low_voltage
from gridloom.operators import joins
from gridloom.plans import facts


def readings(spark, rows):
    """(day, hour, zone, value) to trusted voltage rows."""
    data = [
        (date(2024, 1, d), f"{h:02d}:00", "2024-01", zone, datetime(2024, 1, d, h), value)
        for d, h, zone, value in rows
    ]
    return spark.createDataFrame(data, schemas.VOLTAGE_TRUSTED)


def complaints(spark, rows):
    data = [
        (rating, datetime(2024, 1, d, h), date(2024, 1, d), f"{h:02d}:00:00")
        for d, h, rating in rows
    ]
    return spark.createDataFrame(data, schemas.COMPLAINTS_TRUSTED)


def weather(spark, rows):
    data = [(datetime(2024, 1, d, h), t, rain, wind) for d, h, t, rain, wind in rows]
    return spark.createDataFrame(data, schemas.WEATHER_TRUSTED)


VOLTAGE = [(1, 5, "SUL", 0.0), (1, 6, "SUL", 220.0), (1, 6, "SUL", 220.0), (2, 5, "NORTE", None)]
COMPLAINTS = [(1, 9, "3"), (1, 9, "3"), (1, 10, "3"), (1, 11, "1"), (1, 12, None), (5, 1, "2")]


def naive_rating_join(voltage, complaints):
    """Reading x complaint first, dedupe afterwards."""
    joined = voltage.join(complaints, F.col("DATA_GERACAO") == F.col("DATA_RECLAMACAO"), "left")
    return (
        joined.withColumn("TENSAO_SEVERIDADE", low_voltage(F.col("TENSAO_VALOR")))
        .withColumnRenamed("AVALIACAO", "INDICE_APROVACAO")
        .drop("HORA_RECLAMACAO", "DATA_HORA_RECLAMACAO", "DATA_RECLAMACAO")
        .dropDuplicates()
    )


def as_set(df, names):
    listed = [tuple(r) for r in df.select(*names).collect()]
    assert len(set(listed)) == len(listed)
    return set(listed)


def test_rating_join_equals_the_naive_one(spark):
    v, c = readings(spark, VOLTAGE), complaints(spark, COMPLAINTS)
    got = joins.with_daily_rating(v, joins.daily_ratings(c))
    expected = naive_rating_join(v, c)
    assert as_set(got, expected.columns) == as_set(expected, expected.columns)
    assert got.count() == 2 * 3 + 1


def test_weather_join_flags_and_misses(spark):
    w = weather(
        spark,
        [(1, 5, 20.0, 25.0, 25.0), (1, 6, 20.0, 24.99, 25.0), (1, 6, 20.0, 24.99, 25.0)],
    )
    rows = facts.voltage_weather_rows(
        readings(spark, VOLTAGE), w, complaints(spark, [])
    )
    got = {
        (r.DATA_HORA_GERACAO.day, r.DATA_HORA_GERACAO.hour): (
            r.TENSAO_SEVERIDADE, r.CLIMA_CHUVA, r.CLIMA_SEVERIDADE, r.CLIMA_EVENTO, r.INDICE_APROVACAO,
        )
        for r in rows.collect()
    }
    assert got == {
        (1, 5): (True, 25.0, True, "CHUVA", None),
        (1, 6): (False, 24.99, True, "VENTO", None),
        (2, 5): (False, None, False, "SEM EVENTO", None),
    }
    assert rows.count() == 3


def test_one_join_equals_a_join_to_each_side(spark):
    hot = [(1, h % 24, f"Z{h}", float(h)) for h in range(60)] + VOLTAGE
    v, c = readings(spark, hot), complaints(spark, COMPLAINTS)
    w = weather(spark, [(d, h, 1.0, float(h), None) for d in (1, 3) for h in (0, 5, 5, 23)])
    one_by_one = joins.with_hourly_weather(
        joins.with_daily_rating(v, joins.daily_ratings(c)), joins.hourly_weather(w)
    )
    names = schemas.FACT_VOLTAGE_WEATHER.names
    got = facts.voltage_weather_rows(v, w, c)
    assert as_set(got, names) == as_set(one_by_one, names)
    assert got.count() == one_by_one.count()


def test_result_is_the_same_without_any_broadcast(spark):
    hot = [(1, h % 24, f"Z{h}", float(h)) for h in range(300)] + VOLTAGE
    v, c = readings(spark, hot), complaints(spark, COMPLAINTS)
    w = weather(spark, [(1, h, 1.0, float(h), None) for h in range(24)])
    names = schemas.FACT_VOLTAGE_WEATHER.names
    expected = as_set(facts.fact_voltage_weather(v, w, c), names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_set(facts.fact_voltage_weather(v, w, c), names) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_history_cases_of_the_fact(spark):
    v, c = readings(spark, VOLTAGE), complaints(spark, COMPLAINTS)
    names = schemas.FACT_VOLTAGE_WEATHER.names
    before = facts.fact_voltage_weather(v, weather(spark, []), c)
    late = weather(spark, [(1, 5, 1.0, 2.0, 3.0)])
    merged = facts.fact_voltage_weather(v, late, c, history=before)
    # readings of that hour stay without weather and are added with it
    assert merged.count() == before.count() + 3
    again = facts.fact_voltage_weather(v, late, c, history=merged)
    assert as_set(again, names) == as_set(merged, names)
