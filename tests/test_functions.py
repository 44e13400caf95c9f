import random
import unicodedata
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import dates, flags, numbers, text


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [row[0] for row in df.select(column).collect()]


def test_two_decimals_rounds_the_binary_value_half_to_even(spark):
    got = values(
        spark,
        [0.125, 0.375, 2.675, 22000.45, 1234567.891, -0.125, None],
        "x double",
        numbers.two_decimals(F.col("x")),
    )
    assert got == [0.12, 0.38, 2.67, 22000.45, 1234567.89, -0.12, None]


def test_two_decimals_keeps_nan(spark):
    got = values(spark, [float("nan")], "x double", numbers.two_decimals(F.col("x")))
    assert got[0] != got[0]


def test_one_decimal_both_ways(spark):
    rows = [0.25, 0.35, 0.15, 22000.45, None]
    even = values(spark, rows, "x double", numbers.one_decimal_half_even(F.col("x")))
    up = values(spark, rows, "x double", numbers.one_decimal_half_up(F.col("x")))
    assert even == [0.2, 0.4, 0.2, 22000.4, None]
    assert up == [0.3, 0.4, 0.2, 22000.5, None]


def test_as_number_turns_junk_into_null(spark):
    got = values(spark, ["x", None, "1.5", "", "1e3"], "x string", numbers.as_number(F.col("x")))
    assert got == [None, None, 1.5, None, 1000.0]


def test_currents_truncate(spark):
    got = values(spark, [0.1, 12.3, 64.1], "x double", numbers.primary_current(F.col("x")))
    assert got == [16, 1968, 10256]
    got = values(spark, [79.9, 80.0, -79.9], "x double", numbers.short_circuit_current(F.col("x")))
    assert got == [1, 2, -1]


def test_day_periods_cover_the_day(spark):
    got = values(spark, [*range(24), None], "h int", dates.day_period(F.col("h")))
    assert got.pop() is None
    assert got == (
        ["Madrugada"] * 5 + ["Manhã"] * 6 + ["Meio dia"] * 3
        + ["Início da tarde"] * 2 + ["Fim da tarde"] * 2 + ["Noite"] * 6
    )


@pytest.mark.parametrize(
    "instant, day, time",
    [
        ("2024-01-01T10:11:12.500Z", "2024-01-01", "10:11:12"),
        ("2024-01-01T10:11:12", "2024-01-01", "10:11:12"),
        ("2024-01-01", "2024-01-01", None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_iso_instant_parts(spark, instant, day, time):
    x = F.col("x")
    row = (
        spark.createDataFrame([(instant,)], "x string")
        .select(dates.iso_date(x), dates.iso_time(x), dates.iso_date_time(x))
        .first()
    )
    both = f"{day} {time}" if day and time else None
    assert tuple(row) == (day, time, both)


def test_date_parts_do_not_depend_on_the_session_time_zone(spark):
    gap = datetime(2024, 3, 31, 2, 30)  # does not exist in Berlin
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        ts = F.col("ts")
        row = (
            spark.createDataFrame([(gap,)], "ts timestamp_ntz")
            .select(
                dates.date_text(ts),
                dates.year_month(ts),
                dates.hour_minute(ts),
                dates.hour_bucket(ts),
                F.hour(ts),
            )
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2024-03-31", "2024-03", "02:30", "2024-03-31 02", 2)


def test_parse_timestamp(spark):
    got = values(
        spark,
        ["2024-01-01T10:11:12.500", "2024-01-01 10:11:12", "2024-01-01T05:00", "x", None],
        "x string",
        dates.parse_timestamp(F.col("x")),
    )
    assert got == [
        datetime(2024, 1, 1, 10, 11, 12, 500000),
        datetime(2024, 1, 1, 10, 11, 12),
        datetime(2024, 1, 1, 5),
        None,
        None,
    ]


def test_text_dates(spark):
    month = dates.year_month_key(F.col("a"), F.col("m"))
    assert values(spark, [(2023, 1), (2023, 12), (2023, None)], "a int, m int", month) == [
        "2023-01", "2023-12", None,
    ]
    cut = dates.truncate_fraction(F.col("x"))
    assert values(spark, ["a.b.c", "2024-01-01T00:00:07", None], "x string", cut) == [
        "a", "2024-01-01T00:00:07", None,
    ]
    full = dates.compose_timestamp_text(F.col("d"), F.col("h"))
    assert values(spark, [("2024-01-01", "10:30")], "d string, h string", full) == [
        "2024-01-01 10:30:00.00000"
    ]


def test_flags_are_never_null(spark):
    nan = float("nan")
    low = values(spark, [0.0, -1.0, 0.1, None, nan], "x double", flags.low_voltage(F.col("x")))
    assert low == [True, True, False, False, False]
    rows = [(25.0, 25.0), (24.99, 25.0), (24.99, 24.99), (None, 30.0), (nan, nan), (None, None)]
    schema = "r double, w double"
    severe = values(spark, rows, schema, flags.severe_weather(F.col("r"), F.col("w")))
    event = values(spark, rows, schema, flags.weather_event(F.col("r"), F.col("w")))
    assert severe == [True, True, False, True, False, False]
    assert event == ["CHUVA", "VENTO", "SEM EVENTO", "VENTO", "SEM EVENTO", "SEM EVENTO"]


def bare(s):
    return "".join(
        ch for ch in unicodedata.normalize("NFD", s) if not "̀" <= ch <= "ͯ"
    ).upper()


def test_accents(spark):
    rows = ["Início da manhã às três", "ÀÉÎÕÜ çñ", "straße", "Ёлка й", "ώρα", "é", "ǘ ṩ", "", None]
    expected = [None if r is None else bare(r) for r in rows]
    assert values(spark, rows, "x string", text.strip_accents_upper(F.col("x"))) == expected
    any_script = [*rows, "각 が"]
    expected.append(bare("각 が"))
    assert (
        values(spark, any_script, "x string", text.strip_accents_upper_any_script(F.col("x")))
        == expected
    )


def test_halves_round_as_in_single_precision(spark):
    single = numbers.as_number(F.col("x"), numbers.SINGLE)
    for rounded in (numbers.two_decimals(single), numbers.two_decimals_single(single)):
        got = values(spark, ["0.155", "0.145", "junk", "0.125", "-0.375"], "x string", rounded)
        assert got == [0.16, 0.14, None, 0.12, -0.38]


def test_single_precision_rounding_needs_no_text(spark):
    rng = random.Random(7)
    numbers_in = [rng.uniform(-1, 1) * 10 ** rng.randint(-4, 9) for _ in range(20_000)]
    numbers_in += [round(rng.uniform(-500, 500), 3) for _ in range(20_000)]
    numbers_in += [i / 8 for i in range(-4000, 4000)]
    numbers_in += [float("inf"), float("-inf"), 0.0, -0.0, 3.4e38, 1e-40]
    x = F.col("x").cast(numbers.SINGLE)
    df = spark.createDataFrame([(v,) for v in numbers_in], "x double").select(
        numbers.two_decimals(x).alias("text"), numbers.two_decimals_single(x).alias("number")
    )
    assert df.where(~F.col("text").eqNullSafe(F.col("number"))).collect() == []
    nan = values(spark, [float("nan")], "x double", numbers.two_decimals_single(F.col("x")))
    assert nan[0] != nan[0]


def test_half_even_equals_array_rounding(spark):
    rng = random.Random(11)
    numbers_in = [round(rng.uniform(-30_000, 30_000), 2) for _ in range(20_000)]
    numbers_in += [rng.uniform(-1e9, 1e9) for _ in range(5_000)]
    got = values(spark, numbers_in, "x double", numbers.one_decimal_half_even(F.col("x")))
    assert got == list(np.round(numbers_in, 1))
