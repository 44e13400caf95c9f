from datetime import date, datetime

from gridloom import schemas
from gridloom.plans import external, facts, harmonics, sensors, voltage


def telemetry(spark, rows):
    """(instant, value, kind, zone, scenery)"""
    return spark.createDataFrame(rows, schemas.TELEMETRY)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_voltage_trusted(spark):
    raw = spark.createDataFrame(
        [
            (0.25, "SUL", "2024-01-01T00:00:00"),
            (0.15, "SUL", "2024-01-01T00:00:00"),
            (22000.45, "NORTE", "2024-01-01T10:30:07.179"),
            (float("nan"), "NORTE", "2024-01-01T10:30:07.179"),
            (None, "LESTE", "2024-01-02 00:00:00"),
            (5.0, None, "2024-01-01T00:00:00"),
            (5.0, "SUL", "2999-01-01T00:00:00"),
            (5.0, "SUL", "not a time"),
        ],
        schemas.VOLTAGE_RAW,
    )
    got = voltage.voltage_trusted(raw, datetime(2024, 6, 1))
    assert got.columns == schemas.VOLTAGE_TRUSTED.names
    assert sorted(listed(got)) == [
        (date(2024, 1, 1), "00:00", "2024-01", "SUL", datetime(2024, 1, 1), 0.2),
        (
            date(2024, 1, 1), "10:30", "2024-01", "NORTE",
            datetime(2024, 1, 1, 10, 30, 7, 179000), 22000.4,
        ),
        (date(2024, 1, 2), "00:00", "2024-01", "LESTE", datetime(2024, 1, 2), None),
    ]


def test_weather_trusted_is_latest_first_and_numeric(spark):
    docs = spark.createDataFrame(
        [((["2024-01-01T00:00", "2024-01-01T02:00", "2024-01-01T01:00"],
           [1.255, 2.0, None], [0.125, 0.0, 1.0], [1.0, 2.0, 3.0]),)],
        schemas.WEATHER_DOCUMENT,
    )
    assert listed(external.weather_trusted(docs)) == [
        (datetime(2024, 1, 1, 2), 2.0, 0.0, 2.0),
        (datetime(2024, 1, 1, 0), 1.25, 0.12, 1.0),
    ]


def test_complaints_trusted_keeps_malformed_rows(spark):
    raw = spark.createDataFrame(
        [("Sem luz", "2024-01-01T10:11:12.500Z", "3"), ("x", "2024-01-02", None), ("y", None, "1")],
        schemas.COMPLAINTS_RAW,
    )
    got = external.complaints_trusted(raw)
    assert sorted(listed(got), key=repr) == sorted(
        [
            ("3", datetime(2024, 1, 1, 10, 11, 12), date(2024, 1, 1), "10:11:12"),
            (None, None, date(2024, 1, 2), None),
            ("1", None, None, None),
        ],
        key=repr,
    )


def test_consumption_trusted_and_fact(spark):
    raw = spark.createDataFrame(
        [
            (2023, 1, "sp", "Comercial", None, 10.9),
            (2023, 12, "sp", None, 5, None),
            (2023, 1, "sp", "Comercial", None, 10.9),
        ],
        schemas.CONSUMPTION,
    )
    trusted = external.consumption_trusted(raw)
    assert sorted(listed(trusted))[0] == (2023, 1, "SP", "COMERCIAL", 0, 10.9)
    whole = external.consumption_trusted(raw, whole_numbers=True)
    assert sorted(r.CONSUMO for r in whole.collect()) == [0, 10, 10]
    fact = facts.fact_consumption(trusted)
    assert sorted(listed(fact), key=repr) == sorted(
        [("COMERCIAL", 0, 10.9, "2023-01"), (None, 5, 0.0, "2023-12")], key=repr
    )


def test_generation_drops_rows_with_a_bad_source(spark):
    raw = spark.createDataFrame(
        [
            (date(2024, 1, 1), "1.125", "2", "3", "4", "5"),
            (date(2024, 1, 3), "1", "2", "3", "4", "5.555"),
            (date(2024, 1, 2), "1", "junk", "3", "4", "5"),
        ],
        schemas.GENERATION,
    )
    got = listed(external.generation_trusted(raw))
    assert [r[0] for r in got] == ["2024-01-03", "2024-01-01"]
    assert got[1][1] == 1.12


def aligned(spark):
    rows = []
    for i in range(6):
        at = f"2024-01-01T00:00:0{i}"
        rows += [
            (at, f"{i}.04", "ampére", "SUL", "NORMAL"),
            (at, f"{100 - 10 * i}.06", "volts", "SUL", "NORMAL"),
            (at, f"0.{i}5", "fator", "SUL", "NORMAL"),
        ]
        if i < 4:
            rows.append((at, f"2{i}", "°C", "SUL", "NORMAL"))
    rows += [
        ("2024-01-01T00:00:00", "junk", "volts", "SUL", "NORMAL"),
        ("2024-01-01T00:00:00", "9.9", "ampére", None, "NORMAL"),
        ("2024-01-01T00:00:00", "500", "volts", None, "NORMAL"),
    ]
    return telemetry(spark, rows)


def test_current_pairs_by_rank(spark):
    trusted = sensors.current_trusted(aligned(spark))
    got = sorted(
        (r.id, r.instant[-1], round(r.value, 5), r.voltage, r.power_factor, r.temperature, r.valueType)
        for r in trusted.collect()
    )
    # the highest voltage has no zone but still counts; rows past the fourth lack a temperature
    assert got == [
        (1, "0", 0.04, 500.0, 0.1, 20.0, "Ampere"),
        (2, "1", 1.04, 100.1, 0.2, 21.0, "Ampere"),
        (3, "2", 2.04, 90.1, 0.3, 22.0, "Ampere"),
        (4, "3", 3.04, 80.1, 0.4, 23.0, "Ampere"),
    ]
    client = sensors.current_client(trusted)
    assert [(r.id, r.secundary_current, r.primary_current, r.short_circuit_current)
            for r in client.collect()] == [
        (1, 0.0, 0, 12), (2, 1.0, 160, 2), (3, 2.0, 320, 2), (4, 3.0, 480, 2),
    ]
    assert "zone" not in client.columns and "valueType" not in client.columns


def test_alignment_does_not_depend_on_partitions(spark):
    once = sorted(listed(sensors.current_trusted(aligned(spark).coalesce(1))))
    assert sorted(listed(sensors.current_trusted(aligned(spark).repartition(7)))) == once


def test_frequency_pairs_linearly(spark):
    rows = [(f"2024-01-01T00:00:0{i}", v, k, "SUL", "NORMAL")
            for i in range(3) for k, v in (("Hz", "60"), ("volts", "100"))]
    got = listed(sensors.frequency_trusted(telemetry(spark, rows)))
    assert [r[0][-1] for r in got] == ["2", "1", "0"]
    assert [round(r[-1], 3) for r in got] == [95.106, -58.779, 0.0]


def test_power_factor_client_joins_on_the_whole_second(spark):
    rows = telemetry(
        spark,
        [
            ("2024-01-01T00:00:07.179", "0.9", "fator", "SUL", "NORMAL"),
            ("2024-01-01T00:00:07", "21", "°C", "SUL", "NORMAL"),
            ("2024-01-01T00:00:07.5", "3", "ampére", "SUL", "NORMAL"),
            ("2024-01-01T00:00:08.5", "4", "ampére", "SUL", "NORMAL"),
        ],
    )
    joined = sensors.power_factor_client(
        *(sensors.clean_sensor(rows, kind) for kind in ("fator", "°C", "ampére"))
    )
    assert listed(joined) == [
        ("2024-01-01T00:00:07", 0.9, "fator", 21.0, "°C", 3.0, "ampére")
    ]


def test_harmonics_tables(spark):
    rows = []
    for i in range(10):
        at = f"2024-01-01T00:00:0{i}"
        zone = ("SUL", "NORTE")[i % 2]
        rows += [
            (at, f"{i}", "Porcentagem", zone, "NORMAL"),
            (at, f"{220 + i}", "volts", zone, "NORMAL" if i % 2 else "TERRIVEL"),
        ]
    data = telemetry(spark, rows)
    trusted = harmonics.harmonics_trusted(data)
    # positions 0-4 expect NORMAL, 5-6 EXCEPCIONAL, 7-9 TERRIVEL
    assert sorted(r.value for r in trusted.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]
    versus = harmonics.harmonics_vs_voltage(trusted, data)
    assert sorted((r.value_harmonicas, r.value_tensao) for r in versus.collect()) == [
        (1.0, 221.0), (3.0, 223.0),
    ]
    latest = harmonics.latest_harmonic_per_zone(trusted)
    assert sorted(listed(latest)) == [("NORTE", 3.0), ("SUL", 4.0)]
    assert harmonics.harmonics_over_time(trusted).columns == [
        "instant", "value_harmonicas", "valueType_harmonicas",
    ]


def test_reports(spark):
    rows = [
        ("2024-01-01T03:00:00", "24000", "volts", "SUL", "NORMAL"),
        ("2024-01-01T04:59:59", "24000", "volts", "SUL", "NORMAL"),
        ("2024-01-01T12:00:00", "-24000", "volts", "NORTE", "NORMAL"),
        ("2024-01-01T12:00:00", "24000", "volts", "OESTE", "TERRIVEL"),
        ("2024-01-01T12:00:00", "24000", "volts", "CENTRO", "NORMAL"),
    ]
    people = spark.createDataFrame(
        [("sul", 1), ("Sul", 2), ("norte", 9), ("leste", 5)], schemas.ZONE_POPULATION
    )
    data = telemetry(spark, rows)
    assert listed(voltage.limits_by_zone(data, people)) == [
        ("NORTE", 1, 0, 9), ("SUL", 0, 2, 3),
    ]
    assert listed(voltage.overvoltage_by_day_period(data)) == [("Madrugada", 2), ("Meio dia", 1)]
