"""One run through the zones, from landed files to facts."""

import json
from datetime import date, datetime
from pathlib import Path

from gridloom import constants as c
from gridloom import jobs, schemas
from gridloom.sources import scans
from gridloom.sources.sinks import publish

NOW = datetime(2024, 1, 3)


def land(folder, name, text):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_live_jobs_end_to_end_and_again(spark, folder):
    zones = jobs.Zones(*(f"{folder}/{n}" for n in ("raw", "trusted", "client")))
    readings = [
        {"valor": 0.0, "zona": "SUL", "timestamp": "2024-01-01T05:10:00"},
        {"valor": 220.0, "zona": "NORTE", "timestamp": "2024-01-02T06:10:00"},
        {"valor": 1.0, "zona": "SUL", "timestamp": "2025-01-01T00:00:00"},
    ]
    land(folder, "raw/telemetry_1.json", json.dumps(readings))
    land(
        folder,
        "raw/ReclameAqui_Raw_1.csv",
        "Reclamação;Data-hora;Avaliação\nSem luz;2024-01-01T10:11:12.500Z;3\n",
    )
    hours = {
        "time": ["2023-12-30T05:00", "2024-01-01T05:00", "2024-01-02T06:00"],
        "temperature_2m": [1.0, 20.0, 21.0],
        "rain": [0.0, 30.0, 0.0],
        "wind_speed_10m": [0.0, 0.0, 26.0],
    }
    weather = land(folder, "landed/clima.json", json.dumps({"hourly": hours}))
    consumption = spark.createDataFrame(
        [(2023, 5, "SP", "Comercial", 10, 1.5)], schemas.CONSUMPTION
    )
    directory = spark.createDataFrame([("SP", "São Paulo")], schemas.STATE_DIRECTORY)

    for _ in range(2):
        now = datetime.now()
        jobs.voltage_to_trusted(spark, zones, NOW.replace(microsecond=now.microsecond))
        jobs.complaints_to_trusted(spark, zones, now)
        written = jobs.weather_to_trusted(spark, zones, now, weather, date(2024, 1, 2))
        assert spark.read.parquet(written).count() == 2
        jobs.consumption_to_trusted(zones, now, consumption, directory)
        fact = jobs.voltage_weather_to_client(spark, zones)
        assert fact.columns == schemas.FACT_VOLTAGE_WEATHER.names
        got = sorted(
            (r.ZONA_GERACAO, r.TENSAO_SEVERIDADE, r.CLIMA_EVENTO, r.INDICE_APROVACAO)
            for r in fact.collect()
        )
        assert got == [("NORTE", False, "VENTO", None), ("SUL", True, "CHUVA", "3")]
        assert [tuple(r) for r in jobs.consumption_to_client(spark, zones).collect()] == [
            ("COMERCIAL", 10, 1.5, "2023-05")
        ]
        assert [tuple(r) for r in jobs.complaints_to_client(spark, zones).collect()] == [
            (date(2024, 1, 1), "10:11:12", datetime(2024, 1, 1, 10, 11, 12), "3")
        ]


def test_refresh_takes_in_every_run_once(spark, folder):
    zones = jobs.Zones(*(f"{folder}/{n}" for n in ("raw", "trusted", "client")))
    when = datetime(2024, 1, 1, 5, 10)
    first = (when.date(), "05:10", "2024-01", "SUL", when, 1.0)
    second = (when.date(), "05:10", "2024-01", "NORTE", when, 2.0)
    said = ("3", when, when.date(), "05:10:00")
    hour = (datetime(2024, 1, 1, 5), 20.0, 30.0, 0.0)

    def trusted(name, rows, schema, run):
        publish(spark.createDataFrame(rows, schema), zones.trusted, name + "1", run)

    trusted(c.TRUSTED_WEATHER, [hour], schemas.WEATHER_TRUSTED, NOW)
    trusted(c.TRUSTED_COMPLAINTS, [said], schemas.COMPLAINTS_TRUSTED, NOW)
    use = (2023, 5, "SP", "COMERCIAL", 10, 1.5)
    trusted(c.TRUSTED_CONSUMPTION, [use, use], schemas.CONSUMPTION_TRUSTED, NOW)
    for day, rows in ((4, [first]), (5, [first, second])):
        trusted(c.TRUSTED_VOLTAGE, rows, schemas.VOLTAGE_TRUSTED, datetime(2024, 1, day))
        for _ in range(2):
            jobs.refresh_voltage_weather(spark, zones, f"{folder}/checkpoints/voltage")
            jobs.refresh_consumption(spark, zones, f"{folder}/checkpoints/consumption")
            jobs.refresh_complaints(spark, zones, f"{folder}/checkpoints/complaints")
    fact = jobs.VOLTAGE_WEATHER.read(spark, zones)
    assert sorted((r.ZONA_GERACAO, r.CLIMA_EVENTO, r.INDICE_APROVACAO) for r in fact.collect()) == [
        ("NORTE", "CHUVA", "3"), ("SUL", "CHUVA", "3"),
    ]
    assert jobs.CONSUMPTION.read(spark, zones).count() == 1
    assert jobs.COMPLAINTS.read(spark, zones).count() == 1


def test_sensor_jobs_and_reports(spark, folder):
    zones = jobs.Zones(*(f"{folder}/{n}" for n in ("raw", "trusted", "client")))
    kinds = (c.VOLTS, c.AMPERE, c.POWER_FACTOR, c.CELSIUS, c.HERTZ, c.PERCENT)
    lines = [
        json.dumps(
            {
                "instant": f"2024-01-01T00:00:0{i}.5",
                "value": f"{24000 + i}" if kind == c.VOLTS else f"{i}.5",
                "valueType": kind,
                "zone": c.ZONES[i % 5],
                "scenery": c.NORMAL,
                "IoTHub": "ignored",
            }
        )
        for i in range(10)
        for kind in kinds
    ]
    path = land(folder, "raw/sensors.json", "\n".join(lines))
    written = jobs.sensors_to_client(spark, zones, NOW, path)
    sizes = {name: spark.read.parquet(p).count() for name, p in written.items()}
    assert sizes == {
        "trusted_ºC": 10,
        "trusted_fator": 10,
        "trusted_Ampere": 10,
        "trusted_Hz": 10,
        "trusted_all_sensors": 5,
        "client_Ampere": 10,
        "client_correlacoes_fator": 10,
        "client_tensao_x_harmonica": 5,
        "client_corrente_x_harmonica": 5,
        "client_potencia_x_harmonica": 5,
        "client_harmonicas_x_tempo": 5,
        "client_ultimo_valor_harmonica_por_regiao": 5,
    }
    people = land(folder, "landed/pop.csv", "zona,populacao\nsul,5\nNorte,7\n")
    reports = jobs.voltage_reports(spark, zones, NOW, path, people)
    limits = scans.read_csv(
        spark,
        reports["limits_by_zone"],
        spark.createDataFrame([], "zone string, BaixaTensao int, AltaTensao int, PopulacaoTotal int").schema,
        sep="|",
    )
    assert sorted(tuple(r) for r in limits.collect()) == [("NORTE", 0, 2, 7), ("SUL", 0, 2, 5)]
    generation = land(
        folder,
        "landed/generation.csv",
        "date,hydroeletric,wind,nuclear,solar,thermal\n2024-01-01,1.125,2,3,4,5\n",
    )
    stored = jobs.generation_to_trusted(spark, zones, NOW, generation)
    assert spark.read.parquet(stored).count() == 1


def test_complaints_with_line_breaks_stay_whole_and_malformed_rows_are_set_aside(spark, folder):
    zones = jobs.Zones(*(f"{folder}/{n}" for n in ("raw", "trusted", "client")))
    land(
        folder,
        "raw/ReclameAqui_Raw_1.csv",
        'Reclamação;Data-hora;Avaliação\n"Sem luz;\ndesde ""ontem""";2024-01-01T10:11:12.500Z;3\n'
        "a;2024-01-02T00:00:00Z;1;too;many\n",
    )
    path = jobs.complaints_to_trusted(spark, zones, NOW)
    rows = spark.read.schema(schemas.COMPLAINTS_TRUSTED).parquet(path).collect()
    assert [(r.AVALIACAO, r.HORA_RECLAMACAO) for r in rows] == [("3", "10:11:12")]
    aside = spark.read.text(f"{zones.raw}/{c.QUARANTINE_COMPLAINTS}").collect()
    assert [r.value for r in aside] == ["a;2024-01-02T00:00:00Z;1;too;many"]
    # The quarantined lines are not taken for a newer landed file.
    assert jobs._newest_file(spark, zones.raw, c.RAW_COMPLAINTS).endswith("ReclameAqui_Raw_1.csv")
