"""Zone-to-zone jobs: read what has landed, build the table, store it.

Each job is one function for the caller to schedule. Trusted and report tables
are published as a new run; facts are partitioned by month and only ever
appended to.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridloom import constants as c
from gridloom import schemas
from gridloom.plans import external, facts, harmonics, sensors, voltage
from gridloom.operators.filters import last_day
from gridloom.sources import manifest, scans
from gridloom.sources.consumption import consumption_query
from gridloom.sources.sinks import publish
from gridloom.sources.weather import fitting
from gridloom.streaming.refresh import append_new_rows, landed_parquet, read_fact, refresh


# Fixed value: separator of the two voltage reports.
REPORT_SEPARATOR = "|"


@dataclass(frozen=True)
class Zones:
    """Base paths of the three zones."""

    raw: str
    trusted: str
    client: str


def _found(path: str | None, zone: str, contains: str) -> str:
    if path is None:
        raise FileNotFoundError(f"nothing below {zone} is named like {contains}")
    return path


def _newest(spark: SparkSession, zone: str, contains: str) -> str:
    return _found(scans.latest_table(spark, zone, contains), zone, contains)


def _newest_file(spark: SparkSession, zone: str, contains: str) -> str:
    return _found(manifest.latest_file(spark, zone, contains), zone, contains)


def note_landed(spark: SparkSession, zones: Zones) -> None:
    """Note what has landed in the raw zone since the last time; the other jobs go by these notes."""
    manifest.feed(spark, zones.raw)


def _trusted(
    spark: SparkSession, zones: Zones, contains: str, schema: StructType
) -> DataFrame:
    return spark.read.schema(schema).parquet(_newest(spark, zones.trusted, contains))


def _dated(name: str, now: datetime) -> str:
    return f"{name}{now:%Y%m%d}"


def voltage_to_trusted(
    spark: SparkSession, zones: Zones, now: datetime, path: str | None = None
) -> str:
    """The newest landed file, or all files of the path given."""
    path = path or _newest_file(spark, zones.raw, c.RAW_VOLTAGE)
    raw = scans.read_json_array(spark, path, schemas.VOLTAGE_RAW)
    table = voltage.voltage_trusted(raw, now)
    return publish(table, zones.trusted, _dated(c.TRUSTED_VOLTAGE, now), now)


def weather_to_trusted(
    spark: SparkSession, zones: Zones, now: datetime, path: str, day: date | None = None
) -> str:
    """Landed weather documents; with ``day``, that day and the one before.

    Documents whose arrays differ in length are stored below ``c.QUARANTINE_WEATHER`` of the raw zone.
    """
    landed = scans.read_json_documents(spark, path, schemas.WEATHER_DOCUMENT)
    documents, _ = fitting(landed, f"{zones.raw}/{c.QUARANTINE_WEATHER}", path)
    table = external.weather_trusted(documents)
    if day is not None:
        table = last_day(table, "DATA_HORA_CLIMA", day)
    return publish(table, zones.trusted, _dated(c.TRUSTED_WEATHER, now), now)


def complaints_to_trusted(
    spark: SparkSession, zones: Zones, now: datetime, path: str | None = None
) -> str:
    """The newest landed file, or all files of the path given.

    Complaint text may hold line breaks. Lines that do not fit are stored below
    ``c.QUARANTINE_COMPLAINTS`` of the raw zone.
    """
    path = path or _newest_file(spark, zones.raw, c.RAW_COMPLAINTS)
    table = external.complaints_trusted(
        scans.read_csv(
            spark,
            path,
            schemas.COMPLAINTS_RAW,
            free_text=True,
            quarantine=f"{zones.raw}/{c.QUARANTINE_COMPLAINTS}",
        )
    )
    return publish(table, zones.trusted, _dated(c.TRUSTED_COMPLAINTS, now), now)


def consumption_to_trusted(
    zones: Zones, now: datetime, consumption: DataFrame, directory: DataFrame
) -> str:
    table = external.consumption_trusted(consumption_query(consumption, directory))
    return publish(table, zones.trusted, _dated(c.TRUSTED_CONSUMPTION, now), now)


def generation_to_trusted(
    spark: SparkSession, zones: Zones, now: datetime, path: str
) -> str:
    raw = scans.read_csv(spark, path, schemas.GENERATION, sep=",")
    return publish(
        external.generation_trusted(raw), zones.trusted, c.TRUSTED_GENERATION, now
    )


def sensors_to_client(
    spark: SparkSession, zones: Zones, now: datetime, path: str
) -> dict[str, str]:
    """All sensor tables from one landed telemetry path (JSON lines).

    Trusted tables are written first, and the client tables are built from what
    was written, so nothing is computed twice.
    """
    telemetry = scans.read_json_lines(spark, path, schemas.TELEMETRY)
    written: dict[str, str] = {}

    def to_trusted(name: str, table: DataFrame) -> DataFrame:
        written[name] = publish(table, zones.trusted, name, now)
        return spark.read.schema(table.schema).parquet(written[name])

    def to_client(name: str, table: DataFrame) -> None:
        written[name] = publish(table, zones.client, name, now)

    temperature = to_trusted(c.TRUSTED_TEMPERATURE, sensors.temperature_trusted(telemetry))
    factor = to_trusted(c.TRUSTED_POWER_FACTOR, sensors.power_factor_trusted(telemetry))
    current = to_trusted(c.TRUSTED_CURRENT, sensors.current_trusted(telemetry))
    to_trusted(c.TRUSTED_FREQUENCY, sensors.frequency_trusted(telemetry))
    percent = to_trusted(c.TRUSTED_HARMONICS, harmonics.harmonics_trusted(telemetry))

    to_client(c.CLIENT_CURRENT, sensors.current_client(current))
    to_client(
        c.CLIENT_POWER_FACTOR,
        sensors.power_factor_client(factor, temperature, current),
    )
    to_client(
        c.CLIENT_HARMONICS_VOLTAGE, harmonics.harmonics_vs_voltage(percent, telemetry)
    )
    to_client(
        c.CLIENT_HARMONICS_CURRENT, harmonics.harmonics_vs_current(percent, telemetry)
    )
    to_client(
        c.CLIENT_HARMONICS_POWER, harmonics.harmonics_vs_power(percent, telemetry)
    )
    to_client(c.CLIENT_HARMONICS_TIME, harmonics.harmonics_over_time(percent))
    to_client(
        c.CLIENT_LATEST_HARMONIC,
        harmonics.latest_harmonic_per_zone(percent),
    )
    return written


def voltage_reports(
    spark: SparkSession, zones: Zones, now: datetime, telemetry: str, population: str
) -> dict[str, str]:
    """Limit violations per zone and over-voltage per period of the day."""
    readings = scans.read_json_lines(spark, telemetry, schemas.TELEMETRY)
    people = scans.read_csv(spark, population, schemas.ZONE_POPULATION, sep=",")
    reports = {
        c.CLIENT_LIMITS: voltage.limits_by_zone(readings, people),
        c.CLIENT_PERIODS: voltage.overvoltage_by_day_period(readings),
    }
    return {
        name: publish(table, zones.client, name, now, fmt="csv", sep=REPORT_SEPARATOR)
        for name, table in reports.items()
    }


@dataclass(frozen=True)
class Fact:
    """Where a fact is stored and how its files are split and ordered."""

    path: str
    schema: StructType
    month: str
    latest_first: str

    def append(self, rows: DataFrame, zones: Zones) -> None:
        path = f"{zones.client}/{self.path}"
        append_new_rows(rows, path, self.schema, self.month, self.latest_first)

    def read(self, spark: SparkSession, zones: Zones) -> DataFrame:
        return read_fact(spark, f"{zones.client}/{self.path}", self.schema)

    def refresh(
        self,
        spark: SparkSession,
        zones: Zones,
        trusted: str,
        schema: StructType,
        to_rows: Callable[[DataFrame], DataFrame],
        checkpoint: str,
    ) -> None:
        """Append every trusted run not taken in before."""
        runs = landed_parquet(spark, f"{zones.trusted}/{trusted}*/run=*", schema)
        path = f"{zones.client}/{self.path}"
        refresh(runs, to_rows, path, self.schema, self.month, checkpoint, self.latest_first)


VOLTAGE_WEATHER = Fact(
    c.FACT_VOLTAGE_WEATHER,
    schemas.FACT_VOLTAGE_WEATHER,
    "ANO_MES_GERACAO",
    "DATA_HORA_GERACAO",
)
CONSUMPTION = Fact(
    c.FACT_CONSUMPTION, schemas.FACT_CONSUMPTION, "ANO_MES_COLETA", "ANO_MES_COLETA"
)
COMPLAINTS = Fact(
    c.FACT_COMPLAINTS,
    schemas.STORED_COMPLAINTS,
    "ANO_MES_RECLAMACAO",
    "DATA_HORA_RECLAMACAO",
)


def _voltage_weather_rows(
    spark: SparkSession, zones: Zones
) -> Callable[[DataFrame], DataFrame]:
    weather = _trusted(spark, zones, c.TRUSTED_WEATHER, schemas.WEATHER_TRUSTED)
    complaints = _trusted(
        spark, zones, c.TRUSTED_COMPLAINTS, schemas.COMPLAINTS_TRUSTED
    )
    return lambda readings: facts.voltage_weather_rows(readings, weather, complaints)


def voltage_weather_to_client(spark: SparkSession, zones: Zones) -> DataFrame:
    """Append the newest trusted tables to the voltage-weather fact."""
    readings = _trusted(spark, zones, c.TRUSTED_VOLTAGE, schemas.VOLTAGE_TRUSTED)
    VOLTAGE_WEATHER.append(_voltage_weather_rows(spark, zones)(readings), zones)
    return VOLTAGE_WEATHER.read(spark, zones)


def consumption_to_client(spark: SparkSession, zones: Zones) -> DataFrame:
    trusted = _trusted(spark, zones, c.TRUSTED_CONSUMPTION, schemas.CONSUMPTION_TRUSTED)
    CONSUMPTION.append(facts.consumption_rows(trusted), zones)
    return CONSUMPTION.read(spark, zones)


def complaints_to_client(spark: SparkSession, zones: Zones) -> DataFrame:
    trusted = _trusted(spark, zones, c.TRUSTED_COMPLAINTS, schemas.COMPLAINTS_TRUSTED)
    COMPLAINTS.append(facts.complaints_rows(trusted), zones)
    return COMPLAINTS.read(spark, zones).drop(COMPLAINTS.month)


def refresh_voltage_weather(spark: SparkSession, zones: Zones, checkpoint: str) -> None:
    """All voltage runs not yet taken in, with the newest weather and complaints."""
    VOLTAGE_WEATHER.refresh(
        spark,
        zones,
        c.TRUSTED_VOLTAGE,
        schemas.VOLTAGE_TRUSTED,
        lambda batch: _voltage_weather_rows(spark, zones)(batch),
        checkpoint,
    )


def refresh_consumption(spark: SparkSession, zones: Zones, checkpoint: str) -> None:
    CONSUMPTION.refresh(
        spark,
        zones,
        c.TRUSTED_CONSUMPTION,
        schemas.CONSUMPTION_TRUSTED,
        facts.consumption_rows,
        checkpoint,
    )


def refresh_complaints(spark: SparkSession, zones: Zones, checkpoint: str) -> None:
    COMPLAINTS.refresh(
        spark,
        zones,
        c.TRUSTED_COMPLAINTS,
        schemas.COMPLAINTS_TRUSTED,
        facts.complaints_rows,
        checkpoint,
    )
