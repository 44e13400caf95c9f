"""Voltage readings to trusted, and the two voltage reports."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.constants import NORMAL, VIOLATION_MAX, VIOLATION_MIN, VOLTS
from gridloom.functions import dates, numbers
from gridloom.operators.aggregates import (
    count_by,
    limit_violations,
    mean_by,
    sum_by,
)
from gridloom.operators.filters import above, keep_numeric, up_to
from gridloom.schemas import VOLTAGE_TRUSTED
from gridloom.streaming.means import means_of, partial_sums

# Landed names and their trusted names.
RENAMES = {
    "valor": "TENSAO_VALOR",
    "zona": "ZONA_GERACAO",
    "timestamp": "DATA_HORA_GERACAO",
}


def parse_readings(raw: DataFrame) -> DataFrame:
    """Landed readings with target names, a parsed time and null for NaN."""
    readings = raw.withColumnsRenamed(RENAMES)
    return readings.withColumns(
        {
            "DATA_HORA_GERACAO": dates.parse_timestamp(F.col("DATA_HORA_GERACAO")),
            "TENSAO_VALOR": numbers.nan_to_null(F.col("TENSAO_VALOR")),
        }
    )


def with_date_parts(readings: DataFrame) -> DataFrame:
    at = F.col("DATA_HORA_GERACAO")
    return readings.withColumns(
        {
            "DATA_GERACAO": F.to_date(at),
            "ANO_MES_GERACAO": dates.year_month(at),
            "HORA_MINUTO_GERACAO": dates.hour_minute(at),
        }
    )


def voltage_trusted(raw: DataFrame, cutoff: datetime | None = None) -> DataFrame:
    """Mean reading per zone and instant, without readings from the future.

    The day, month and minute follow from the instant, so the mean is grouped
    by instant and zone only and the parts are added to the finished groups.
    """
    means = mean_by(_rounded(raw, cutoff), VOLTAGE_KEYS.names, "TENSAO_VALOR")
    return with_date_parts(means).select(*VOLTAGE_TRUSTED.names)


VOLTAGE_KEYS = StructType([VOLTAGE_TRUSTED["ZONA_GERACAO"], VOLTAGE_TRUSTED["DATA_HORA_GERACAO"]])


def _rounded(raw: DataFrame, cutoff: datetime | None) -> DataFrame:
    readings = up_to(parse_readings(raw), "DATA_HORA_GERACAO", cutoff)
    return readings.withColumn("TENSAO_VALOR", numbers.one_decimal_half_even(F.col("TENSAO_VALOR")))


def voltage_sums(raw: DataFrame, cutoff: datetime | None = None) -> DataFrame:
    """What one load adds to the means per zone and instant, to be stored."""
    return partial_sums(_rounded(raw, cutoff), VOLTAGE_KEYS.names, "TENSAO_VALOR")


def voltage_from_sums(sums: DataFrame) -> DataFrame:
    """The same table as :func:`voltage_trusted`, from the stored sums of all loads."""
    means = means_of(sums, VOLTAGE_KEYS.names, "TENSAO_VALOR")
    return with_date_parts(means).select(*VOLTAGE_TRUSTED.names)


def normal_voltage(telemetry: DataFrame) -> DataFrame:
    """Numeric voltage readings under the normal scenario."""
    return keep_numeric(
        telemetry.where((F.col("valueType") == VOLTS) & (F.col("scenery") == NORMAL)),
        "value",
    )


def population_by_zone(population: DataFrame) -> DataFrame:
    zones = population.select(F.upper("zona").alias("zone"), "populacao")
    return sum_by(zones, "zone", "populacao")


def limits_by_zone(
    telemetry: DataFrame,
    population: DataFrame,
    lowest: float = VIOLATION_MIN,
    highest: float = VIOLATION_MAX,
) -> DataFrame:
    """Limit violations per zone next to the zone's population, largest first."""
    violations = limit_violations(
        normal_voltage(telemetry), "zone", "value", lowest, highest
    )
    return (
        violations.join(population_by_zone(population), "zone")
        .withColumnRenamed("populacao", "PopulacaoTotal")
        .orderBy(F.desc("PopulacaoTotal"), "zone")
    )


def overvoltage_by_day_period(
    telemetry: DataFrame, highest: float = VIOLATION_MAX
) -> DataFrame:
    """Readings over the limit per period of the day, most frequent first."""
    over = above(normal_voltage(telemetry), "value", highest)
    at = dates.parse_timestamp(F.col("instant"))
    periods = over.withColumn("day-period", dates.day_period(F.hour(at)))
    return count_by(periods, "day-period", "value").orderBy(
        F.desc("value"), "day-period"
    )
