"""Harmonic distortion: trusted readings and the client tables around them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import (
    AMPERE,
    EXCEPTIONAL,
    NORMAL,
    PERCENT,
    POWER_FACTOR,
    TERRIBLE,
    VOLTS,
)
from gridloom.operators.aggregates import latest_per_zone
from gridloom.operators.filters import equals, scenario_by_position
from gridloom.operators.joins import inner_join_all
from gridloom.plans.sensors import TIE, clean_sensor, format_value, numeric_sensor

# Share of the readings up to which each scenario is expected,
# and the scenario after the last share.
SCENARIO_SHARES = ((2, 5, NORMAL), (3, 5, EXCEPTIONAL), (9, 10, TERRIBLE))
LAST_SCENARIO = NORMAL


def harmonics_trusted(telemetry: DataFrame, tie: list[str] = TIE) -> DataFrame:
    """Harmonic readings that match the scenario expected at their position."""
    kept = scenario_by_position(
        numeric_sensor(telemetry, PERCENT),
        ["instant", *tie],
        "scenery",
        SCENARIO_SHARES,
        LAST_SCENARIO,
    )
    return format_value(kept)


def labelled(telemetry: DataFrame, kind: str, label: str, *keys: str) -> DataFrame:
    readings = equals(telemetry, "valueType", kind)
    return readings.select(
        *keys,
        F.col("value").alias(f"value_{label}"),
        F.col("valueType").alias(f"valueType_{label}"),
    )


def _versus(harmonics: DataFrame, telemetry: DataFrame, kind: str, label: str) -> DataFrame:
    """Every pair read at one instant in one scenario; a hot instant is dealt over many tasks."""
    keys = ["instant", "scenery"]
    sides = labelled(harmonics, PERCENT, "harmonicas", *keys), labelled(clean_sensor(telemetry, kind), kind, label, *keys)
    return inner_join_all(list(sides), keys)


def harmonics_vs_voltage(harmonics: DataFrame, telemetry: DataFrame) -> DataFrame:
    return _versus(harmonics, telemetry, VOLTS, "tensao")


def harmonics_vs_current(harmonics: DataFrame, telemetry: DataFrame) -> DataFrame:
    return _versus(harmonics, telemetry, AMPERE, "corrente")


def harmonics_vs_power(harmonics: DataFrame, telemetry: DataFrame) -> DataFrame:
    return _versus(harmonics, telemetry, POWER_FACTOR, "potencia")


def harmonics_over_time(harmonics: DataFrame) -> DataFrame:
    return labelled(harmonics, PERCENT, "harmonicas", "instant")


def latest_harmonic_per_zone(harmonics: DataFrame, tie: list[str] = TIE) -> DataFrame:
    latest = latest_per_zone(
        equals(harmonics, "valueType", PERCENT), "value", "instant", tie
    )
    return latest.withColumnRenamed("value", "value_harmonicas")
