"""Temperature, current, frequency and power factor, from one telemetry scan.

``tie`` lists the columns that order readings of one instant. Together with
the instant they must tell unequal rows apart; a unique id does, and without
one every column of the telemetry does.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.constants import (
    AMPERE,
    AMPERE_TRUSTED,
    CELSIUS,
    HERTZ,
    POWER_FACTOR,
    SINE_STEP,
    VOLTS,
)
from gridloom.functions import dates, numbers
from gridloom.operators.columns import replace_value
from gridloom.operators.filters import drop_null_rows, equals, keep_numeric
from gridloom.operators.joins import inner_join_all
from gridloom.operators.rowindex import with_row_index
from gridloom.operators.sorts import sort_desc

TIE = ["zone", "scenery", "value"]


def numeric_sensor(telemetry: DataFrame, kind: str) -> DataFrame:
    """Complete numeric readings of one kind."""
    readings = equals(drop_null_rows(telemetry), "valueType", kind)
    return keep_numeric(readings, "value", number_type=numbers.SINGLE)


def format_value(readings: DataFrame) -> DataFrame:
    return readings.withColumn("value", numbers.two_decimals_single(F.col("value")))


def clean_sensor(telemetry: DataFrame, kind: str) -> DataFrame:
    """Complete numeric readings of one kind, with two decimals."""
    return format_value(numeric_sensor(telemetry, kind))


def _latest_first(telemetry: DataFrame, kind: str, tie: list[str]) -> DataFrame:
    # A sort reads its input twice, once for a sample; format after it, once.
    return format_value(sort_desc(numeric_sensor(telemetry, kind), "instant", *tie))


def _details_of(telemetry: DataFrame, kind: str) -> dict[str, Column]:
    """All columns but kind and value, kept for one kind and null for the others."""
    return {
        name: F.when(F.col("valueType") == kind, F.col(name))
        for name in telemetry.columns
        if name not in ("valueType", "value")
    }


def temperature_trusted(telemetry: DataFrame, tie: list[str] = TIE) -> DataFrame:
    return _latest_first(telemetry, CELSIUS, tie)


def power_factor_trusted(telemetry: DataFrame, tie: list[str] = TIE) -> DataFrame:
    return _latest_first(telemetry, POWER_FACTOR, tie)


def current_trusted(telemetry: DataFrame, tie: list[str] = TIE) -> DataFrame:
    """Each current reading with the voltage, factor and temperature of its rank.

    Voltages are ranked from the highest down, the other kinds by arrival. All
    four kinds are numbered in one pass, so the telemetry is scanned, shuffled
    and written once; the joins on the number then have unique keys. Readings
    beyond the shortest kind have no partner and drop out.
    """
    kind, value = F.col("valueType"), F.col("value")
    numeric = keep_numeric(telemetry, "value")
    known = [F.col(name).isNotNull() for name in telemetry.columns]
    complete = numeric.where((kind != AMPERE) | reduce(and_, known))
    rounded = complete.withColumn(
        "value",
        F.when(kind == AMPERE, value.cast(numbers.SINGLE)).otherwise(
            numbers.one_decimal_half_up(value)
        ),
    )
    highest_first = F.when(F.isnan(value), F.lit(float("-inf"))).otherwise(-value)
    ranked = with_row_index(
        rounded,
        [F.when(kind == VOLTS, highest_first), "instant", *tie],
        name="id",
        kind="valueType",
        kinds=(AMPERE, VOLTS, POWER_FACTOR, CELSIUS),
        after_sort=_details_of(telemetry, AMPERE),
    )
    current = replace_value(
        equals(ranked, "valueType", AMPERE), "valueType", AMPERE, AMPERE_TRUSTED
    )
    partners = {"voltage": VOLTS, "power_factor": POWER_FACTOR, "temperature": CELSIUS}
    others = [
        equals(ranked, "valueType", kind).select("id", F.col("value").alias(name))
        for name, kind in partners.items()
    ]
    return inner_join_all([current, *others], ["id"])


def current_client(trusted: DataFrame) -> DataFrame:
    """Currents on both sides of the transformer and at short circuit, by id."""
    half_up = numbers.one_decimal_half_up
    measured = trusted.withColumnRenamed("value", "secundary_current").withColumns(
        {
            name: half_up(F.col(name))
            for name in ("voltage", "power_factor", "temperature")
        }
    )
    measured = measured.withColumn(
        "secundary_current", half_up(F.col("secundary_current"))
    )
    return (
        measured.withColumns(
            {
                "primary_current": numbers.primary_current(F.col("secundary_current")),
                "short_circuit_current": numbers.short_circuit_current(F.col("voltage")),
            }
        )
        .drop("zone", "valueType")
        .orderBy("id")
    )


def frequency_trusted(telemetry: DataFrame, tie: list[str] = TIE) -> DataFrame:
    """Frequency readings with the sine voltage at their moment.

    Every frequency reading is paired with the voltage reading of the same
    arrival rank, and its rank also gives the time on the wave. Pairing each
    frequency with each voltage would grow with the square of the data. A reading
    beyond the last voltage is kept; its sine voltage is null.
    """
    complete = keep_numeric(drop_null_rows(telemetry), "value")
    ranked = with_row_index(
        complete,
        ["instant", *tie],
        name="_rank",
        first=0,
        kind="valueType",
        kinds=(HERTZ, VOLTS),
        after_sort=_details_of(telemetry, HERTZ),
    )
    frequency = equals(ranked, "valueType", HERTZ)
    voltage = equals(ranked, "valueType", VOLTS).select(
        "_rank", F.col("value").alias("_voltage")
    )
    wave = numbers.sine_voltage(
        F.col("_voltage"), F.col("value"), F.col("_rank") * SINE_STEP
    )
    paired = (
        frequency.join(voltage, "_rank", "left")
        .withColumn("tensao_senoidal", wave)
        .withColumn("value", numbers.two_decimals_single(F.col("value")))
    )
    # The rank comes from the numbered table, so it spreads equal rows the same way every time.
    order = [F.desc(c) for c in ("instant", *tie)]
    return paired.orderBy(*order, "_rank").drop("_rank", "_voltage")


def at_instant(readings: DataFrame, label: str) -> DataFrame:
    """Whole-second instant, value and kind of a sensor, labelled for a join."""
    return readings.select(
        dates.truncate_fraction(F.col("instant")).alias("instant"),
        F.col("value").alias(f"value_{label}"),
        F.col("valueType").alias(f"valueType_{label}"),
    )


def power_factor_client(
    factor: DataFrame, temperature: DataFrame, current: DataFrame
) -> DataFrame:
    """Power factor, temperature and current read in the same second.

    Every combination within a second is a row, as the correlation asks for, so
    a second with n readings of each kind gives n cubed rows: its size is bounded
    by how often a sensor reads in a second.
    """
    return inner_join_all(
        [
            at_instant(factor, "fator"),
            at_instant(temperature, "temperatura"),
            at_instant(current, "corrente"),
        ],
        ["instant"],
    )
