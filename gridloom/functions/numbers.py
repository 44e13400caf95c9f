"""Numeric clean-up, rounding and derived electrical quantities."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import CURRENT_RATIO, LINE_IMPEDANCE


# Measures of the sensor, weather and generation tables are read in single
# precision: which way a half rounds, and a current truncates, depends on it.
SINGLE = "float"


def as_number(value: Column, number_type: str = "double") -> Column:
    """Text to number; junk becomes null instead of failing the job."""
    return value.try_cast(number_type)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def two_decimals(value: Column) -> Column:
    """Two decimals, exact binary value rounded half to even."""
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit("")).try_cast("double")


def two_decimals_single(value: Column) -> Column:
    """As ``two_decimals`` of a value in single precision, without the text.

    Such a value times 100 is exact in double precision, so rounding the product
    to even is rounding the value itself.
    """
    x = value.cast(SINGLE).cast("double")
    return F.when(~x.isin(float("inf"), float("-inf")), F.rint(x * 100.0) / 100.0)


def one_decimal_half_up(value: Column) -> Column:
    return F.round(value, 1)


def one_decimal_half_even(value: Column) -> Column:
    """Ten times the value, rounded to even, as array libraries round."""
    return F.rint(value * 10.0) / 10.0


def primary_current(secondary: Column) -> Column:
    """Whole amperes on the primary side, truncated in single precision."""
    return (secondary.cast("float") * F.lit(CURRENT_RATIO).cast("float")).cast("int")


def short_circuit_current(voltage: Column) -> Column:
    """Whole amperes, truncated; the voltage is taken in single precision."""
    return (voltage.cast("float") / F.lit(LINE_IMPEDANCE)).cast("int")


def sine_voltage(voltage: Column, frequency: Column, seconds: Column) -> Column:
    return voltage * F.sin(2 * F.pi() * frequency * seconds)
