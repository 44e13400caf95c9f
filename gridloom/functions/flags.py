"""Severity flags and labels. A missing measure never raises a flag."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import (
    LOW_VOLTAGE_LIMIT,
    NO_EVENT,
    RAIN_EVENT,
    RAIN_LIMIT,
    WIND_EVENT,
    WIND_LIMIT,
)


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _reaches(value: Column, limit: float) -> Column:
    """``value >= limit``; Spark orders NaN above every number, so rule it out."""
    return _holds((value >= limit) & ~F.isnan(value))


def low_voltage(value: Column) -> Column:
    return _holds(value <= LOW_VOLTAGE_LIMIT)


def heavy_rain(rain: Column) -> Column:
    return _reaches(rain, RAIN_LIMIT)


def strong_wind(wind: Column) -> Column:
    return _reaches(wind, WIND_LIMIT)


def severe_weather(rain: Column, wind: Column) -> Column:
    return heavy_rain(rain) | strong_wind(wind)


def weather_event(rain: Column, wind: Column) -> Column:
    """Rain outranks wind."""
    return (
        F.when(heavy_rain(rain), F.lit(RAIN_EVENT))
        .when(strong_wind(wind), F.lit(WIND_EVENT))
        .otherwise(F.lit(NO_EVENT))
    )
