"""Fact tables: trusted tables joined, merged with the stored history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.functions.dates import year_month_key
from gridloom.operators import joins
from gridloom.operators.sets import history_merge


def voltage_weather_rows(
    voltage: DataFrame, weather: DataFrame, complaints: DataFrame
) -> DataFrame:
    """Readings with the ratings of their day and the weather of their hour.

    Every row is different from all others. The day and the date of a reading's
    instant are one, so both sides meet first and the readings are joined once.
    """
    around = joins.surroundings(
        joins.daily_ratings(complaints), joins.hourly_weather(weather)
    )
    return joins.with_surroundings(voltage, around).select(
        *schemas.FACT_VOLTAGE_WEATHER.names
    )


def fact_voltage_weather(
    voltage: DataFrame,
    weather: DataFrame,
    complaints: DataFrame,
    history: DataFrame | None = None,
) -> DataFrame:
    rows = voltage_weather_rows(voltage, weather, complaints)
    if history is None:
        return rows
    return history_merge(history, rows, schemas.FACT_VOLTAGE_WEATHER.names)


def consumption_rows(trusted: DataFrame) -> DataFrame:
    """Consumption keyed by year and month text."""
    month = year_month_key(F.col("ANO"), F.col("MES"))
    return trusted.withColumn("ANO_MES_COLETA", month).select(
        *schemas.FACT_CONSUMPTION.names
    )


def fact_consumption(trusted: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return history_merge(
        history, consumption_rows(trusted), schemas.FACT_CONSUMPTION.names
    )


def complaints_rows(trusted: DataFrame) -> DataFrame:
    """Complaints with the month they are stored under."""
    month = F.substring(F.col("DATA_RECLAMACAO").cast("string"), 1, 7)
    return trusted.withColumn("ANO_MES_RECLAMACAO", month).select(
        *schemas.STORED_COMPLAINTS.names
    )


def fact_complaints(trusted: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return history_merge(history, trusted, schemas.FACT_COMPLAINTS.names)
