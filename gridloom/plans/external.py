"""Weather, complaints, consumption and generation to trusted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import GENERATION_SOURCES
from gridloom.functions import dates, numbers
from gridloom.operators.columns import cast_columns, fill_null_numbers, uppercase_strings
from gridloom.operators.filters import keep_numeric
from gridloom.schemas import COMPLAINTS_TRUSTED, CONSUMPTION_TRUSTED
from gridloom.sources.weather import hourly_rows

# Landed names and their trusted names.
WEATHER_RENAMES = {
    "time": "DATA_HORA_CLIMA",
    "temperature_2m": "CLIMA_TEMPERATURA",
    "rain": "CLIMA_CHUVA",
    "wind_speed_10m": "CLIMA_VENTO",
}
WEATHER_MEASURES = ("temperature_2m", "rain", "wind_speed_10m")


def clean_measures(df: DataFrame, *names: str) -> DataFrame:
    """Numeric rows only, each measure with two decimals."""
    numeric = keep_numeric(df, *names, number_type=numbers.SINGLE)
    return numeric.withColumns(
        {name: numbers.two_decimals_single(F.col(name)) for name in names}
    )


def weather_trusted(documents: DataFrame) -> DataFrame:
    """Hourly weather, latest first, then by its measures."""
    hours = clean_measures(hourly_rows(documents), *WEATHER_MEASURES)
    named = hours.withColumnsRenamed(WEATHER_RENAMES)
    return named.withColumn(
        "DATA_HORA_CLIMA", dates.parse_timestamp(F.col("DATA_HORA_CLIMA"))
    ).orderBy(F.desc("DATA_HORA_CLIMA"), "CLIMA_TEMPERATURA", "CLIMA_CHUVA", "CLIMA_VENTO")


def split_instants(complaints: DataFrame) -> DataFrame:
    """Date, time and date-time text of each complaint's ISO instant."""
    instant = F.col("Data-hora")
    return complaints.withColumns(
        {
            "DATA_HORA_RECLAMACAO": dates.iso_date_time(instant),
            "DATA_RECLAMACAO": dates.iso_date(instant),
            "HORA_RECLAMACAO": dates.iso_time(instant),
        }
    )


def complaints_trusted(raw: DataFrame) -> DataFrame:
    """Complaints with parsed dates; a malformed instant leaves nulls behind."""
    named = split_instants(raw).withColumnRenamed("Avaliação", "AVALIACAO")
    return named.withColumns(
        {
            "DATA_RECLAMACAO": F.col("DATA_RECLAMACAO").try_cast("date"),
            "DATA_HORA_RECLAMACAO": dates.parse_timestamp(F.col("DATA_HORA_RECLAMACAO")),
        }
    ).select(*COMPLAINTS_TRUSTED.names)


def consumption_trusted(queried: DataFrame, whole_numbers: bool = False) -> DataFrame:
    """Consumption rows without nulls in numbers, in upper case throughout.

    ``whole_numbers`` also truncates the two measures to integers.
    """
    filled = uppercase_strings(fill_null_numbers(queried))
    named = filled.withColumnsRenamed({name: name.upper() for name in filled.columns})
    if whole_numbers:
        named = cast_columns(
            named, {"NUMERO_CONSUMIDORES": "bigint", "CONSUMO": "bigint"}
        )
    return named.select(*CONSUMPTION_TRUSTED.names)


def generation_trusted(raw: DataFrame) -> DataFrame:
    """Daily generation per source, latest day first."""
    cleaned = clean_measures(raw, *GENERATION_SOURCES)
    return (
        cleaned.withColumn("date", dates.date_text(F.col("date")))
        .select("date", *GENERATION_SOURCES)
        .orderBy(F.desc("date"), *GENERATION_SOURCES)
    )
