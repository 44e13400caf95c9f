"""Weather documents: parallel hourly arrays to one row per hour."""

import hashlib

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.staging import stage

# The parallel arrays of a weather document.
HOURLY_FIELDS = ("time", "temperature_2m", "rain", "wind_speed_10m")


def _arrays() -> list[Column]:
    return [F.col(f"hourly.{name}") for name in HOURLY_FIELDS]


def _same_length() -> Column:
    """Whether the arrays fit together; a missing one does not."""
    first, *others = (F.size(array) for array in _arrays())
    same = F.lit(True)
    for other in others:
        same = same & (first == other)
    return same


def fitting(documents: DataFrame, quarantine: str, source: str) -> tuple[DataFrame, dict[str, int]]:
    """The documents whose arrays have one length, and how many ``good`` and ``bad`` there were.

    The others are stored as JSON lines below ``quarantine``, in a folder that belongs to
    ``source``: the same source again replaces it. Documents are read once, and counted as they are.
    """
    seen = Observation()
    fits = F.coalesce(_same_length(), F.lit(False))
    marked = stage(
        documents.where(F.col("hourly").isNotNull())
        .withColumn("_fits", fits)
        .observe(seen, F.count_if("_fits").alias("good"), F.count_if(~F.col("_fits")).alias("bad"))
    )
    folder = hashlib.sha256(source.encode()).hexdigest()[:16]
    bad = marked.where(~F.col("_fits")).select(F.to_json(F.struct("hourly")).alias("value"))
    bad.write.mode("overwrite").text(f"{quarantine}/source={folder}")
    return marked.where("_fits").drop("_fits"), dict(seen.get)


def hourly_rows(documents: DataFrame) -> DataFrame:
    """One row per hour of each document; arrays of unequal length are an error."""
    hours = F.arrays_zip(*_arrays())
    checked = F.when(_same_length(), hours).otherwise(
        F.raise_error(F.lit("hourly arrays have different lengths"))
    )
    return documents.where(F.col("hourly").isNotNull()).select(F.inline(checked))
