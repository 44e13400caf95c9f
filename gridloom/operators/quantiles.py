"""Quartiles from mergeable sketches."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.sketches import ERROR, FAN_IN, LARGEST, POWER, numbers, quartiles

# A quartile's rank is off by at most about one in this many rows. Tables of fewer rows
# than a sketch holds values, 60,000 here, get their exact quartiles.
ACCURACY = 9_000


def approx_quartiles(df: DataFrame, name: str, accuracy: int = ACCURACY) -> DataFrame:
    """One row with the first and third quartile; null and NaN do not count.

    Each task makes a sketch. They merge in two steps of groups of tasks before they meet, so no
    task reads the sketches of all.
    """
    k = min(LARGEST, ceil((ERROR * accuracy) ** (1 / POWER)))
    rows = df.select(numbers(name).alias("x"), F.spark_partition_id().alias("task"))
    level = rows.groupBy(F.floor(F.col("task") / FAN_IN).alias("task")).agg(
        F.kll_sketch_agg_double("x", k).alias("sketch")
    )
    level = level.groupBy(F.floor(F.col("task") / FAN_IN).alias("task")).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    return quartiles(level.agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))).select("q1", "q3")
