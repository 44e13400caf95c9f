"""Quartiles of many runs from stored KLL sketches, without reading the runs again.

A sketch of K values puts a quantile's rank off by about 2.3 / K ** 0.9 of all rows,
with 99 % confidence, and is exact for up to about K rows. Sketches merge without loss of
that bound, and in any order; a tree of merges keeps any one task from reading them all.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import as_number

# The bound of a sketch's error is ERROR / K ** POWER; the largest K there is.
ERROR, POWER, LARGEST = 2.3, 0.9, 65535
# About one row in a thousand; a sketch takes some 50 kB.
K = 4096
# Sketches that one task merges.
FAN_IN = 64


def numbers(name: str) -> Column:
    return F.nanvl(as_number(F.col(name)), F.lit(None))


def sketched(df: DataFrame, name: str, run: str, k: int = K) -> DataFrame:
    """One sketch per run: ``run, sketch``; null and NaN do not count."""
    return df.groupBy(F.col(run).alias("run")).agg(F.kll_sketch_agg_double(numbers(name), k).alias("sketch"))


def merged(sketches: DataFrame, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """One row with the sketch of all runs, merged up a tree of groups of about ``fan_in``."""
    level = sketches.where("sketch is not null").select(F.xxhash64("run").alias("at"), "sketch")
    groups = max(1, -(-level.count() // fan_in))
    while groups > 1:
        level = level.groupBy(F.pmod("at", F.lit(groups)).alias("at")).agg(
            F.kll_merge_agg_double("sketch", k).alias("sketch")
        )
        groups = -(-groups // fan_in)
    return level.agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quartiles(sketch: DataFrame) -> DataFrame:
    """``q1, q3`` and the number of rows behind a merged sketch; null without rows."""
    some = F.col("sketch").isNotNull() & (F.kll_sketch_get_n_double("sketch") > 0)
    at = {"q1": 0.25, "q3": 0.75}
    found = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(n) for n, p in at.items()]
    return sketch.select(*found, F.when(some, F.kll_sketch_get_n_double("sketch")).otherwise(0).alias("rows"))
