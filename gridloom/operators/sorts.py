"""Sorts and top-k. Ties are broken by the further columns given.

Equal rows are spread over partitions by a running id from the input, which
should be a scan or a staged table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    spread = df.withColumn("_copy", F.monotonically_increasing_id())
    return spread.orderBy(*order, "_copy").drop("_copy")


def sort_desc(df: DataFrame, name: str, *tie: str) -> DataFrame:
    return _sorted(df, [F.desc(c) for c in (name, *tie)])


def sort_asc(df: DataFrame, name: str, *tie: str) -> DataFrame:
    return _sorted(df, [F.asc(c) for c in (name, *tie)])


def top_k(df: DataFrame, k: int, name: str, *tie: str) -> DataFrame:
    """The first k rows in descending order."""
    return df.orderBy(*(F.desc(c) for c in (name, *tie))).limit(k)
