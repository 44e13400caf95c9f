"""Aggregations. All of them combine on the map side before any shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.constants import ZONES


def exact_mean_of_tenths(value: Column) -> Column:
    """Mean of values that have one decimal, the same for any row order.

    Adding doubles in a different order changes the last bits, which would make
    a recomputed row differ from its copy in the history. Whole tenths add up
    exactly; groups with values beyond that range use the plain mean.
    """
    tenths = F.rint(value * 10).try_cast("bigint")
    exact = F.try_sum(tenths) / (F.count(tenths) * 10)
    whole = F.count(value) == F.count(tenths)
    return F.coalesce(F.when(whole, exact), F.avg(value))


def mean_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean of one-decimal values per group; rows with a null key are left out."""
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(exact_mean_of_tenths(F.col(value)).alias(value))
    )


def sum_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.dropna(subset=[key]).groupBy(key).agg(F.sum(value).alias(value))


def limit_violations(
    df: DataFrame, key: str, value: str, lowest: float, highest: float
) -> DataFrame:
    """Readings under and over the limits per group."""
    x = F.col(value)
    return (
        df.dropna(subset=[key])
        .groupBy(key)
        .agg(
            F.count_if(x < lowest).alias("BaixaTensao"),
            F.count_if((x > highest) & ~F.isnan(x)).alias("AltaTensao"),
        )
    )


def count_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Non-null values per group."""
    return df.dropna(subset=[key]).groupBy(key).agg(F.count(value).alias(value))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def last_value(df: DataFrame, value: str, order_by: list[str]) -> DataFrame:
    """Value of the last row in the order given; one row."""
    return df.agg(F.max_by(value, F.struct(*order_by)).alias(value))


def latest_per_zone(
    df: DataFrame,
    value: str,
    instant: str,
    tie: list[str],
    zones: tuple[str, ...] = ZONES,
) -> DataFrame:
    """Value at the last instant of each zone; a zone without rows is absent.

    ISO instants order as text, so a malformed one takes its place among them and
    loses no row. One pass: each task keeps one row per zone of the fixed list.
    """
    rows = df.where(F.col("zone").isin(*zones))
    last = F.max_by(value, F.struct(instant, *(c for c in tie if c != instant)))
    return rows.groupBy("zone").agg(last.alias(value))
