"""Means kept as sums and counts, so that a late reading amends its mean.

Each load stores what it adds to the groups' sums, in a folder of its own number; a load
that runs again replaces its folder. A mean is made of all stored parts when it is
read, in whichever order they came. Whole tenths are summed as integers, so the
order does not show in the result either.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

PARTS = StructType(
    [
        StructField("tenths", LongType()),
        StructField("exact", LongType()),
        StructField("total", DoubleType()),
        StructField("n", LongType()),
    ]
)


def partial_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """What the rows add to their groups; rows with a null key are left out."""
    tenths = F.rint(F.col(value) * 10).try_cast("bigint")
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.try_sum(tenths).alias("tenths"),
            F.count(tenths).alias("exact"),
            F.sum(value).alias("total"),
            F.count(value).alias("n"),
        )
    )


def merged_sums(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One part per group; a sum of tenths beyond its range makes the group's a null."""
    tenths = F.when(F.count_if(F.col("tenths").isNull() & (F.col("exact") > 0)) == 0, F.try_sum("tenths"))
    return parts.groupBy(*keys).agg(
        tenths.alias("tenths"), F.sum("exact").alias("exact"), F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def means_of(parts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The groups' means, as ``operators.aggregates.mean_by`` gives them for all rows at once."""
    whole = F.col("exact") == F.col("n")
    exact = F.when(whole & (F.col("exact") > 0), F.col("tenths") / (F.col("exact") * 10))
    plain = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return merged_sums(parts, keys).select(*keys, F.coalesce(exact, plain).alias(value))


def store(parts: DataFrame, path: str, load: int) -> None:
    """Keep a load's parts under its number; the same number again replaces them."""
    parts.write.mode("overwrite").parquet(f"{path}/load={load}")


def read(spark: SparkSession, path: str, keys: StructType) -> DataFrame:
    """All stored parts; ``keys`` is the schema of the group keys."""
    return spark.read.schema(StructType([*keys.fields, *PARTS.fields])).parquet(f"{path}/load=*")


def compact(spark: SparkSession, path: str, keys: StructType, to: str) -> None:
    """Write one part per group to the path ``to``, as its load 0; later loads go there, numbered from 1."""
    store(merged_sums(read(spark, path, keys), keys.names), to, 0)
