"""A Bloom filter of row digests beside a stored fact.

A refresh asks it which of its rows the fact may hold already; only these need to
meet the fact's old rows. The filter is kept by month in blocks of ``BLOCK_BITS`` bits:
a row's digest picks a block and ``HASHES`` bits in it. Each append adds blocks for its own
rows, sized by their number, before it adds the rows; so the filter always covers the
fact, and a crash in between costs a needless comparison at most. Bits, once set,
stay: merging filters is a bitwise or. All steps are built-in expressions.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

FOLDER = "_digests"
# Bits of one bitmap aggregate, rows that fill a block to about one false hit in a hundred, and bits per row.
BLOCK_BITS, BLOCK_ROWS, HASHES = 32768, 2048, 7
SCHEMA = StructType(
    [
        StructField("month", StringType()),
        StructField("blocks", LongType()),
        StructField("block", LongType()),
        StructField("bits", BinaryType()),
    ]
)


def _path(fact_path: str) -> str:
    return f"{fact_path}/{FOLDER}"


def exists(spark: SparkSession, fact_path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{_path(fact_path)}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def _hash(columns: list[str], seed: int) -> Column:
    # A null would leave the hash as it was, so the marks of nulls are hashed as well.
    nulls = F.concat(*(F.col(c).isNull().cast("string") for c in columns))
    return F.xxhash64(*columns, nulls, F.lit(seed))


def _places(columns: list[str]) -> list[Column]:
    """The bits of a row in its block, counted from 1 as the bitmap aggregate does."""
    return [F.pmod(_hash(columns, k), F.lit(BLOCK_BITS)) for k in range(1, HASHES + 1)]


def blocks_of(rows: DataFrame, month: str, columns: list[str]) -> DataFrame:
    """The filter of ``rows``: ``month, blocks, block, bits``; months are as text."""
    name = F.col(month).cast("string")
    sizes = rows.groupBy(name.alias("month")).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
    marked = rows.select(name.alias("month"), _hash(columns, 0).alias("digest"), F.array(*_places(columns)).alias("places"))
    return (
        marked.alias("r")
        .join(sizes.alias("s"), F.col("r.month").eqNullSafe(F.col("s.month")))
        .select("r.month", "blocks", F.pmod("digest", "blocks").alias("block"), F.explode("places").alias("place"))
        .groupBy("month", "blocks", "block")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def add(rows: DataFrame, fact_path: str, month: str, columns: list[str]) -> None:
    blocks_of(rows, month, columns).write.mode("append").parquet(_path(fact_path))


def stored(spark: SparkSession, fact_path: str) -> DataFrame:
    """The filter, blocks of equal place merged."""
    parts = spark.read.schema(SCHEMA).parquet(_path(fact_path))
    return parts.groupBy("month", "blocks", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def compact(spark: SparkSession, fact_path: str, schema: StructType, month: str) -> None:
    """One filter per month again, from the fact itself; also the way to give an old fact a filter."""
    rows = spark.read.schema(schema).parquet(fact_path)
    blocks_of(rows, month, schema.names).write.mode("overwrite").parquet(_path(fact_path))


def _set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.shiftright(byte, 0).bitwiseAND(F.lit(1) * F.pow(2.0, place % 8).cast("int")) != 0


def maybe_stored(rows: DataFrame, filters: DataFrame, month: str, columns: list[str]) -> DataFrame:
    """The different rows that the fact may hold; none that it holds is missing."""
    generations = filters.select(F.col("month").alias("_of"), "blocks").distinct()
    asked = rows.withColumns({"_digest": _hash(columns, 0), "_places": F.array(*_places(columns))})
    placed = asked.join(generations, F.col(month).cast("string").eqNullSafe(F.col("_of")))
    same = F.col("_of").eqNullSafe(F.col("_month")) & (F.col("blocks") == F.col("_blocks"))
    met = placed.join(
        filters.select(
            F.col("month").alias("_month"), F.col("blocks").alias("_blocks"), F.col("block").alias("_block"), "bits"
        ),
        same & (F.pmod("_digest", "blocks") == F.col("_block")),
    )
    tests = [_set(F.col("bits"), F.col("_places")[k]) for k in range(HASHES)]
    return met.where(reduce(and_, tests)).select(*rows.columns).dropDuplicates()
