"""Pick up newly landed files and append what the fact does not hold yet.

The stored fact is partitioned by a month column. A batch reads only the months
in which a filter of digests says that some of its rows may be, and files already written are never rewritten. How the batch meets
those months is left to the planner, which goes by sizes. A batch that is replayed, also one
that failed half way through its write, finds its own rows in the history and
appends only the rest.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.operators.sets import rows_in, rows_not_in
from gridloom.streaming import digests


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def _touched(history: DataFrame, batch: DataFrame, month: str) -> DataFrame:
    """The history restricted to the months of the batch; one short text per month."""
    months = [row[0] for row in batch.select(month).distinct().collect()]
    touched = F.col(month).isin(*(m for m in months if m is not None))
    if None in months:
        touched = touched | F.col(month).isNull()
    return history.where(touched)


def read_fact(spark: SparkSession, fact_path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(fact_path).select(*schema.names)


def append_new_rows(
    new: DataFrame,
    fact_path: str,
    schema: StructType,
    month: str,
    latest_first: str | None = None,
) -> None:
    """Append the different rows of ``new`` that the stored fact lacks.

    The filter of the fact's rows says which rows may be there already; only their months
    are read, and only they are compared. A fact without the filter is read in all months of
    the batch. Files are written in descending order of ``latest_first``.
    """
    order = [F.col(month), *([F.desc(latest_first)] if latest_first else [])]
    spark = new.sparkSession
    columns = schema.names
    rows = new.select(*columns).dropDuplicates().persist()
    kept = [rows]
    try:
        if not _exists(spark, fact_path):
            missing, filtered = rows, True
        elif filtered := digests.exists(spark, fact_path):
            asked = digests.maybe_stored(rows, digests.stored(spark, fact_path), month, columns).persist()
            known = rows_in(asked, _touched(read_fact(spark, fact_path, schema), asked, month)).persist()
            kept += [asked, known]
            missing = rows_not_in(rows, known)
        else:
            missing = rows_not_in(rows, _touched(read_fact(spark, fact_path, schema), rows, month))
        if filtered:
            digests.add(missing, fact_path, month, columns)
        (
            missing.hint("rebalance", month)
            .sortWithinPartitions(*order)
            .write.mode("append")
            .partitionBy(month)
            .parquet(fact_path)
        )
    finally:
        for df in kept:
            df.unpersist()


def refresh(
    landed: DataFrame,
    to_fact_rows: Callable[[DataFrame], DataFrame],
    fact_path: str,
    schema: StructType,
    month: str,
    checkpoint: str,
    latest_first: str | None = None,
    remembered: str | None = None,
) -> None:
    """Run every landed file not seen before through to the stored fact.

    ``landed`` is a streaming scan of the landing folder. The call returns when
    the files present at its start are done; call it again for later ones. With ``remembered``, an
    interval such as ``7 days``, the stream's state keeps the digests of landed rows that long
    after their arrival: a row that arrives again meanwhile goes no further, in this run or after
    a restart. Later repeats, and rows of any age, are met by the fact as without it.
    """
    if remembered is not None:
        landed = first_arrivals(landed, remembered)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_new_rows(to_fact_rows(batch), fact_path, schema, month, latest_first)

    query = (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def first_arrivals(landed: DataFrame, remembered: str) -> DataFrame:
    """The rows of a stream without repeats that arrive within ``remembered`` of each other.

    State is keyed by two digests of the row and goes by the time of arrival, which only
    grows; so rows of old instants are never too late.
    """
    columns = landed.columns
    nulls = F.concat(*(F.col(f"`{c}`").isNull().cast("string") for c in columns))
    quoted = [F.col(f"`{c}`") for c in columns]
    digest = {f"_digest{k}": F.xxhash64(*quoted, nulls, F.lit(k)) for k in (1, 2)}
    arrived = landed.withColumns({**digest, "_arrived": F.current_timestamp()})
    fresh = arrived.withWatermark("_arrived", remembered).dropDuplicatesWithinWatermark(list(digest))
    return fresh.drop(*digest, "_arrived")


def landed_parquet(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
