"""The latest value per zone, kept up to date by a stream.

The stream's state holds one row per zone, the one of the greatest instant so far, so
batches may come in any order. After each batch the zones that changed replace their rows in
the stored table: a new generation of the table is written and readers take the newest
finished one. A batch that runs again writes the same generation again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.constants import ZONES
from gridloom.operators.aggregates import latest_per_zone


def _generations(spark: SparkSession, path: str) -> list[int]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    system = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getParent().getName() for status in system.globStatus(pattern) or []]
    return sorted(int(name.split("=")[1]) for name in names)


def read_latest(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The newest generation, or the newest before a batch; no rows when there is none."""
    found = [n for n in _generations(spark, path) if before is None or n < before]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch={found[-1]}")


def keep_latest(
    readings: DataFrame,
    value: str,
    instant: str,
    tie: list[str],
    path: str,
    checkpoint: str,
    zones: tuple[str, ...] = ZONES,
) -> None:
    """Bring the table at ``path`` up to date with all readings that have landed; returns when that is done."""
    latest = latest_per_zone(readings, value, instant, tie, zones)
    schema = latest.schema

    def replace(changed: DataFrame, batch: int) -> None:
        # One row per zone of a fixed list.
        stored = read_latest(changed.sparkSession, path, schema, before=batch)
        kept = stored.join(changed.select("zone"), "zone", "left_anti").unionByName(changed)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = (
        latest.writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
