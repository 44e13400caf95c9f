"""A log of what has landed in a zone, so that jobs need not list the zone.

The log is a folder of the zone whose name scans pass over. Spark's streaming file
source feeds it: each run notes the files that are new since the last one, keys,
sizes and times, without opening them. A batch that runs again replaces its own
entries. Compaction writes one entry per key, the newest, and readers then start from
there. The newest file of a name is one aggregate over the log.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from gridloom.sources.scans import newest_file

FOLDER = "_manifest"
SCHEMA = StructType(
    [
        StructField("key", StringType()),
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("modificationTime", TimestampType()),
        StructField("batch", LongType()),
    ]
)
# The file source's own columns, which it wants without nulls; contents are not read.
LANDED = StructType(
    [
        StructField("path", StringType(), False),
        StructField("modificationTime", TimestampType(), False),
        StructField("length", LongType(), False),
        StructField("content", BinaryType(), True),
    ]
)
NULLABLE = "spark.sql.streaming.fileSource.schema.forceNullable"
# Batches after which a feed compacts the log by itself.
COMPACT_AFTER = 50


def _log(zone: str) -> str:
    return f"{zone}/{FOLDER}/log"


def _parts(spark: SparkSession, zone: str) -> tuple[int, list[int]]:
    """The batch that the newest compaction reaches, -1 without any, and the finished batches after it."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{_log(zone)}/*=*/_SUCCESS")
    system = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getParent().getName() for status in system.globStatus(pattern) or []]
    numbers: dict[str, list[int]] = {"batch": [], "upto": []}
    for kind, number in (name.split("=") for name in names):
        numbers[kind].append(int(number))
    start = max(numbers["upto"], default=-1)
    return start, sorted(n for n in numbers["batch"] if n > start)


def _system_root(spark: SparkSession, zone: str) -> str:
    base = spark._jvm.org.apache.hadoop.fs.Path(zone)
    system = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(base).toString()


def feed(spark: SparkSession, zone: str) -> None:
    """Note every file below the zone that no earlier feed has noted. One feed runs at a time.

    Empty files are not noted, nor is a file that is written again under a noted key.
    """
    root = _system_root(spark, zone)
    session = spark.newSession()
    session.conf.set(NULLABLE, False)
    landed = (
        session.readStream.format("binaryFile")
        .schema(LANDED)
        .option("recursiveFileLookup", True)
        .load(zone)
        .drop("content")
        .withColumn("key", F.expr(f"substring(path, {len(root) + 2})"))
    )

    def note(rows: DataFrame, batch: int) -> None:
        rows = rows.withColumn("batch", F.lit(batch).cast("long")).select(*SCHEMA.names)
        rows.write.mode("overwrite").parquet(f"{_log(zone)}/batch={batch}")

    query = (
        landed.writeStream.foreachBatch(note)
        .option("checkpointLocation", f"{zone}/{FOLDER}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if len(_parts(spark, zone)[1]) > COMPACT_AFTER:
        compact(spark, zone)


def entries(spark: SparkSession, zone: str) -> DataFrame | None:
    """The log's entries, one or more per key; None where no feed has run."""
    start, batches = _parts(spark, zone)
    paths = [f"{_log(zone)}/batch={n}" for n in batches]
    if start >= 0:
        paths.append(f"{_log(zone)}/upto={start}")
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else None


def compact(spark: SparkSession, zone: str) -> None:
    """Keep the newest entry of each key; finished batches stay until someone removes them."""
    start, batches = _parts(spark, zone)
    if not batches:
        return
    entry = F.struct(*SCHEMA.names)
    newest = F.max_by(entry, F.struct("modificationTime", "batch", "path"))
    kept = entries(spark, zone).groupBy("key").agg(newest.alias("entry")).select("entry.*")
    kept.write.mode("overwrite").parquet(f"{_log(zone)}/upto={batches[-1]}")


def latest_file(spark: SparkSession, zone: str, contains: str | None = None) -> str | None:
    """Newest noted file whose key holds the text; a zone without any file is an error.

    Only a zone that was never fed is fed here; feeding it as files land is a job of its own.
    """
    log = entries(spark, zone)
    if log is None:
        feed(spark, zone)
        log = entries(spark, zone)
    if log is None or log.isEmpty():
        raise FileNotFoundError(f"no files below {zone}")
    return newest_file(log, contains).first()["path"]
