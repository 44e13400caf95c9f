"""Scans of landed files and the choice of the newest one."""

import csv
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from gridloom.sources import records
from gridloom.staging import stage

# Keep microseconds, and read instants with or without a fraction.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
# Holds the line of a CSV row that does not fit its schema.
MALFORMED = "_malformed"


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One record per line; splittable. A glob path reads many files in one scan."""
    return (
        spark.read.schema(schema)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def read_json_documents(
    spark: SparkSession, path: str, schema: StructType
) -> DataFrame:
    """One array or object per file. A file cannot be split, so land many of them."""
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Objects of JSON arrays, one array per file; a file of several lines is read by many tasks.

    The same rows as :func:`read_json_documents`. Elements that do not fit the schema are null
    in what does not fit. Only lines can be told apart: an array on a single line is one task's.
    """
    lines = records.json_lines(spark, path)
    found = records.records(lines, records.open_starts(lines, records.splits_of(lines)))
    # A record is one element or several, with the array's own brackets and commas around it.
    text = F.regexp_replace(F.btrim("text", F.lit(" \t\r")), r"^,|,$", "")
    text = F.when(F.col("first"), F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    closed = F.regexp_replace(text, r"^\s*\]?\s*$|(?<=[}\s])\s*\]\s*$", "")
    options = {"timestampNTZFormat": TIMESTAMP_FORMAT}
    elements = F.from_json(F.concat(F.lit("["), closed, F.lit("]")), ArrayType(schema), options)
    return found.select(F.explode(elements).alias("row")).select("row.*")


def _csv_options(sep: str, null_text: str) -> dict:
    return {"sep": sep, "escape": '"', "nullValue": null_text, "timestampNTZFormat": TIMESTAMP_FORMAT}


def _header(line: str, sep: str) -> list[str]:
    return next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")], delimiter=sep), [])


def parse_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ";",
    free_text: bool = False,
    null_text: str = "",
) -> DataFrame:
    """The rows of CSV files and, in ``_malformed``, the text of those that do not fit the schema.

    Each file is read by its own header: it names the columns of the schema in any order, or it
    is an error. One file is read by many tasks, also where quoted text holds line breaks.
    """
    lines = records.csv_lines(spark, path, free_text)
    splits = records.splits_of(lines).persist()
    try:
        starts = records.open_starts(lines, splits) if free_text else {}
        # Files with the usual header need no entry; the others are few, or are an error.
        usual = sep.join(schema.names)
        unusual = splits.where((F.col("block") == 0) & (F.rtrim("first", F.lit("\r")) != usual))
        layouts: dict[tuple[str, ...], list[int]] = {}
        for row in unusual.select("file", "first", "path").toArrow().to_pylist():
            names = _header(row["first"], sep)
            if sorted(names) != sorted(schema.names):
                raise ValueError(f"{row['path']} has the columns {names}, not {schema.names}")
            if names != schema.names:
                layouts.setdefault(tuple(names), []).append(row["file"])
    finally:
        splits.unpersist()
    found = records.records(lines, starts)
    body = found.where(~F.col("first") & (F.rtrim("text", F.lit("\r")) != ""))
    options = _csv_options(sep, null_text) | {"columnNameOfCorruptRecord": MALFORMED, "mode": "PERMISSIVE"}

    def parsed(names: list[str]) -> Column:
        marked = StructType([*(schema[n] for n in names), StructField(MALFORMED, StringType())])
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.fields)
        row = F.from_csv(F.rtrim("text", F.lit("\r")), kinds, options)
        return F.struct(*(row[n].alias(n) for n in (*schema.names, MALFORMED)))

    row = parsed(schema.names)
    for names, files in layouts.items():
        row = F.when(F.col("file").isin(*files), parsed(list(names))).otherwise(row)
    return body.select(row.alias("row")).select("row.*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ";",
    free_text: bool = False,
    null_text: str = "",
    quarantine: str | None = None,
) -> DataFrame:
    """A file whose header names other columns than the schema is an error.

    With ``free_text``, quoted text may hold line breaks, and each file is one task's; see
    :func:`parse_csv` for large ones. Unquoted ``null_text`` is null; where it is not
    empty, empty text stays empty. Rows that do not fit the schema are null in what
    does not fit; with ``quarantine`` they are left out and their lines stored there, in
    a folder that belongs to ``path``: reading it again replaces the folder. Files are
    then split and may differ in the order of their columns.
    """
    if quarantine is None:
        options = {"header": True, "enforceSchema": False, "multiLine": free_text}
        return spark.read.options(**options, **_csv_options(sep, null_text)).schema(schema).csv(path)
    # Parsed once; both outputs read what was kept.
    rows = stage(parse_csv(spark, path, schema, sep, free_text, null_text))
    source = hashlib.sha256(path.encode()).hexdigest()[:16]
    bad = rows.where(F.col(MALFORMED).isNotNull()).select(MALFORMED)
    bad.write.mode("overwrite").text(f"{quarantine}/source={source}")
    return rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, key below the folder and modification time of every file; contents are not read."""
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    root = system.makeQualified(base).toString()
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
        .withColumn("key", F.expr(f"substring(path, {len(root) + 2})"))
    )


def newest_file(files: DataFrame, contains: str | None = None) -> DataFrame:
    """One row with the newest path whose key holds the text; null when none does."""
    if contains is not None:
        files = files.where(F.col("key").contains(contains))
    return files.agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    )


def latest_file(
    spark: SparkSession, folder: str, contains: str | None = None
) -> str | None:
    """Newest file below the folder; an empty folder is an error."""
    files = list_files(spark, folder)
    path = newest_file(files, contains).first()["path"]
    if path is None and files.isEmpty():
        raise FileNotFoundError(f"no files below {folder}")
    return path


def latest_table(
    spark: SparkSession, zone: str, contains: str
) -> str | None:
    """Folder of the newest finished run published under a name holding the text.

    Published tables are folders ``<name>/run=<stamp>`` with a mark of success,
    and a name has at most one prefix. Only names that hold the text are listed,
    and of their runs only the marks; a run that is still being written has none.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    prefix, _, name = contains.rpartition("/")
    depths = [f"*{prefix}/{name}*"] if prefix else [f"*{name}*", f"*/*{name}*", f"*{name}*/*"]
    found = []
    for depth in depths:
        pattern = hadoop(f"{zone}/{depth}/run=*/_SUCCESS")
        system = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        for status in system.globStatus(pattern) or []:
            run = status.getPath().getParent()
            found.append((status.getModificationTime(), run.getName(), run.toString()))
    return max(found)[2] if found else None


def read_table_or_empty(
    spark: SparkSession, path: str | None, schema: StructType, sep: str | None = None
) -> DataFrame:
    """The stored table, or no rows when there is none yet; with ``sep``, stored as CSV.

    Only the missing path means "start empty"; any other failure is raised.
    """
    if path is None:
        return spark.createDataFrame([], schema)
    if sep is not None:
        return read_csv(spark, path, schema, sep)
    return spark.read.schema(schema).parquet(path)
