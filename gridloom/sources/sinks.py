"""File sinks and publication into a zone."""

import sys
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.sources.scans import TIMESTAMP_FORMAT

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lines of a JSON array file, and the most records that a line holds.
LINES_PER_FILE = 50
RECORDS_PER_LINE = 10_000


def first_rows(
    df: DataFrame, limit: int | None, order_by: list[Column] | None
) -> DataFrame:
    """The first ``limit`` rows in the order given; all rows without a limit."""
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)


def write_json(
    df: DataFrame,
    path: str,
    limit: int | None = None,
    order_by: list[Column] | None = None,
) -> None:
    """JSON lines: every file can be split and appended to."""
    (
        first_rows(df, limit, order_by)
        .write.option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def _arrays_of(records: int):
    """One line per so many records; every ``LINES_PER_FILE`` lines form an array.

    Lines fill up across batches, so files do not depend on how large batches are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        held, lines = None, 0
        for batch in batches:
            waiting.extend(batch["value"])
            while len(waiting) > records:
                if held is not None:
                    yield pd.DataFrame({"value": [held]})
                held, waiting = _line(waiting[:records], lines), waiting[records:]
                lines += 1
        if held is not None and waiting:
            yield pd.DataFrame({"value": [held]})
        if waiting:
            end = "]" if (lines + 1) % LINES_PER_FILE else ""
            yield pd.DataFrame({"value": [_line(waiting, lines) + end]})

    return run


def _line(records: list[str], lines: int) -> str:
    lead = "," if lines % LINES_PER_FILE else "["
    end = "" if (lines + 1) % LINES_PER_FILE else "]"
    return lead + ",\n".join(records) + end


def write_json_array(
    df: DataFrame,
    path: str,
    limit: int | None = None,
    order_by: list[Column] | None = None,
    records_per_line: int = RECORDS_PER_LINE,
) -> None:
    """JSON arrays, one per file, for readers that expect documents.

    Records are rendered by Spark; Python only puts brackets and commas between
    them, line by line. Such a file is later read by one task, so arrays end,
    and files with them, after a fixed number of records.
    """
    rows = first_rows(df, limit, order_by)
    records = rows.select(
        F.to_json(
            F.struct(*rows.columns), {"timestampNTZFormat": TIMESTAMP_FORMAT}
        ).alias("value")
    )
    (
        records.mapInPandas(
            _arrays_of(records_per_line), StructType([StructField("value", StringType())])
        )
        .write.option("maxRecordsPerFile", LINES_PER_FILE)
        .text(path)
    )


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ";",
    limit: int | None = None,
    order_by: list[Column] | None = None,
    null_text: str = "",
) -> None:
    """Empty text is quoted; null is ``null_text``, which :func:`read_csv` takes again."""
    (
        first_rows(df, limit, order_by)
        .write.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("nullValue", null_text)
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


WRITERS = {"json": write_json, "json_array": write_json_array}


def publish(
    df: DataFrame,
    zone: str,
    name: str,
    stamp: datetime | None = None,
    partition_by: str | None = None,
    fmt: str = "parquet",
    sep: str = ";",
) -> str:
    """Write a table below ``<zone>/<name>`` in a folder of its own run.

    ``name`` may carry a prefix (``consumo/Fato_Consumo``). Earlier runs stay,
    and readers pick the newest. With ``partition_by``, rows are rebalanced by
    that column, so few files are written per value and a value holding much of
    the table is still spread over several tasks. ``fmt`` may also name one of
    the text sinks, which are not partitioned; ``sep`` separates columns of CSV.
    """
    run = (stamp or datetime.now()).strftime("%Y%m%dT%H%M%S%f")
    path = f"{zone}/{name}/run={run}"
    if fmt == "csv":
        write_csv(df, path, sep)
    elif fmt in WRITERS:
        WRITERS[fmt](df, path)
    elif partition_by is None:
        df.write.format(fmt).save(path)
    else:
        rows = df.hint("rebalance", partition_by)
        rows.write.format(fmt).partitionBy(partition_by).save(path)
    return path
