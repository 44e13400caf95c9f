"""Records that reach over lines, read by many tasks from one file.

Spark's text scan cuts a file at any line. Whether a line ends a record follows from
all lines before it, but only through a sum: of quotes in CSV, of brackets in JSON. The first
pass adds up the change of each split, which makes one row per split; the sums of the
splits before tell the state that each split starts in. The second pass then puts
lines together to records within its split. What a split's first record lacks at
its start, and its last one at its end, goes through one small shuffle.
"""

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a row of the second pass is; ``FIRST`` is the first record of its file.
WHOLE, HEAD, MIDDLE, TAIL, FIRST = 0, 1, 2, 3, 4
RECORDS = "file long, block long, kind int, text string"


@dataclass(frozen=True)
class Lines:
    """The lines of a path with their split and how they change the state of the reading."""

    rows: DataFrame
    # Whether a record can end where the changes so far add up to this.
    ends: Callable[[np.ndarray], np.ndarray]
    ends_column: Callable[[Column], Column]


def lines_of(
    spark: SparkSession,
    path: str,
    change: Callable[[Column], Column],
    ends: Callable[[np.ndarray], np.ndarray],
    ends_column: Callable[[Column], Column],
) -> Lines:
    text = spark.read.option("lineSep", "\n").text(path)
    rows = text.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        change(F.col("value")).cast("long").alias("change"),
        F.col("_metadata.file_path").alias("path"),
    )
    return Lines(rows, ends, ends_column)


def splits_of(lines: Lines) -> DataFrame:
    """One row per split: ``file, block, path``, its first line, and the sum of changes ``before`` it."""
    rows = lines.rows.withColumn("at", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "block").agg(
        F.sum("change").alias("change"), F.min_by("value", "at").alias("first"), F.min("path").alias("path")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("before", F.coalesce(F.sum("change").over(earlier), F.lit(0)))


def open_starts(lines: Lines, splits: DataFrame) -> dict[tuple[int, int], int]:
    """The splits that start inside a record, by file and block, and their sums before.

    At most an entry per split, of which Spark's driver keeps more when it plans the scan.
    """
    rows = splits.where((F.col("block") > 0) & ~lines.ends_column(F.col("before")))
    table = rows.select("file", "block", "before").toArrow()
    keys = zip(table.column("file").to_pylist(), table.column("block").to_pylist())
    return dict(zip(keys, table.column("before").to_pylist()))


class _Split:
    """The lines of one split so far."""

    def __init__(self, key: tuple[int, int], total: int, inside: bool):
        self.key, self.total, self.inside = key, total, inside
        self.opening = key[1] == 0
        self.waiting: list[pa.Array] = []

    def _rows(self, texts: pa.Array, kind: int) -> pa.RecordBatch:
        columns = [np.full(len(texts), k, np.int64) for k in self.key]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.array(np.full(len(texts), kind, np.int32)), texts],
            names=["file", "block", "kind", "text"],
        )

    def _joined(self, values: pa.Array, lasts: np.ndarray) -> pa.Array:
        """One text per record; ``lasts`` are the records' last lines."""
        if len(lasts) == len(values):
            return values
        offsets = pa.array(np.concatenate([[0], lasts + 1]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")

    def take(self, values: pa.Array, changes: np.ndarray, ends) -> Iterator[pa.RecordBatch]:
        totals = self.total + np.cumsum(changes)
        self.total = int(totals[-1])
        lasts = np.flatnonzero(ends(totals))
        if not len(lasts):
            self.waiting.append(values)
            return
        earlier = sum(map(len, self.waiting))
        done = pa.concat_arrays([*self.waiting, values.slice(0, int(lasts[-1]) + 1)])
        rest = values.slice(int(lasts[-1]) + 1)
        self.waiting = [rest] if len(rest) else []
        texts = self._joined(done, lasts + earlier)
        if self.inside or self.opening:
            yield self._rows(texts.slice(0, 1), HEAD if self.inside else FIRST)
            texts = texts.slice(1)
        self.inside = self.opening = False
        if len(texts):
            yield self._rows(texts, WHOLE)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            values = pa.concat_arrays(self.waiting)
            text = self._joined(values, np.array([len(values) - 1]))
            yield self._rows(text, MIDDLE if self.inside else TAIL)


def _assemble(starts: dict[tuple[int, int], int], ends: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: _Split | None = None
        for batch in batches:
            file, block = (batch.column(k).to_numpy() for k in (0, 1))
            new = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(file)]):
                if a == b:
                    continue
                key = (int(file[a]), int(block[a]))
                if split is None or split.key != key:
                    if split is not None:
                        yield from split.finish()
                    split = _Split(key, starts.get(key, 0), key in starts)
                yield from split.take(batch.column(2).slice(a, b - a), batch.column(3).to_numpy()[a:b], ends)
        if split is not None:
            yield from split.finish()

    return run


def records(lines: Lines, starts: dict[tuple[int, int], int]) -> DataFrame:
    """``file, first, text``: every record, ``first`` where it is the first of its file.

    A record that the end of the file leaves open is a record as well.
    """
    read = lines.rows.select("file", "block", "value", "change").mapInArrow(_assemble(starts, lines.ends), RECORDS)
    kind = F.col("kind")
    first = (kind == FIRST).alias("first")
    if not starts:
        # No record reaches over splits; one at the end of a file may still be open.
        return read.select("file", first, "text")
    whole = read.where(kind.isin(WHOLE, FIRST)).select("file", first, "text")
    parts = read.where(kind.isin(HEAD, MIDDLE, TAIL))
    order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.count_if(F.col("kind") == TAIL).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))), lambda x: x["text"]), "\n")
    crossing = parts.withColumn("number", number).groupBy("file", "number").agg(text.alias("text"))
    return whole.union(crossing.select("file", F.lit(False).alias("first"), "text"))


# --- the two formats ---------------------------------------------------------


def csv_lines(spark: SparkSession, path: str, free_text: bool = True) -> Lines:
    """A line of CSV ends a record where the quotes so far are even; quotes stand in quoted text only.

    Without ``free_text`` every line is a record.
    """
    if not free_text:
        return lines_of(spark, path, lambda v: F.lit(0), lambda n: n == 0, lambda n: n == 0)
    return lines_of(
        spark,
        path,
        lambda v: F.length(v) - F.length(F.replace(v, F.lit('"'), F.lit(""))),
        lambda n: n % 2 == 0,
        lambda n: n % 2 == 0,
    )


# A JSON string; it never reaches over a line.
JSON_STRING = r'"(?:[^"\\]|\\.)*+"'


def json_lines(spark: SparkSession, path: str) -> Lines:
    """A line of a JSON array ends a record where it leaves no bracket open but the array's."""

    def change(value: Column) -> Column:
        bare = F.regexp_replace(value, JSON_STRING, "")
        opened = F.length(bare) - F.length(F.translate(bare, "[{", ""))
        return opened - (F.length(bare) - F.length(F.translate(bare, "]}", "")))

    return lines_of(spark, path, change, lambda n: n <= 1, lambda n: n <= 1)
