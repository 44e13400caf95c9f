"""Union, dedupe and the append-and-dedupe history of the facts."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack by column name; a column missing on one side is null there."""
    return first.unionByName(second, allowMissingColumns=True)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def history_merge(
    history: DataFrame | None, new: DataFrame, columns: list[str]
) -> DataFrame:
    """History and new rows, each different row once.

    Not an upsert: a row whose measures changed stays next to its old version.
    """
    rows = new.select(*columns)
    if history is not None:
        rows = history.select(*columns).unionByName(rows)
    return rows.dropDuplicates()


def _match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in left.columns]
    return left.alias("l").join(right.alias("r"), reduce(and_, same), how)


def rows_not_in(new: DataFrame, history: DataFrame) -> DataFrame:
    """Different rows of ``new`` that the history does not hold; nulls compare equal.

    New rows are deduplicated first, so many copies of one row meet the join as
    a single row.
    """
    return _match(new.dropDuplicates(), history, "left_anti")


def rows_in(new: DataFrame, history: DataFrame) -> DataFrame:
    """Different rows of ``new`` that the history holds; nulls compare equal."""
    return _match(new.dropDuplicates(), history, "left_semi")
