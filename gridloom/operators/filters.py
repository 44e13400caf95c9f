"""Row filters."""

from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.dates import wall_clock
from gridloom.functions.numbers import as_number
from gridloom.operators.quantiles import approx_quartiles
from gridloom.operators.rowindex import with_row_index


def equals(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.where(F.col(name) == value)


def above(df: DataFrame, name: str, limit: float) -> DataFrame:
    """Values over the limit; NaN is not."""
    return df.where((F.col(name) > limit) & ~F.isnan(name))


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def keep_numeric(
    df: DataFrame, *names: str, number_type: str = "double"
) -> DataFrame:
    """Cast the columns to numbers and drop rows where one is none."""
    numbers = df.withColumns(
        {name: as_number(F.col(name), number_type) for name in names}
    )
    for name in names:
        numbers = numbers.where(F.col(name).isNotNull())
    return numbers


def up_to(df: DataFrame, name: str, cutoff: datetime | None = None) -> DataFrame:
    """Drop rows stamped after the cut-off, by default the current wall clock."""
    limit = F.localtimestamp() if cutoff is None else wall_clock(cutoff)
    return df.where(F.col(name) <= limit)


def last_day(df: DataFrame, name: str, day: date) -> DataFrame:
    """Rows of the given day and the day before.

    Written as a range on the bare column so that it reaches the scan.
    """
    start = datetime.combine(day - timedelta(days=1), datetime.min.time())
    end = datetime.combine(day + timedelta(days=1), datetime.min.time())
    return df.where(
        (F.col(name) >= wall_clock(start)) & (F.col(name) < wall_clock(end))
    )


def within_quartiles(df: DataFrame, name: str) -> DataFrame:
    """Rows whose floor lies between the first and third quartile of the column.

    Adds the floor under the two names the outlier report uses. The quartiles are
    scalar subqueries of one aggregate; nothing runs before the result does.
    """
    bounds = approx_quartiles(df, name)
    first, third = bounds.select("q1").scalar(), bounds.select("q3").scalar()
    floor = F.floor(name)
    flagged = df.withColumns(
        {f"floor_{name}_imputed": floor, f"outlier_{name}_imputed": floor}
    )
    return flagged.where(floor.between(first, third))


def scenario_by_position(
    df: DataFrame,
    order_by: list[str],
    scenery: str,
    shares: tuple[tuple[int, int, str], ...],
    last: str,
) -> DataFrame:
    """Keep the rows whose scenario is the one expected at their position.

    Rows are ordered by ``order_by``, which must leave no ties between unequal
    rows. ``shares`` holds ``(numerator, denominator, scenario)`` in ascending
    order: up to 0-based position ``n * numerator // denominator`` that
    scenario is expected, and ``last`` after the final one.
    """
    indexed = with_row_index(df, order_by, name="_row", total="_rows", first=0)
    expected: Column = F.lit(last)
    for numerator, denominator, name in reversed(shares):
        end = F.floor(F.col("_rows") * numerator / denominator)
        expected = F.when(F.col("_row") <= end, F.lit(name)).otherwise(expected)
    return indexed.where(F.col(scenery) == expected).drop("_row", "_rows")
