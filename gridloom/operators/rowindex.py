"""Gap-free global row numbers without a single-task sort.

Rows are range-partitioned and sorted, and each gets the number of its
partition and its position in it. That table is checkpointed: range bounds come
from a sample, so planning the same step twice could place rows differently,
while the kept table cannot change under the two reads that follow. The
number of rows before each partition, one short row per partition, then turns
positions into global numbers.

Equal rows are interchangeable, but equal sort keys cannot be split over
partitions. A running id from the input is therefore the last sort key, so that
a reading repeated very often still spreads out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.staging import stage

# ``monotonically_increasing_id`` keeps the position in the low 33 bits.
POSITION_BITS = 33


def _as_columns(order_by: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def with_row_index(
    df: DataFrame,
    order_by: list[str | Column],
    name: str = "row_id",
    total: str | None = None,
    first: int = 1,
    kind: str | None = None,
    kinds: tuple[str, ...] = (),
    after_sort: dict[str, Column] | None = None,
) -> DataFrame:
    """Number the rows in the order given, starting at ``first``.

    The call itself runs the sample, the sort and the checkpoint; the rest is lazy.

    ``order_by`` must tell unequal rows apart. ``df`` should come straight from
    a scan or a staged table, whose rows keep their places when a task is run
    again. With ``kind``, rows outside ``kinds`` are dropped and each kind is
    numbered on its own. ``total`` names a column for the number of rows (of
    the kind). ``after_sort`` replaces columns once they have served the order,
    so that what is no longer needed is not written.
    """
    keys = [kind] if kind else []
    if kind:
        df = df.where(F.col(kind).isin(*kinds))
    order = [*_as_columns([*keys, *order_by]), F.col("_copy")]
    placed = stage(
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_copy")
        .withColumns({**(after_sort or {}), "_slot": F.monotonically_increasing_id()})
    )
    placed = placed.withColumns(
        {
            "_part": F.shiftright("_slot", POSITION_BITS),
            "_position": F.col("_slot").bitwiseAND((1 << POSITION_BITS) - 1),
        }
    )
    parts = placed.groupBy(*keys, "_part").agg(
        F.min("_position").alias("_start"), F.count(F.lit(1)).alias("_size")
    )
    # At most one row per partition, plus one per kind.
    everything = Window.partitionBy(*keys)
    earlier = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_start") + first).alias(
            "_shift"
        ),
        F.sum("_size").over(everything).alias("_total"),
    )
    numbered = placed.join(F.broadcast(offsets), [*keys, "_part"])
    extra = [F.col("_total").alias(total)] if total else []
    return numbered.select(
        (F.col("_position") + F.col("_shift")).alias(name), *df.columns, *extra
    )
