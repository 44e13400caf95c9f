"""Connected components of a graph given as edges between long ids.

Large-star and small-star steps alternate (Kiveris et al., "Connected Components
in MapReduce and Beyond"): both only ever hold one smallest neighbour per node,
so a node with very many neighbours is an aggregate and a skew-splittable join,
never a list. Each step is checkpointed.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint


def forest(sources: list[int], targets: list[int]) -> dict[int, int]:
    """Each node of the edges and the smallest node of its component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for u, v in zip(sources, targets):
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stars = forest(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        pairs = [(x, top) for x, top in stars.items() if x != top]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["src", "dst"]
        )


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges with src > dst."""
    if large:
        edges = edges.union(edges.select(F.col("dst"), F.col("src")))
    edges = edges.toDF("u", "v")
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = edges.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    else:
        moved = moved.select(F.col("v").alias("src"), F.col("m").alias("dst")).union(
            least.select("u", "m")
        )
    return moved.where("src > dst").distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("src", "dst").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    ``edges`` has two long columns; direction, repeats and loops do not matter.
    A node that only has loops is left out, like any node without an edge: callers
    take such nodes as components of their own. Nulls are not allowed.
    """
    pairs = edges.toDF("a", "b").where("a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
    current = checkpoint(pairs.mapInArrow(_thin, "src long, dst long").distinct())
    state = _state(current)
    while state[0]:
        current = checkpoint(_stars(_stars(current, large=True), large=False))
        state, before = _state(current), state
        if state == before:
            break
    tops = current.select(F.col("dst").alias("node")).distinct()
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )
