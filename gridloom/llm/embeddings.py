"""Near-duplicate embeddings: a small-world graph per shard, every shard asked.

Equal vectors become one. Vectors are dealt into shards of a bounded number; each
shard's graph is built in one task. Two shards then meet in one task, and the vectors of
either are looked up in the other's graph: a beam walks the graph and widens while it
is full of vectors above the threshold. Vectors that a bound proves to have no link in that
shard take no walk. An audit compares the answers with a full
comparison for some of the vectors. It takes what each of them finds of its links and of
its nearest neighbours, so those without links count as well, and each as much as the others;
the beam of all widens until the audit passes, in the end to a full comparison. All
candidates are verified by cosine in double precision. A link found from either end counts at
both. A task hands on how many links each vector has and only as many of the
links as connect what it found.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint
from gridloom.llm.components import connected_components
from gridloom.llm.hnsw import Graph

THRESHOLD = 0.9
#: Vectors a shard holds on average, of however many dimensions: a walk pays from some hundred on.
SHARD_ROWS = 8192
#: Shards made even of small tables, so that their graphs are built side by side, if they get so many vectors.
LEAST_SHARDS, LEAST_ROWS = 8, 1024
BEAM = 64
BATCH = 512
#: Vectors of a shard that the audit compares in full, and their nearest ones that it looks for besides
#: links. What it asks for, as the mean by vector: of the links almost all; of the nearest ones, which
#: without links are hardly more similar than chance, enough to show that walks lead there.
AUDITED = 256
NEAREST = 4
RECALL, NEAREST_RECALL = 0.995, 0.9
#: How far below the threshold a single-precision similarity is still verified.
MARGIN = 1e-3
#: A beam of one in so many of a shard gives way to a full comparison, so many vectors at a time;
#: so shards of up to 256 vectors, whose graph is hardly more than one level, are always compared in full.
EXACT_SHARE, EXACT_ROWS = 4, 64
#: One in so many of the dimensions, those that hold most, are multiplied for the bound; the lengths of the others complete it.
BOUND_SHARE = 2
#: Partitions of shards, as a multiple of the session's: few shards seldom meet in one.
SPREAD = 4
#: Batches' worth of rows that a part may have where few of them are open.
SPARSE = 8


# --- one shard against another ---------------------------------------------


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few pairs that connect what the pairs ``a, b`` connect: each node with its smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    top = np.arange(len(nodes))
    while True:
        least = np.minimum(top[left], top[right])
        before = top.copy()
        np.minimum.at(top, left, least)
        np.minimum.at(top, right, least)
        top = top[top]
        if (top == before).all():
            break
    other = top != np.arange(len(nodes))
    return nodes[other], nodes[top[other]]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """In double precision, each times a power of two that keeps squares within range and digits as they are."""
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = _scaled(vectors)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _parts(possible: np.ndarray) -> Iterator[slice]:
    """Parts of about ``BATCH`` open rows each, ``SPARSE`` times as many rows at most; all begin at whole bytes of bits."""
    opened = np.concatenate([[0], np.cumsum(possible)])
    start = 0
    while start < len(possible):
        stop = int(np.searchsorted(opened, opened[start] + BATCH, "right")) - 1
        stop = min(stop, start + SPARSE * BATCH, len(possible))
        if stop < len(possible):
            stop = max(start + 8, stop // 8 * 8)
        yield slice(start, stop)
        start = stop


class Shard:
    """A shard's vectors and graph; finds all that are similar enough to a query."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, links=None):
        self.ids, self.copies, self.vectors = ids, copies, vectors
        self.graph = Graph(_unit(vectors), links)
        heavy = np.argsort(-np.square(self.graph.vectors).sum(axis=0), kind="stable")
        self.heavy = np.sort(heavy[: -(-len(heavy) // BOUND_SHARE)])
        self.short = self._shortened(self.graph.vectors)

    def _shortened(self, unit: np.ndarray) -> np.ndarray:
        """The heavy dimensions and the length of the rest: no two products are less than those of whole vectors."""
        kept = unit[:, self.heavy]
        rest = np.delete(unit, self.heavy, axis=1)
        return np.concatenate([kept, np.linalg.norm(rest, axis=1, keepdims=True)], axis=1)

    def possible(self, ids: np.ndarray, queries: np.ndarray, least: float) -> np.ndarray:
        """Which unit ``queries`` may have another vector of the shard that is similar; the others have none.

        A product is the heavy dimensions' and at most, by Cauchy-Schwarz, the lengths' of the rest.
        """
        order = np.argsort(self.ids)
        place = order[np.minimum(np.searchsorted(self.ids, ids, sorter=order), len(order) - 1)]
        own = self.ids[place] == ids
        short, most = self._shortened(queries), np.zeros(len(queries), np.float32)
        for a in range(0, len(queries), EXACT_ROWS):
            sums = short[a : a + EXACT_ROWS] @ self.short.T
            here = np.flatnonzero(own[a : a + EXACT_ROWS])
            sums[here, place[a + here]] = -np.inf
            most[a : a + EXACT_ROWS] = sums.max(axis=1)
        return most >= least

    def near(self, queries: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of unit ``queries`` and of the shard that are similar; full beams are widened."""
        rows, found = [], []
        open_rows = np.arange(len(queries))
        while len(open_rows):
            if not self._walks(beam):
                for a in range(0, len(open_rows), EXACT_ROWS):
                    part = open_rows[a : a + EXACT_ROWS]
                    row, other = np.nonzero(queries[part] @ self.graph.vectors.T >= least)
                    rows.append(part[row])
                    found.append(other)
                break
            ids, sims = self.graph.search(queries[open_rows], beam)
            full = (sims[:, -1] >= least) & (ids.shape[1] < len(self.ids))
            hit = (sims >= least) & ~full[:, None]
            rows.append(open_rows[np.nonzero(hit)[0]])
            found.append(ids[hit])
            open_rows, beam = open_rows[full], beam * 4
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *found])

    def _walks(self, beam: int) -> bool:
        """Wider beams cost more than a full comparison, and miss what no link leads to."""
        return beam * EXACT_SHARE < len(self.ids)

    def recall(self, ids: np.ndarray, queries: np.ndarray, beam: int, least: float) -> tuple[float, float]:
        """What unit ``queries`` find of their links, if they have any, and of their nearest ones, on average."""
        sims = queries @ self.graph.vectors.T
        sims[ids[:, None] == self.ids[None, :]] = -np.inf
        links, nearest = sims >= least, np.zeros(sims.shape, bool)
        size = min(NEAREST, len(self.ids) - 1)
        np.put_along_axis(nearest, np.argpartition(-sims, size, axis=1)[:, :size], True, 1)
        nearest &= np.isfinite(sims)
        met = np.zeros(sims.shape, bool)
        near, found = self.graph.search(queries, beam)
        place = np.nonzero(np.isfinite(found))
        met[place[0], near[place]] = True
        full = np.flatnonzero(found[:, -1] >= least)
        row, other = self.near(queries[full], 4 * beam, least)
        met[full[row], other] = True
        linked = links.any(axis=1)
        of_links = (met & links)[linked].sum(axis=1) / links[linked].sum(axis=1)
        of_nearest = (met & nearest).sum(axis=1) / np.maximum(nearest.sum(axis=1), 1)
        return float(of_links.mean()) if linked.any() else 1.0, float(of_nearest.mean())

    def audited(self, ids: np.ndarray, queries: np.ndarray, least: float) -> int:
        """A beam whose answers to some of the queries are complete enough."""
        beam = BEAM
        picked = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
        while self._walks(beam):
            links, nearest = self.recall(ids[picked], queries[picked], beam, least)
            if links >= RECALL and nearest >= NEAREST_RECALL:
                break
            beam *= 2
        return beam

    def hits(
        self, ids: np.ndarray, vectors: np.ndarray, threshold: float
    ) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For parts of the vectors: rows of the part and of the shard that link."""
        unit, least = _unit(vectors), threshold - MARGIN
        possible = self.possible(ids, unit, least)
        beam = self.audited(ids, unit, least) if possible.any() else BEAM
        wide = _scaled(self.vectors)
        norms = np.linalg.norm(wide, axis=1)
        for part in _parts(possible):
            open_rows = np.flatnonzero(possible[part])
            row, other = self.near(unit[part][open_rows], beam, least)
            row = open_rows[row]
            different = ids[part][row] != self.ids[other]
            row, other = row[different], other[different]
            mine = _scaled(vectors[part])[row]
            cosine = np.einsum("nd,nd->n", mine, wide[other]) / (
                np.linalg.norm(mine, axis=1) * norms[other]
            )
            yield part, row[cosine >= threshold], other[cosine >= threshold]

    def links(
        self, ids: np.ndarray, vectors: np.ndarray, threshold: float
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For parts of the vectors: ids, how many rows each links with, and connecting pairs."""
        for part, row, other in self.hits(ids, vectors, threshold):
            count = np.bincount(row, self.copies[other], minlength=len(ids[part]))
            yield ids[part], count.astype(np.int64), *spanning(ids[part][row], self.ids[other])


def links_between(
    left: Shard, right: Shard, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As ``Shard.links`` for the vectors of both; what either end finds counts at both.

    The shards are different, or one and the same object.
    """
    back = np.zeros((len(right.ids), -(-len(left.ids) // 8)), np.uint8)
    for part, row, other in left.hits(right.ids, right.vectors, threshold):
        np.bitwise_or.at(back[part], (row, other >> 3), (128 >> (other & 7)).astype(np.uint8))
    theirs = np.zeros(len(right.ids), np.int64)
    for part, row, other in right.hits(left.ids, left.vectors, threshold):
        ids, copies = left.ids[part], left.copies[part]
        found = np.unpackbits(back[:, part.start // 8 : -(-part.stop // 8)], axis=1)[:, : len(ids)].T.astype(bool)
        found[row, other] = True
        row, other = np.nonzero(found)
        count = np.bincount(row, right.copies[other], minlength=len(ids))
        theirs += np.bincount(other, copies[row], minlength=len(theirs)).astype(np.int64)
        yield ids, count.astype(np.int64), *spanning(ids[row], right.ids[other])
    if left is not right:
        none = np.zeros(0, np.int64)
        yield right.ids, theirs, none, none


# --- Spark -------------------------------------------------------------------


def _array(values: pa.Table, dimensions: int) -> np.ndarray:
    flat = values.column("embedding").combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _build(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("order").to_numpy(), kind="stable")
    dimensions = table.column("dimensions")[0].as_py()
    vectors = _array(table, dimensions)[order]
    ids, copies = (table.column(c).to_numpy()[order].astype("<i8") for c in ("node", "copies"))
    shard = Shard(ids, copies, vectors)
    links = [level.astype("<i4").tobytes() for level in shard.graph.links]
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
            "dimensions": pa.array([dimensions], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "copies": pa.array([copies.tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([links], pa.list_(pa.binary())),
        }
    )


def _restored(row: dict) -> Shard:
    ids = np.frombuffer(row["ids"], "<i8")
    links, size = [], len(ids)
    for data in row["links"]:
        links.append(np.frombuffer(data, "<i4").reshape(size, -1))
        size = -(-size // 16)
    kind = f"<f{len(row['vectors']) // (len(ids) * row['dimensions'])}"
    vectors = np.frombuffer(row["vectors"], kind).reshape(len(ids), -1)
    return Shard(ids, np.frombuffer(row["copies"], "<i8"), vectors, links)


def _searcher(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left = _restored(row["left"])
                right = left if row["shard"] == row["other"] else _restored(row["right"])
                for nodes, count, a, b in links_between(left, right, threshold):
                    some = count > 0
                    alone = pa.nulls(int(some.sum()), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[some]), alone, pa.array(count[some])],
                        names=["node", "other", "links"],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))],
                        names=["node", "other", "links"],
                    )

    return run


def _deal():
    """A column that deals the vectors of one length into shards."""
    rows = F.col("rows")
    few = F.least(F.lit(LEAST_SHARDS), F.floor(rows / LEAST_ROWS))
    parts = F.greatest(F.lit(1), few, F.ceil(rows / SHARD_ROWS))
    return F.pmod(F.xxhash64("node"), parts.cast("long"))


def found_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, other, links``: counts of links by node and pair of shards, and connecting pairs.

    ``vectors`` has ``node``, a number of its own, ``embedding``, which is neither
    zero nor repeated, and ``copies``, its number of rows. Only vectors of equal length are compared.
    """
    sized = vectors.withColumn("dimensions", F.size("embedding"))
    # A number that is given: a shard is few bytes but much work, and tasks must not be merged by size.
    tasks = SPREAD * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lengths = sized.groupBy("dimensions").agg(F.count("*").alias("rows"))
    dealt = sized.join(lengths, "dimensions").withColumn("order", F.xxhash64("node", F.lit(1)))
    shards = (
        dealt.withColumn("shard", _deal())
        .select("shard", "dimensions", "node", "copies", "embedding", "order")
        .repartition(tasks, "dimensions", "shard")
        .groupBy("dimensions", "shard")
        .applyInArrow(
            _build,
            "shard long, dimensions int, ids binary, copies binary, vectors binary, links array<binary>",
        )
    )
    shards = checkpoint(shards)
    names = shards.select("dimensions", "shard")
    first, second = F.col("first"), F.col("second")
    even = (first + second) % 2 == 0  # each shard is the first of about half its pairs
    pairs = (
        names.withColumnRenamed("shard", "first")
        .join(names.withColumnRenamed("shard", "second"), "dimensions")
        .where(first <= second)
        .select(
            "dimensions",
            F.when(even, first).otherwise(second).alias("shard"),
            F.when(even, second).otherwise(first).alias("other"),
        )
    )
    data = F.struct("ids", "copies", "vectors", "links", "dimensions")
    met = (
        pairs.join(shards.select("dimensions", "shard", data.alias("left")), ["dimensions", "shard"])
        .repartition(tasks, "dimensions", "other")
        .join(
            shards.select("dimensions", F.col("shard").alias("other"), data.alias("right")).repartition(
                tasks, "dimensions", "other"
            ),
            ["dimensions", "other"],
        )
        .select("shard", "other", "left", "right")
    )
    return met.mapInArrow(_searcher(threshold), "node long, other long, links long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each row's ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, nor do vectors of different lengths. Components are compared as given, in single
    or double precision, and cosines taken in double. Rows of equal vectors link
    with each other. The component id is the smallest ``vec_id`` that links reach,
    nulls aside; a row is ``kept`` if that is its own. An empty table gives an
    empty table.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = (
        F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0.0)
    )
    single = embeddings.select("embedding").schema[0].dataType.simpleString() == "array<float>"
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"),
    ).withColumn("embedding", F.when(usable, F.col("embedding")))
    vectors = checkpoint(
        rows.where("embedding is not null")
        .groupBy("embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    found = checkpoint(found_links(vectors.select("node", "embedding", "copies"), threshold))
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("others"))
    placed = connected_components(found.where("other is not null").select("node", "other"))
    known = checkpoint(
        vectors.join(counts, "node", "left")
        .join(placed, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("copies") - 1)
    )
    names = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(names, "component").select("embedding", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return rows.join(named, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
