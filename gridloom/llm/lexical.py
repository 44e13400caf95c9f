"""Ranked lexical search over posting lists that are cut into geometric blocks.

A document's part in a score is its impact for a term, an integer that grows with the
term's occurrences and falls with the document's length; an item's score is the
sum of impacts times the weights of its terms. Documents are indexed in shards. In a shard, every
term has its posting list; a long list is clustered by how similar its documents
are, and each cluster is a block. A block keeps the coordinatewise maximum of its
documents' impacts, over all terms (as in Bruch et al., "Efficient Inverted Indexes
for Approximate Retrieval over Learned Sparse Representations"). Nothing is rounded
or cut from these summaries, so weights times maxima are a true bound: a block is
skipped only when its bound is below the last score that still counts, and every document of
other blocks is scored in full. A document must be met in the list of its heaviest
term only, so terms heavier than a block's own do not count for its bound. The result is exact.

A task carries its best documents from shard to shard, so later shards skip more.
"""

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, new_folder, text_or_empty
from gridloom.llm.terms import ALPHANUMERIC, FILTER_BITS, Shard, bit_filter, entries, shards

#: Fixed values of the score: its length part, the share that follows the length, saturation.
LENGTH_BASE, LENGTH_SHARE, SCALE, OCCURRENCES, LENGTHS = 100, 90, 1_000_000_000, 1000, 8
WEIGHT_SCALE = 1000
BEST = 10
#: Documents of a block, on average; lists up to this length are one block.
BLOCK = 64
#: Texts and bytes of text that are indexed together.
SHARD_TEXTS, SHARD_BYTES = 1024, 1 << 22
#: Directions that documents are compared in when a list is clustered.
SKETCH = 32
#: Cells of blocks by terms, and documents, that summaries are made of at once.
HELD_CELLS, HELD_MEMBERS = 1 << 21, 1 << 13
#: Blocks that are opened together, at first; then twice as many each time.
OPENED = 4
#: Items that are searched in one pass over the index, and terms of theirs.
ITEMS, ITEM_TERMS = 512, 1 << 17
#: Fixed value: what terms consist of.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- one shard's index -------------------------------------------------------


def impacts(counts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The impact of each entry, at most a million; ``sizes`` are of the documents."""
    base = LENGTH_BASE - LENGTH_SHARE
    m = np.array([base + LENGTH_SHARE * n * documents // max(1, length) for n in sizes.tolist()], np.int64)
    counts = counts.astype(np.int64)
    return SCALE * counts // (OCCURRENCES * counts + LENGTHS * m[rows])


def sketches(rows: np.ndarray, codes: np.ndarray, values: np.ndarray, documents: int, words: int) -> np.ndarray:
    """A short unit vector per document whose inner products tell similar documents."""
    held = np.bincount(codes, minlength=words)
    signs = np.random.default_rng(words).choice(np.array([-1, 1], np.float32), (words, SKETCH))
    heavy = (values * np.log((1 + documents) / np.maximum(held[codes], 1))).astype(np.float32)
    found = np.zeros((documents, SKETCH), np.float32)
    for k in range(SKETCH):
        found[:, k] = np.bincount(rows, heavy * signs[codes, k], minlength=documents)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-30)


def _narrow(codes: np.ndarray, words: int) -> np.ndarray:
    """The codes in two bytes if they fit, which sort in linear time."""
    return codes.astype(np.uint16) if words <= 1 << 16 else codes


def clustered(members: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The cluster of each member of a posting list, by its most similar centre."""
    parts = -(-len(members) // BLOCK)
    centres = members[np.linspace(0, len(members) - 1, parts).astype(int)]
    return (near[members] @ near[centres].T).argmax(axis=1)


class Index:
    """Posting lists in blocks, the blocks' maxima by term, and the documents' own impacts.

    ``list_ends`` counts blocks by list, ``block_ends`` members by block; ``top_*`` are the maxima
    of each term over the blocks that hold it.
    """

    KINDS = {
        "ids": "<i8",
        "no_id": "u1",
        "ends": "<i8",
        "codes": "<i4",
        "values": "<i4",
        "list_ends": "<i4",
        "block_ends": "<i8",
        "members": "<i4",
        "top_ends": "<i8",
        "top_blocks": "<i4",
        "top_values": "<i4",
    }

    def __init__(self, words: list[str], **columns: np.ndarray):
        self.words = words
        self.__dict__.update(columns)

    @classmethod
    def build(cls, shard: Shard, words: list[str], documents: int, length: int) -> "Index":
        rows = shard.rows()
        values = impacts(shard.counts, shard.sizes, rows, documents, length)
        near = sketches(rows, shard.codes, values, len(shard.ids), len(words))
        by_word = np.argsort(_narrow(shard.codes, len(words)), kind="stable")
        sizes = np.bincount(shard.codes, minlength=len(words))
        lists = np.concatenate([[0], np.cumsum(sizes)])
        members, labels, blocks = rows[by_word], np.zeros(len(by_word), np.int64), np.minimum(sizes, 1)
        for k in np.flatnonzero(sizes > BLOCK).tolist():
            part = slice(lists[k], lists[k + 1])
            used, labels[part] = np.unique(clustered(members[part], near), return_inverse=True)
            blocks[k] = len(used)
        list_ends = np.cumsum(blocks)
        block = labels + np.repeat(list_ends - blocks, sizes)
        order = np.argsort(block, kind="stable")
        members, block_ends = members[order], np.cumsum(np.bincount(block, minlength=int(blocks.sum())))
        top_block, top_code, top_value = cls._summaries(block_ends, members, shard, values, len(words))
        by_code = np.argsort(_narrow(top_code, len(words)), kind="stable")
        return cls(
            words,
            ids=shard.ids,
            no_id=shard.no_id,
            ends=shard.ends,
            codes=shard.codes,
            values=values.astype("<i4"),
            list_ends=list_ends,
            block_ends=block_ends,
            members=members,
            top_ends=np.cumsum(np.bincount(top_code, minlength=len(words))),
            top_blocks=top_block[by_code],
            top_values=top_value[by_code],
        )

    @staticmethod
    def _summaries(
        block_ends: np.ndarray, members: np.ndarray, shard: Shard, values: np.ndarray, words: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block, term and largest impact, for each term that a block's documents hold."""
        values = values.astype(np.int32)
        step = max(1, HELD_CELLS // max(1, words))
        blocks, codes, tops = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for first in range(0, len(block_ends), step):
            ends = block_ends[first : first + step]
            start = int(block_ends[first - 1]) if first else 0
            owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=start))
            most = np.zeros(len(ends) * words, np.int32)
            # A few documents of these blocks at a time, however many they have.
            for a in range(start, int(ends[-1]), HELD_MEMBERS):
                part = members[a : min(a + HELD_MEMBERS, int(ends[-1]))]
                at, sizes = entries(shard.ends, part)
                row = owner[a - start : a - start + len(part)] * words
                np.maximum.at(most, np.repeat(row, sizes) + shard.codes[at], values[at])
            cells = np.flatnonzero(most)
            blocks.append((cells // words + first).astype(np.int32))
            codes.append((cells % words).astype(np.int32))
            tops.append(most[cells])
        return np.concatenate(blocks), np.concatenate(codes), np.concatenate(tops)

    def columns(self) -> list[pa.Array]:
        parts = ((getattr(self, name), kind) for name, kind in self.KINDS.items())
        return [*(pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in parts)]

    @classmethod
    def read(cls, row: dict) -> "Index":
        return cls(row["words"], **{name: np.frombuffer(row[name], kind) for name, kind in cls.KINDS.items()})

    def bounds(self, codes: list[int], weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The blocks of the terms' lists, and a bound for the scores that begin there.

        A document is looked for in the list of its heaviest term. So lighter terms alone, and the
        list's own, count for a block's bound, and blocks of light terms seldom need opening.
        """
        bound = np.zeros(len(self.block_ends), np.int64)
        blocks, bounds = [], []
        for weight, code in sorted(zip(weights, codes)):
            part = slice(self.top_ends[code - 1] if code else 0, self.top_ends[code])
            bound[self.top_blocks[part]] += weight * self.top_values[part].astype(np.int64)
            own = slice(self.list_ends[code - 1] if code else 0, self.list_ends[code])
            blocks.append(np.arange(own.start, own.stop))
            bounds.append(bound[own])
        return np.concatenate(blocks), np.concatenate(bounds)

    def scores(self, documents: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The full score of each document; ``weight`` is by term."""
        at, sizes = entries(self.ends, documents)
        sums = np.concatenate([[0], np.cumsum(weight[self.codes[at]] * self.values[at])])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


class Best:
    """The ``BEST`` highest scores so far; equal scores by id, those without one last."""

    def __init__(self, size: int = BEST):
        self.size, self.heap = size, []

    def least(self) -> int:
        """The score below which nothing counts."""
        return self.heap[0][0] if len(self.heap) == self.size else 1

    def add(self, score: int, no_id: int, number: int) -> None:
        row = (score, -no_id, -number)
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, row)
        elif row > self.heap[0]:
            heapq.heapreplace(self.heap, row)


def search(index: Index, place: dict[str, int], terms: list[tuple[str, int]], best: Best) -> tuple[int, int]:
    """Put the shard's documents into ``best``; how many blocks there were, and how many were opened."""
    known = [(place[t], w) for t, w in terms if w > 0 and t in place]
    if not known:
        return 0, 0
    codes, weights = [c for c, _ in known], [w for _, w in known]
    blocks, bound = index.bounds(codes, weights)
    order = np.argsort(-bound, kind="stable")
    blocks, bound = blocks[order], bound[order]
    weight = np.zeros(len(index.words), np.int64)
    weight[codes] = weights
    seen = np.zeros(len(index.ids), bool)
    first, step = 0, OPENED
    while first < len(blocks) and bound[first] >= best.least():
        last = min(first + step, int(np.searchsorted(-bound, -best.least(), "right")))
        opened = blocks[first:last]
        starts = np.where(opened > 0, index.block_ends[opened - 1], 0)
        fresh = np.zeros(len(seen), bool)
        for a, b in zip(starts.tolist(), index.block_ends[opened].tolist()):
            fresh[index.members[a:b]] = True
        documents = np.flatnonzero(fresh & ~seen)
        seen |= fresh
        scores = index.scores(documents, weight)
        good = scores >= best.least()
        found = documents[good]
        for row in zip(scores[good].tolist(), index.no_id[found].tolist(), index.ids[found].tolist()):
            best.add(*row)
        first, step = last, 2 * step
    return len(blocks), first


# --- Spark -------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, terms``: each row's different terms under a number of its own."""
    lower = F.translate(text_or_empty(), UPPER, LOWER)
    found = F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), found.alias("terms"))
    return rows.withColumn("item", F.monotonically_increasing_id())


INDEX_COLUMNS = "words array<string>, " + ", ".join(f"{name} binary" for name in Index.KINDS)


def term_shards(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The documents' counts of the terms in ``word``, and perhaps of others, in shards."""
    bits = bit_filter(terms)

    def passes(word: bytes) -> bool:
        place = zlib.crc32(word) % FILTER_BITS
        return bool(bits[place >> 3] >> (place & 7) & 1)

    return checkpoint(shards(docs, ALPHANUMERIC, passes=passes, texts=SHARD_TEXTS, size=SHARD_BYTES))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [np.frombuffer(s, "<i8") for s in batch.column(0).to_pylist()]
        columns = ([int((s > 0).sum()) for s in sizes], [int(s.sum()) for s in sizes])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "length"])


def statistics(parts: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and the terms of all, with repeats."""
    sums = parts.select("sizes").mapInArrow(_totals, "n long, length long").agg(F.sum("n"), F.sum("length")).first()
    return sums[0] or 0, sums[1] or 0


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield from batch.slice(k, 1).to_pylist()


def build_index(parts: DataFrame, documents: int, length: int) -> DataFrame:
    """One row per shard, with the columns of :class:`Index`; it can be stored and asked again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            index = Index.build(Shard.read(row), row["words"], documents, length)
            words = pa.array([row["words"]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([words, *index.columns()], names=["words", *Index.KINDS])

    return parts.select(*Shard.KINDS, "words").mapInArrow(run, INDEX_COLUMNS)


Item = tuple[int, int | None, list[tuple[str, int]]]


def _searcher(items: list[Item], size: int, index_of: Callable[[dict], Index]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(size) for _ in items]
        for row in _rows(batches):
            index = index_of(row)
            place = {word: code for code, word in enumerate(index.words)}
            for (_, _, terms), mine in zip(items, best):
                search(index, place, terms, mine)
        rows = [
            (item, item_id, None if no_id else -number, score)
            for (item, item_id, _), mine in zip(items, best)
            for score, no_id, number in mine.heap
        ]
        columns = list(zip(*rows)) or [()] * 4
        names = ["item", "item_id", "doc_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


FOUND = "item long, item_id long, doc_id long, score long"


def found(index: DataFrame, items: list[Item], best: int = BEST) -> DataFrame:
    """``item, item_id, doc_id, score`` of the best documents that each task finds in a stored index."""
    return index.mapInArrow(_searcher(items, best, Index.read), FOUND)


def found_once(parts: DataFrame, documents: int, length: int, items: list[Item], best: int = BEST) -> DataFrame:
    """As :func:`found`, by an index that each task builds shard by shard and then lets go."""

    def index_of(row: dict) -> Index:
        return Index.build(Shard.read(row), row["words"], documents, length)

    return parts.select(*Shard.KINDS, "words").mapInArrow(_searcher(items, best, index_of), FOUND)


def weighted(terms: DataFrame, parts: DataFrame, documents: int) -> DataFrame:
    """``item, item_id, weights``: each item's terms that documents hold, with their weights."""
    asked = terms.select("item", "item_id", F.explode("terms").alias("word"))
    df = (
        parts.select(F.explode(F.arrays_zip("words", "held")).alias("x"))
        .groupBy(F.col("x.words").alias("word"))
        .agg(F.sum("x.held").alias("df"))
    )
    ratio = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1)
    weight = F.floor(WEIGHT_SCALE * F.log(ratio)).cast("long")
    return (
        asked.join(df, "word")
        .groupBy("item", "item_id")
        .agg(F.collect_list(F.struct("word", weight.alias("weight"))).alias("weights"))
    )


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """Each item's highest-scoring documents: ``item_id, rank, doc_id, score``.

    Every row of ``items`` (``item_id, text``) is asked; repeated rows give repeated results.
    Every row of ``docs`` takes part, repeats as documents of their own. Null texts have
    no terms. Scores are above 0; equal ones go by ascending ``doc_id``, a null id
    last. An empty table on either side gives an empty table.
    """
    terms = checkpoint(item_terms(items))
    parts = term_shards(docs, terms.select(F.explode("terms").alias("word")))
    documents, length = statistics(parts)
    weights = checkpoint(weighted(terms, parts, documents))
    # Items go to the tasks in parts of bounded size, each by a pass over the same index.
    sizes = weights.agg(F.count("*").alias("items"), F.sum(F.size("weights")).alias("terms")).first()
    passes = max(1, -(-sizes["items"] // ITEMS), -(-(sizes["terms"] or 0) // ITEM_TERMS))
    if passes > 1:  # an index that is asked more than once is stored
        path = new_folder(docs.sparkSession, "lexical-index")
        build_index(parts, documents, length).write.parquet(path)
        index = docs.sparkSession.read.parquet(path)
    met = None
    for k in range(passes):
        asked = weights.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).orderBy("item").toArrow().to_pylist()
        part = [(r["item"], r["item_id"], [(w["word"], w["weight"]) for w in r["weights"]]) for r in asked]
        rows = found(index, part, best) if passes > 1 else found_once(parts, documents, length, part, best)
        met = rows if met is None else met.union(rows)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return met.withColumn("rank", rank).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
