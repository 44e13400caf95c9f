"""Documents as numbers: shards with a vocabulary of their own and the words' counts.

A shard is what one task has read, up to a bounded number of texts and bytes; its
documents are rows of a sparse matrix over the shard's different words. What is
known of words over all shards is joined by word, so a corpus is gathered through
vocabularies and not through every occurrence.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import BLANKS, text_or_empty

#: Texts and bytes of text that fill a shard.
SHARD_TEXTS, SHARD_BYTES = 4096, 1 << 23
#: Shards are numbered within a task by the low bits.
NUMBER_BITS = 32
#: Bits of a filter of words; more words let others pass and change nothing else.
FILTER_BITS = 1 << 23

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that stand between ASCII blanks.
BETWEEN_BLANKS = np.ones(256, bool)
BETWEEN_BLANKS[[ord(c) for c in BLANKS]] = False
#: Bytes of words of ASCII letters and digits and all other characters.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[128:] = ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = True


def numbered(texts: list[bytes], inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of all texts, lower-cased by ASCII, as numbers; the end of each text; the words.

    ``inside`` says which bytes words consist of; a blank is none of them.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = inside[data]
    kept = LOWER[data[word]]
    del data
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edges = np.concatenate([[0], edges])
    del word
    starts = edges[::2].copy()
    offsets = np.zeros(len(starts) + 1, "<i8")
    np.cumsum(edges[1::2] - starts, out=offsets[1:])
    del edges
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    ).dictionary_encode()
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return found.indices.to_numpy(), ends, found.dictionary


def narrowed(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32 in as many bytes each as the largest needs."""
    width = -(-int(values.max(initial=1)).bit_length() // 8)
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def widened(data: bytes, many: int) -> np.ndarray:
    found = np.zeros((many, 4), np.uint8)
    if many:
        found[:, : len(data) // many] = np.frombuffer(data, np.uint8).reshape(many, -1)
    return found.view("<u4").ravel().astype(np.int32)


@dataclass
class Shard:
    """Documents by row, words by column; entries are sorted by both."""

    ids: np.ndarray
    no_id: np.ndarray
    marked: np.ndarray
    sizes: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    counts: np.ndarray

    KINDS = {"ids": "<i8", "no_id": "u1", "marked": "u1", "sizes": "<i8", "ends": "<i8", "codes": "", "counts": ""}

    @classmethod
    def read(cls, row: dict) -> "Shard":
        found = {name: np.frombuffer(row[name], kind) for name, kind in cls.KINDS.items() if kind}
        many = int(found["ends"][-1]) if len(found["ends"]) else 0
        return cls(**found, **{name: widened(row[name], many) for name, kind in cls.KINDS.items() if not kind})

    def columns(self) -> list[pa.Array]:
        parts = ((getattr(self, name), kind) for name, kind in self.KINDS.items())
        return [pa.array([x.astype(kind).tobytes() if kind else narrowed(x)], pa.binary()) for x, kind in parts]

    def rows(self) -> np.ndarray:
        """The document of each entry."""
        return np.repeat(np.arange(len(self.ids)), np.diff(self.ends, prepend=0))


COLUMNS = (
    "shard long, "
    + ", ".join(f"{name} binary" for name in Shard.KINDS)
    + ", words array<string>, held array<long>, learned array<long>"
)


def _shard(ids: pa.Array, marked: np.ndarray, texts: list[bytes], inside: np.ndarray, passes) -> list[pa.Array]:
    """All columns but the shard's number."""
    codes, ends, words = numbered(texts, inside)
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if passes is not None:
        kept = np.fromiter(map(passes, words.to_pylist()), bool, len(words))
        place = np.cumsum(kept) - 1
        some = kept[codes]
        owner, codes, words = owner[some], place[codes[some]], words.filter(pa.array(kept))
    width = max(1, len(words))
    owner *= width
    owner += codes
    owner.sort()
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    counts = np.diff(first, append=len(owner))
    rows, columns = np.divmod(owner[first], width)
    del owner, first
    ids64 = ids.fill_null(0).to_numpy()
    no_id = ids.is_null().to_numpy(zero_copy_only=False)
    shard = Shard(ids64, no_id, marked, sizes, np.searchsorted(rows, np.arange(len(texts)), "right"), columns, counts)
    held = np.bincount(columns, minlength=len(words))
    learned = np.bincount(columns, counts * marked[rows], minlength=len(words)).astype(np.int64)
    lists = (pa.array([x.tolist()], pa.list_(pa.int64())) for x in (held, learned))
    return [*shard.columns(), pa.array([words.cast(pa.large_string()).to_pylist()], pa.list_(pa.string())), *lists]


def shards(
    docs: DataFrame,
    inside: np.ndarray,
    marked: Column | None = None,
    passes: Callable[[bytes], bool] | None = None,
    texts: int = SHARD_TEXTS,
    size: int = SHARD_BYTES,
) -> DataFrame:
    """One row per shard, with the columns of ``COLUMNS``.

    ``held`` says how many documents of the shard hold each word, ``learned`` how often
    it occurs in those that are ``marked``. A document's size counts all its words; only words
    that ``passes`` takes are kept. Null texts are empty. Checkpoint the result before it is read twice:
    shards follow what a task reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << NUMBER_BITS
        waiting: list[tuple[pa.Array, pa.Array, list[bytes]]] = []
        held, length = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, length
            ids = pa.concat_arrays([w[0] for w in waiting])
            marks = pa.concat_arrays([w[1] for w in waiting]).to_numpy(zero_copy_only=False)
            bodies = [text for w in waiting for text in w[2]]
            row = [pa.array([number], pa.int64()), *_shard(ids, marks, bodies, inside, passes)]
            number, held, length = number + 1, 0, 0
            waiting.clear()
            return pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in COLUMNS.split(", ")])

        for batch in batches:
            bodies = batch.column(2).cast(pa.binary())
            first, part = 0, []
            for k in range(batch.num_rows):
                part.append(bodies[k].as_py())
                held, length = held + 1, length + len(part[-1])
                full = held >= texts or length >= size
                if full or k + 1 == batch.num_rows:
                    waiting.append((batch.column(0).slice(first, len(part)), batch.column(1).slice(first, len(part)), part))
                    first, part = k + 1, []
                if full:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.lit(True) if marked is None else marked).alias("marked"),
        text_or_empty().alias("body"),
    )
    return rows.mapInArrow(run, COLUMNS)


def bit_filter(words: DataFrame) -> bytes:
    """A bit per CRC-32 of the column ``word``; at most ``FILTER_BITS`` bits reach the driver."""
    place = F.pmod(F.crc32("word"), F.lit(FILTER_BITS))
    parts = (
        words.select(F.floor(place / 32).alias("at"), (place % 32).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 32, "<u4")
    bits[parts.column("at").to_numpy()] = parts.column("bits").to_numpy()
    return bits.tobytes()


def entries(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of ``rows``, and how many each row has."""
    starts = np.concatenate([[0], ends[:-1]])[rows]
    sizes = ends[rows] - starts
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(int(sizes.sum())) + shift, sizes
