"""Exact duplicates through a minimal perfect hash over the digests seen so far.

An index holds every distinct digest of a corpus. It is cut into shards by digest
bits. In each shard a minimal perfect hash (bit arrays by level, a key that
collides moves on to the next level) gives every digest a slot of its own; the
slot holds the full digest and where the winner of its group is. A lookup goes
to one slot and compares all 32 bytes, so a digest that the index does not know
is never mistaken for another. Such nonmembers are grouped among themselves. Without an
earlier corpus, a part of the table's own rows is the history.

Rows reach the shards as a stream behind their shard's index, in as many salted
lanes as the shard's rows ask for: a group that holds a third of all rows spreads
over many tasks, and no task holds more than one shard of bounded size. Each lane gets a copy of
its shard's index, so a lane has rows enough to be worth it.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import BLANKS, ROW_KEY, checkpoint, keep_rows, row_key, text_or_empty

#: Digests a shard holds on average; a shard of this size takes about 250 kB.
SHARD_DIGESTS = 4096
#: A shard's rows go to lanes of one in this many of all rows.
LANES = 1024
#: Rows of a lane at least; the copies of the index then take some 250 bytes a row at most.
LANE_ROWS = 1024
DIGEST_BYTES = 32
#: One in so many rows, by hash, is the history that the others are looked up in.
HISTORY = 2
#: Positions in a level of the hash, per digest that reaches it.
LOAD = 2
#: What a shard stores besides its hash and digests: one value per slot.
SLOTS = {"winner": "<i8", "no_id": "u1", "winner_hash": "<i8", "length": "<i8", "size": "<i8"}
INDEX_COLUMNS = ", ".join(["shard long", "levels binary", "digests binary", *(f"{c} binary" for c in SLOTS)])


# --- the minimal perfect hash ------------------------------------------------


def _positions(words: np.ndarray, level: int, width: int) -> np.ndarray:
    """Where each digest, as four 64-bit words, falls in a level of ``width`` bits."""
    factor = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = words[:, level % 4] * factor ^ words[:, (level + 1) % 4]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(width)).astype(np.int64)


@dataclass
class PerfectHash:
    """Bit arrays by level; the rank of a digest's bit is its slot."""

    levels: list[np.ndarray]

    @classmethod
    def build(cls, words: np.ndarray) -> "PerfectHash":
        """Over distinct digests; a level keeps those that meet no other."""
        levels, left = [], words
        while len(left):
            width = LOAD * len(left) + 1
            at = _positions(left, len(levels), width)
            alone = np.bincount(at, minlength=width) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 where it surely is no member."""
        slots = np.full(len(words), -1, np.int64)
        open_rows, base = np.arange(len(words)), 0
        for level, bits in enumerate(self.levels):
            at = _positions(words[open_rows], level, len(bits))
            ranks = np.cumsum(bits) - 1
            hit = bits[at]
            slots[open_rows[hit]] = base + ranks[at[hit]]
            open_rows, base = open_rows[~hit], base + int(bits.sum())
        return slots

    def to_bytes(self) -> bytes:
        heads = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return heads + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        count = int(np.frombuffer(data, "<i8", 1)[0])
        widths = np.frombuffer(data, "<i8", count, 8)
        at, levels = 8 * (count + 1), []
        for width in widths.tolist():
            taken = (width + 7) // 8
            bits = np.unpackbits(np.frombuffer(data, np.uint8, taken, at), count=width)
            levels.append(bits.astype(bool))
            at += taken
        return cls(levels)


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8").reshape(-1, 4)


# --- digests -----------------------------------------------------------------


def with_digests(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep``, the SHA-256 of the text without ASCII blanks, and its code points."""
    blanks = BLANKS.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sums = [
                hashlib.sha256(t.as_py().translate(None, blanks)).digest()
                for t in texts.cast(pa.binary())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(sums, pa.binary()),
                    pc.utf8_length(texts).cast(pa.int64()),
                ],
                names=[*batch.schema.names[:-1], "digest", "length"],
            )

    rows = docs.select(*keep, text_or_empty().alias("body"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, digest binary, length long")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: where its winner is, the winner's length, and the number of rows."""
    rank = F.struct((-F.col("length")).alias("less"), "no_id", "doc_id", "row_hash")
    return (
        rows.groupBy("digest")
        .agg(F.min(rank).alias("best"), F.count("*").alias("size"))
        .select(
            "digest",
            F.col("best.doc_id").alias("winner"),
            F.col("best.no_id").alias("no_id"),
            F.col("best.row_hash").alias("winner_hash"),
            (-F.col("best.less")).alias("length"),
            "size",
        )
    )


def _shard(shards: int) -> Column:
    """Digest bits are uniform: eight of their bytes, modulo the number of shards."""
    head = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    return F.pmod(head, F.lit(shards)).alias("shard")


# --- the index ---------------------------------------------------------------


def _build(table: pa.Table) -> pa.Table:
    digests = b"".join(table.column("digest").to_pylist())
    words = _words(digests)
    perfect = PerfectHash.build(words)
    order = np.argsort(perfect.slots(words))
    by_slot = np.frombuffer(digests, np.uint8).reshape(-1, DIGEST_BYTES)[order].tobytes()
    columns = {"levels": [perfect.to_bytes()], "digests": [by_slot]}
    for name, kind in SLOTS.items():
        values = pc.fill_null(table.column(name).cast(pa.int64()), 0).to_numpy()
        columns[name] = [values[order].astype(kind).tobytes()]
    shard = table.column("shard").slice(0, 1).combine_chunks().cast(pa.int64())
    return pa.table(
        [shard, *(pa.array(c, pa.binary()) for c in columns.values())], names=["shard", *columns]
    )


def build_index(groups: DataFrame, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """One row per shard: the hash and its slots, in slot order.

    ``groups`` has one row per distinct ``digest`` and the columns of ``SLOTS``. The number of shards follows from their count, so a shard's size
    does not grow with the corpus. The result can be stored and used again.
    """
    shards = max(1, -(-groups.count() // shard_digests))
    dealt = groups.withColumn("shard", _shard(shards))
    return (
        dealt.groupBy("shard")
        .applyInArrow(_build, INDEX_COLUMNS)
        .withColumn("shards", F.lit(shards).cast("long"))
    )


class _Shard:
    """One shard's index, ready for lookups."""

    def __init__(self, number: int, row: dict[str, bytes]):
        self.number = number
        self.perfect = PerfectHash.from_bytes(row["levels"])
        self.words = _words(row["digests"])
        self.slots = {c: np.frombuffer(row[c], kind).astype("i8") for c, kind in SLOTS.items()}

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each digest, and whether that slot holds all its bytes."""
        slots = self.perfect.slots(words)
        safe = np.maximum(slots, 0)
        return safe, (slots >= 0) & (self.words[safe] == words).all(axis=1)


def _answers(shard: _Shard | None, number: int, words: np.ndarray) -> list[pa.Array]:
    """The columns of ``FOUND`` for digests of one shard."""
    if shard is None or shard.number != number:  # the index has no digest there
        none = pa.nulls(len(words), pa.int64())
        return [pa.array(np.zeros(len(words), bool)), none, none, none, none]
    slots, member = shard.find(words)
    nameless = shard.slots["no_id"][slots].astype(bool)
    values = [pa.array(member)]
    for name in ("winner", "winner_hash", "length", "size"):
        hidden = ~member | nameless if name == "winner" else ~member
        values.append(pa.array(shard.slots[name][slots], pa.int64(), mask=hidden))
    return values


FOUND = ["member", "winner", "winner_hash", "winner_length", "size"]


def lookup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with what the slot of each ``digest`` holds; ``member`` is false where it is new.

    ``rows`` has a binary ``digest`` and further columns of plain types.
    """
    head = index.select("shards").first()
    shards = 1 if head is None else head["shards"]
    names = rows.columns
    placed = rows.withColumn("shard", _shard(shards))
    counts = checkpoint(placed.groupBy("shard").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    lane_rows = max(LANE_ROWS, total // LANES)
    # Fewer than LANES shards can hold more than one in LANES of all rows.
    wide = F.broadcast(
        counts.where(F.col("count") > lane_rows).select(
            "shard", F.ceil(F.col("count") / lane_rows).cast("long").alias("lanes")
        )
    )
    lanes = F.coalesce("lanes", F.lit(1).cast("long"))
    blobs = ["levels", "digests", *SLOTS]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    left = placed.join(wide, "shard", "left").select(
        "shard",
        F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), lanes).alias("lane"),
        F.struct(*names).alias("row"),
        F.lit(None).cast("struct<" + ",".join(f"{c}:binary" for c in blobs) + ">").alias("index"),
    )
    right = index.join(wide, "shard", "left").select(
        "shard",
        F.explode(F.sequence(F.lit(0).cast("long"), lanes - 1)).alias("lane"),
        F.lit(None)
        .cast("struct<" + ",".join(f"`{c}`:{kind}" for c, kind in kinds.items()) + ">")
        .alias("row"),
        F.struct(*blobs).alias("index"),
    )
    spread = (
        right.union(left)
        .withColumn("later", F.col("index").isNull())
        .repartition("shard", "lane")
        .sortWithinPartitions("shard", "lane", "later")
        .select("shard", "index", "row")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            heads = pc.is_valid(batch.column("index")).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.diff(numbers)) + 1
            starts = np.flatnonzero(heads)
            cuts = np.unique(np.concatenate([[0, len(numbers)], change, starts, starts + 1])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                if heads[a]:
                    shard = _Shard(int(numbers[a]), batch.column("index")[a].as_py())
                    continue
                part = batch.column("row").slice(a, b - a).flatten()
                digests = part[names.index("digest")].to_pylist()
                found = _answers(shard, int(numbers[a]), _words(b"".join(digests)))
                yield pa.RecordBatch.from_arrays([*part, *found], names=[*names, *FOUND])

    given = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
    return spread.mapInArrow(
        run, f"{given}, member boolean, " + ", ".join(f"{c} long" for c in FOUND[1:])
    )


# --- the operator ------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    number = F.col("doc_id").cast("long")
    return with_digests(
        docs,
        number.alias("doc_id"),
        number.isNull().alias("no_id"),
        row_key(docs)[1].alias("row_hash"),
    )


def _with_groups(rows: DataFrame, index: DataFrame | None) -> DataFrame:
    """One row per digest of ``rows``, with its winner over them and the earlier corpus.

    A part of the rows is the history: its digests are indexed. The others are looked up there, so
    their repeats of the history are known without meeting each other's digests;
    only members are added to their groups, and only nonmembers are grouped among themselves.
    """
    part = F.pmod(F.xxhash64("doc_id", "row_hash"), F.lit(HISTORY)) == 0
    past = checkpoint(_groups(rows.where(part)))
    history = checkpoint(build_index(past))
    asked = checkpoint(lookup(rows.where(~part), history).select(*rows.columns, "member"))
    new = _groups(asked.where(~F.col("member")))
    repeats = _groups(asked.where("member"))
    # Every repeat's digest is one of the history's.
    again = _merged(repeats, history)
    known = past.join(again.select("digest"), "digest", "left_anti").unionByName(again)
    own = checkpoint(known.unionByName(new))
    return own if index is None else checkpoint(_merged(own, index))


def _with_winners(docs: DataFrame, index: DataFrame | None) -> DataFrame:
    """Every row with its group's winner over ``docs`` and the earlier corpus."""
    rows = checkpoint(_rows(docs))
    found = lookup(rows, checkpoint(build_index(_with_groups(rows, index))))
    return found.withColumn(
        "kept",
        F.col("doc_id").eqNullSafe(F.col("winner"))
        & (F.col("row_hash") == F.col("winner_hash"))
        & (F.col("length") == F.col("winner_length")),
    )


def _merged(own: DataFrame, index: DataFrame) -> DataFrame:
    """The groups of the new rows, with those that the index knows joined to its winners."""
    new = ["winner", "no_id", "winner_hash", "length", "size"]
    asked = own.select("digest", *(F.col(c).alias(f"new_{c}") for c in new))
    seen = lookup(asked, index).withColumn("no_id", F.col("winner").isNull())
    rank = lambda length, *rest: F.struct((-F.col(length)).alias("less"), *rest)
    earlier = rank("winner_length", "no_id", "winner", "winner_hash")
    later = rank(
        "new_length",
        F.col("new_no_id").alias("no_id"),
        F.col("new_winner").alias("winner"),
        F.col("new_winner_hash").alias("winner_hash"),
    )
    best = F.when(F.col("member") & (earlier <= later), earlier).otherwise(later)
    return seen.select(
        "digest", best.alias("best"), (F.col("new_size") + F.coalesce("size", F.lit(0))).alias("size")
    ).select(
        "digest",
        F.col("best.winner").alias("winner"),
        F.col("best.no_id").alias("no_id"),
        F.col("best.winner_hash").alias("winner_hash"),
        (-F.col("best.less")).alias("length"),
        "size",
    )


def index_of(docs: DataFrame, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """The index of a corpus, to be stored and given to later runs."""
    return build_index(checkpoint(_groups(_rows(docs))), shard_digests)


def exact_duplicates(docs: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Each row's ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal that are identical without ASCII blanks; null counts as empty.
    Of equal texts the row with the most code points stays, then the smallest
    ``doc_id``, a null id last, then the smallest row hash; repeats of that very
    row all say ``kept``. With an ``index`` of an earlier corpus its groups take
    part: its winner stays unless a new row beats it, and the group size counts
    both. An empty table gives
    an empty table.
    """
    return _with_winners(docs, index).select(
        "doc_id",
        F.col("winner").alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def one_per_text(docs: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, repeats of one row once."""
    kept = _with_winners(docs, index).where("kept")
    return keep_rows(
        docs,
        kept.select(
            F.coalesce("doc_id", F.lit(0).cast("long")).alias(ROW_KEY[0]),
            F.col("row_hash").alias(ROW_KEY[1]),
        ),
    )
