"""Packing documents into sequences of fixed length by linear grouping.

Large lengths are sorted, cut into groups of equal cardinality and rounded up to
the longest of their group, which leaves few different sizes. A linear program
over the configurations of those sizes that fit a sequence says how often to use
each. Then actual documents take the places of the rounded ones, and what is
small or left over goes best-fit into the room that remains.

The pieces are dealt evenly into shards of bounded size, each packed by itself:
a shard leaves about one sequence unfilled, whatever the lengths are.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, text_or_empty
from gridloom.llm.tokens import Encoder

#: Pieces a shard holds; without their ids a shard takes a few MB.
SHARD_PIECES = 1 << 16
#: The same where the pieces carry their ids.
SHARD_PIECES_WITH_IDS = 1 << 13
#: Groups of equal cardinality that the large lengths are rounded in. Few groups leave rooms
#: that small pieces can fill, many waste less where those are rare; the better one counts.
GROUPS = (32, 64)
#: A piece over one in this many of the sequence length is large.
SMALL_PARTS = 8
END_ID = 1
LENGTH = 4096


# --- pieces ------------------------------------------------------------------


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece.

    A document is its ids and ``end_id``; only one longer than ``length`` is cut. Ids
    are little-endian uint32 bytes.
    """
    end, step = np.array([end_id], "<u4").tobytes(), 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for numbers, found in encoder.encode_batches(batches):
            rows = []
            for number, data in zip(numbers, found):
                data += end
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append((number, k, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + ids], names=names[: 5 + ids])

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("body"))
    return rows.mapInArrow(run, kind)


# --- one shard ---------------------------------------------------------------


def round_up(lengths: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in descending order each one's group, and each group's rounded size."""
    each = -(-len(lengths) // groups) if len(lengths) else 1
    group = np.arange(len(lengths)) // each
    return group, lengths[::each]


def best_filling(sizes: np.ndarray, prices: np.ndarray, length: int) -> np.ndarray:
    """How many of each size to take, at most ``length`` in sum, for the highest price."""
    worth = np.zeros(length + 1)
    used = np.zeros((len(sizes), length + 1), np.int8)
    for k, (size, price) in enumerate(zip(sizes.tolist(), prices.tolist())):
        if price <= 0:
            continue
        before = worth.copy()
        for n in range(1, length // size + 1):
            with_n = before[: length + 1 - n * size] + n * price
            better = with_n > worth[n * size :] + 1e-12
            worth[n * size :][better] = with_n[better]
            used[k, n * size :][better] = n
    chosen, at = np.zeros(len(sizes), np.int64), int(worth.argmax())
    for k in range(len(sizes) - 1, -1, -1):
        chosen[k] = used[k, at]
        at -= int(chosen[k] * sizes[k])
    return chosen


def configurations(
    sizes: np.ndarray, counts: np.ndarray, length: int, rounds: int = 2000
) -> list[tuple[int, np.ndarray]]:
    """``(times, how many of each size)`` of a best fractional covering, times rounded down.

    The linear program over all configurations is solved by generating columns: the
    prices of the sizes in the present solution make a knapsack problem, whose
    answer enters the solution until none is worth more than one sequence.
    """
    if not len(sizes):
        return []
    basis = np.diag(length // sizes).astype(float)
    for _ in range(rounds):
        amounts = np.linalg.solve(basis, counts)
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = best_filling(sizes, prices, length).astype(float)
        if prices @ column <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, column)
        rising = change > 1e-9
        ratios = np.where(rising, np.maximum(amounts, 0) / np.where(rising, change, 1), np.inf)
        basis[:, int(ratios.argmin())] = column
    amounts = np.linalg.solve(basis, counts)
    found, left = [], counts.astype(np.int64)
    for k in np.argsort(-amounts, kind="stable").tolist():
        one = basis[:, k].astype(np.int64)
        held = one > 0
        times = min(int(np.floor(amounts[k] + 1e-6)), int((left[held] // one[held]).min()))
        if times > 0:
            found.append((times, one))
            left -= times * one
    return found


class Rooms:
    """Open sequences by free room; finds the least room that is enough."""

    def __init__(self, length: int):
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self.mask = 0

    def add(self, sequence: int, room: int) -> None:
        self.by_room[room].append(sequence)
        self.mask |= 1 << room

    def take(self, need: int) -> tuple[int, int] | None:
        """A sequence and its room, or none with room for ``need``."""
        enough = self.mask >> need
        if not enough:
            return None
        room = need + (enough & -enough).bit_length() - 1
        sequence = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        return sequence, room


def pack(
    lengths: np.ndarray, length: int = LENGTH, groups: tuple[int, ...] = GROUPS
) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of each piece; ``lengths`` are from 1 to ``length``, descending."""
    tries = [_dealt(lengths, length, g) for g in groups]
    sequence = min(tries, key=lambda s: s.max(initial=-1))
    return sequence, _offsets(lengths, sequence)


def _dealt(lengths: np.ndarray, length: int, groups: int) -> np.ndarray:
    """The sequence of each piece, with so many groups."""
    sequence = np.empty(len(lengths), np.int64)
    whole = int(np.searchsorted(-lengths, -length, "right"))
    large = int(np.searchsorted(-lengths, -(length // SMALL_PARTS), "left"))
    large = max(large, whole)
    sequence[:whole] = np.arange(whole)
    rooms, made = Rooms(length), whole

    group, sizes = round_up(lengths[whole:large], groups)
    counts = np.bincount(group, minlength=len(sizes)).astype(np.int64)
    waiting = [(whole + np.flatnonzero(group == k)[::-1]).tolist() for k in range(len(sizes))]
    for times, one in configurations(sizes, counts, length):
        for _ in range(times):
            room = length
            for k in np.flatnonzero(one).tolist():
                for _ in range(int(one[k])):
                    item = waiting[k].pop()
                    sequence[item] = made
                    room -= int(lengths[item])
            rooms.add(made, room)
            made += 1
    # What the fractions left over, then the small ones, longest first.
    for item in [*sorted(sum(waiting, [])), *range(large, len(lengths))]:
        need = int(lengths[item])
        place = rooms.take(need)
        if place is None:
            place, made = (made, length), made + 1
        sequence[item] = place[0]
        rooms.add(place[0], place[1] - need)

    return sequence


def _offsets(lengths: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The pieces of a sequence follow each other without gaps."""
    order = np.argsort(sequence, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    first = np.flatnonzero(np.diff(sequence[order], prepend=-1))
    offset = np.empty(len(lengths), np.int64)
    offset[order] = starts - np.repeat(starts[first], np.diff(np.append(first, len(lengths))))
    return offset


# --- the operator ------------------------------------------------------------


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    length: int = LENGTH,
    ids: bool = False,
    shard_pieces: int | None = None,
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``, as few sequences as it can.

    Null and empty texts are a piece of the end id alone; repeated rows and equal or
    null ids are pieces of their own. An empty table gives an empty table.
    """
    found = checkpoint(pieces(docs, tokenizer, end_id, length, ids))
    each = shard_pieces or (SHARD_PIECES_WITH_IDS if ids else SHARD_PIECES)
    dealt = found.repartition(max(1, -(-found.count() // each)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        # Tasks that run again may get their rows in another order.
        rows = pa.Table.from_batches(held).sort_by(
            [("length", "descending")]
            + [(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32")]
        )
        sequence, offset = pack(rows.column("length").to_numpy(), length)
        sequence += TaskContext.get().partitionId() << 32
        rows = rows.append_column("sequence_id", pa.array(sequence))
        yield from rows.append_column("offset", pa.array(offset)).combine_chunks().to_batches(1 << 13)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """The training sequences: ``sequence_id``, its ``ids`` as bytes and the ``doc_ids`` within."""
    part = F.struct("offset", "doc_id", "ids")
    return (
        packed(docs, tokenizer, end_id, length, ids=True)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )
