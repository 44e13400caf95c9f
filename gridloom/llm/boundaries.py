"""A compressed set of positions with rank-free selection, in the manner of Roaring bitmaps.

Positions are split by their high bits into chunks of ``CHUNK`` values. Each chunk
that holds any has a container of whichever form is smallest: an array of its
values, a bitmap, or runs of consecutive values. Cumulative cardinalities over the
containers lead from an ordinal to its container; a select inside the container
gives the position.
"""

from dataclasses import dataclass

import numpy as np

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
#: Bits of a bitmap that one step of its select counts together.
WORD = 64


@dataclass
class ArrayContainer:
    """Sorted values, two bytes each."""

    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])

    @property
    def nbytes(self) -> int:
        return self.values.nbytes


@dataclass
class BitmapContainer:
    """One bit per value, with how many are set before each word."""

    words: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * WORD + int(np.flatnonzero(bits)[k - int(self.before[word])])

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes


@dataclass
class RunContainer:
    """First values of runs, with how many values lie in earlier runs."""

    starts: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])

    @property
    def nbytes(self) -> int:
        return self.starts.nbytes + self.before.nbytes


Container = ArrayContainer | BitmapContainer | RunContainer


def container(values: np.ndarray) -> Container:
    """The smallest container of sorted values below ``CHUNK``, of which there is one at least."""
    first = np.flatnonzero(np.diff(values, prepend=values[0] - 2) != 1)
    sizes = 2 * len(values), CHUNK // 8 + 2 * CHUNK // WORD, 4 * len(first)
    best = sizes.index(min(sizes))
    if best == 0:
        return ArrayContainer(values.astype(np.uint16))
    if best == 1:
        bits = np.zeros(CHUNK, np.uint8)
        bits[values] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return BitmapContainer(words, (np.cumsum(counts) - counts).astype(np.uint16))
    return RunContainer(values[first].astype(np.uint16), first.astype(np.uint16))


class PositionSet:
    """A set of non-negative integers that answers which is the ``k``-th, from 0."""

    def __init__(self, positions: np.ndarray):
        """``positions`` are different and ascending."""
        high = positions >> CHUNK_BITS
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        self.highs = high[cuts]
        self.before = np.append(cuts, len(positions))
        parts = zip(cuts.tolist(), self.before[1:].tolist())
        self.containers = [container(positions[a:b] & (CHUNK - 1)) for a, b in parts]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        inside = self.containers[at].select(k - int(self.before[at]))
        return (int(self.highs[at]) << CHUNK_BITS) + inside
