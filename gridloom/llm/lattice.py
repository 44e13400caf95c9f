"""All segmentations of words into the pieces of a vocabulary, weighted by piece scores.

A word is a path through its bytes; a piece that matches there is an edge, and only
pieces that end words may reach its end. The probability of a word is the sum over all
paths of the product of their pieces' probabilities, taken in logarithms from left
to right. The same sums from right to left say how often each piece is
expected on a path.

Pieces are found by a walk through a trie held in arrays, at all places of many words of one
length together. Long words take the same steps one by one.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, inf, log1p

import numpy as np

#: Bytes from which on a word is handled alone.
LONG = 64
#: Bytes of words of one length that are handled together.
STRETCH = 1 << 18
WORD_END = "</w>"


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the rest, in order, follow from code point 256.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(other)}


@dataclass
class Trie:
    """Nodes of pieces as arrays: ``keys`` are node * 256 + byte, sorted, and lead to ``children``.

    ``inner`` and ``final`` number the piece that ends at a node, inside a word and at its end;
    -1 where there is none. Every byte is a piece of both kinds.
    """

    keys: np.ndarray
    children: np.ndarray
    inner: np.ndarray
    final: np.ndarray
    pieces: int

    @classmethod
    def build(cls, pieces: list[tuple[bytes, bool]]) -> "Trie":
        """Of pieces as bytes, each with whether it ends words, numbered in turn."""
        step: dict[int, int] = {}
        ends: list[list[int]] = [[-1, -1]]
        for number, (data, last) in enumerate(pieces):
            node = 0
            for byte in data:
                node = step.setdefault(node << 8 | byte, len(ends))
                if node == len(ends):
                    ends.append([-1, -1])
            ends[node][last] = number
        keys = np.array(sorted(step), np.int64)
        children = np.array([step[k] for k in keys.tolist()], np.int32)
        inner, final = np.array(ends, np.int32).T.copy()
        return cls(keys, children, inner, final, len(pieces))

    def edges(self, data: np.ndarray) -> list[np.ndarray]:
        """Pieces of 1, 2, ... bytes at each place of words of equal length, as rows of ``data``.

        Element k has a column per place that a piece of k + 1 bytes can start from.
        """
        words, length = data.shape
        found = []
        rows, places = np.indices((words, length)).reshape(2, -1)
        nodes = np.zeros(words * length, np.int64)
        for size in range(1, length + 1):
            fits = places + size <= length
            rows, places, nodes = rows[fits], places[fits], nodes[fits]
            key = nodes << 8 | data[rows, places + size - 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[at] == key
            rows, places, nodes = rows[alive], places[alive], self.children[at[alive]].astype(np.int64)
            if not len(nodes):
                break
            piece = np.full((words, length - size + 1), -1, np.int32)
            ends = places + size == length
            piece[rows, places] = np.where(ends, self.final[nodes], self.inner[nodes])
            found.append(piece)
        return found

    def edges_of(self, word: bytes, step: dict[int, int]) -> Iterator[tuple[int, int, int]]:
        """Start, end and piece of every edge of one word, by start."""
        for first in range(len(word)):
            node = 0
            for last in range(first + 1, len(word) + 1):
                node = step.get(node << 8 | word[last - 1], 0)
                if not node:
                    break
                piece = int((self.final if last == len(word) else self.inner)[node])
                if piece >= 0:
                    yield first, last, piece


def _add(a: float, b: float) -> float:
    low, high = (a, b) if a < b else (b, a)
    return high if low == -inf else high + log1p(exp(low - high))


class Lattice:
    """Sums over the segmentations of words under the pieces' log-probabilities."""

    def __init__(self, trie: Trie, scores: np.ndarray):
        self.trie, self.scores = trie, np.append(scores, -np.inf)
        self.step: dict[int, int] | None = None

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Numbers of words of one length, and their bytes by row; long words alone, without."""
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            length = int(lengths[order[a]])
            if length > LONG:
                yield from ((order[k : k + 1], None) for k in range(a, b))
                continue
            for k in range(a, b, max(1, STRETCH // max(1, length))):
                part = order[k : min(b, k + max(1, STRETCH // max(1, length)))]
                data = np.frombuffer(b"".join(words[i] for i in part.tolist()), np.uint8)
                yield part, data.reshape(len(part), length)

    @staticmethod
    def _forward(weights: list[np.ndarray], words: int, length: int) -> np.ndarray:
        """By place and word: the log-probability of all ways to get there."""
        total = np.full((length + 1, words), -np.inf)
        total[0] = 0.0
        for last in range(1, length + 1):
            for size in range(1, min(last, len(weights)) + 1):
                way = total[last - size] + weights[size - 1][last - size]
                total[last] = way if size == 1 else np.logaddexp(total[last], way)
        return total

    @staticmethod
    def _backward(weights: list[np.ndarray], words: int, length: int) -> np.ndarray:
        total = np.full((length + 1, words), -np.inf)
        total[length] = 0.0
        for first in range(length - 1, -1, -1):
            for size in range(1, min(length - first, len(weights)) + 1):
                way = weights[size - 1][first] + total[first + size]
                total[first] = way if size == 1 else np.logaddexp(total[first], way)
        return total

    def _weights(self, edges: list[np.ndarray]) -> list[np.ndarray]:
        """Log-probabilities by place and word."""
        return [self.scores[e.T] for e in edges]

    def _long_edges(self, word: bytes) -> list[tuple[int, int, int]]:
        if self.step is None:
            self.step = dict(zip(self.trie.keys.tolist(), self.trie.children.tolist()))
        return list(self.trie.edges_of(word, self.step))

    def _long_forward(self, word: bytes, edges: list[tuple[int, int, int]]) -> list[float]:
        total = [0.0] + [-inf] * len(word)
        for first, last, piece in edges:
            total[last] = _add(total[last], total[first] + self.scores[piece])
        return total

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """The natural logarithm of each word's probability."""
        found = np.zeros(len(words))
        for part, data in self._groups(words):
            if data is None:
                word = words[part[0]]
                found[part] = self._long_forward(word, self._long_edges(word))[-1]
            else:
                weights = self._weights(self.trie.edges(data))
                found[part] = self._forward(weights, *data.shape)[-1]
        return found

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in ``counts`` occurrences of each word."""
        found = np.zeros(self.trie.pieces)
        for part, data in self._groups(words):
            if data is None:
                self._expected_long(words[part[0]], float(counts[part[0]]), found)
                continue
            edges = self.trie.edges(data)
            weights = self._weights(edges)
            ahead = self._forward(weights, *data.shape)
            back = self._backward(weights, *data.shape)
            for size, (edge, weight) in enumerate(zip(edges, weights), 1):
                stops = data.shape[1] - size + 1
                with np.errstate(invalid="ignore"):
                    share = np.exp(ahead[:stops] + weight + back[size:] - ahead[-1])
                real = edge.T >= 0
                times = np.broadcast_to(counts[part], real.shape)
                found += np.bincount(edge.T[real], share[real] * times[real], minlength=len(found))
        return found

    def _expected_long(self, word: bytes, count: float, found: np.ndarray) -> None:
        edges = self._long_edges(word)
        ahead = self._long_forward(word, edges)
        back = [-inf] * len(word) + [0.0]
        for first, last, piece in reversed(edges):
            back[first] = _add(back[first], self.scores[piece] + back[last])
        for first, last, piece in edges:
            found[piece] += count * exp(ahead[first] + self.scores[piece] + back[last] - ahead[-1])
