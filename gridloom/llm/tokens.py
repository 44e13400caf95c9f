"""Token ids of whole texts from a public tokenizer file, word by word.

The tokenizer works on pieces that never reach over a space or a line break, so
the ids of a text are those of its space-separated words in turn. Arrow numbers the
different words of a stretch of texts, and numpy lays out their ids. A word of plain letters,
with or without marks behind it, is what the library's normaliser lower-cases and
its pre-tokenizer cuts into just these two pieces, so they go to the library's model
directly; any other word goes through the whole library. A task keeps the ids of
pieces and words it has met, up to ``CACHED_WORDS``.
"""

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a task keeps; about 50 MB.
CACHED_WORDS = 400_000
#: Characters whose words are handled together.
STRETCH = 1 << 21
#: Rows whose ids are held together.
ROWS = 1024
#: Marks of which a run behind a word is a piece of its own.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
#: Letters that normalisation only lower-cases, one code point each.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[{LETTERS}]*")


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _laid_out(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``ids`` of these sizes in another order, a run as often as it is named, and their sizes."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[order]
    ends = np.cumsum(taken)
    shift = np.repeat(starts[order] - ends + taken, taken)
    return ids[shift + np.arange(len(shift))], taken


class Encoder:
    """Ids of texts as little-endian uint32 bytes."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cached_words = cached_words
        self._forget()
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = filter(PLAIN.fullmatch, map(chr, range(256)))
        self.spelling = {ord(c): spelled.pre_tokenize_str(c)[0][0] for c in letters}
        # The short way holds where the library agrees on pieces of each kind.
        probe = [*map(chr, self.spelling), *MARKS, "probe", "größe", "...", MARKS, "ÀÉÿ"]
        self.short = all(
            self._piece(p.lower()) == ids for p, ids in zip(probe, self._whole(probe))
        )

    def _forget(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.ids, self.sizes = array("I"), array("q", [0])

    def _whole(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _piece(self, piece: str) -> list[int]:
        """The ids of lower-cased letters or of marks, which the library does not cut further."""
        spelled = piece if piece.isascii() else piece.translate(self.spelling)
        return [t.id for t in self.model.tokenize(spelled)]

    def _slots(self, asked: list[str], learn: Callable[[list[str]], Iterable[list[int]]]) -> np.ndarray:
        """Where the ids of different strings are kept; ``learn`` gives those not met yet."""
        new = [x for x in asked if x not in self.slots]
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
        for ids in learn(new):
            self.ids.extend(ids)
            self.sizes.append(len(ids))
        return np.fromiter(map(self.slots.__getitem__, asked), np.int64, len(asked))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words one after the other, and how many each has."""
        cores = pc.ascii_rtrim(words, characters=MARKS)
        plain = pc.match_substring_regex(cores, f"^[{LETTERS}]*$").to_numpy(zero_copy_only=False)
        plain &= self.short
        tails = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        marked = np.flatnonzero(plain & (tails > 0))
        marks = [w[-n:] for w, n in zip(_listed(words.take(pa.array(marked))), tails[marked].tolist())]
        letters = pc.utf8_lower(cores.filter(pa.array(plain)))
        pieces = pa.concat_arrays([letters, pa.array(marks, words.type)]).dictionary_encode()
        slots = self._slots(_listed(pieces.dictionary), lambda new: map(self._piece, new))
        slots = slots[pieces.indices.to_numpy()]
        # A word is a piece and the marks behind it, or went through the library.
        runs = np.zeros((len(words), 2), np.int64)
        runs[plain, 0], runs[marked, 1] = slots[: len(letters)], slots[len(letters) :]
        runs[~plain, 0] = self._slots(_listed(words.filter(pa.array(~plain))), self._whole)
        ids, taken = _laid_out(np.frombuffer(self.ids, "u4"), np.array(self.sizes), runs.ravel())
        return ids, taken.reshape(-1, 2).sum(axis=1)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.slots) > self.cached_words:
            self._forget()
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        parts = pc.split_pattern(lines, " ")
        words = parts.flatten().dictionary_encode()
        ids, sizes = _laid_out(*self._words(words.dictionary), words.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])[parts.offsets.to_numpy()].tolist()
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        found: list[bytes] = []
        held, size = [], 0
        for text in texts:
            if len(text) > STRETCH:
                found += self._encode(held)
                held, size = [], 0
                found.append(b"".join(i for part in _stretches(text) for i in self._encode([part])))
                continue
            held.append(text)
            size += len(text)
            if size > STRETCH:
                found += self._encode(held)
                held, size = [], 0
        return found + self._encode(held)

    def encode_batches(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        """The first column of some rows at a time, and the ids of the texts in the second."""
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                values, texts = batch.slice(first, ROWS).columns
                yield values.to_pylist(), self.encode(texts.to_pylist())
        # The worker process stays for other tasks.
        self._forget()
        pa.default_memory_pool().release_unused()


def _stretches(text: str) -> Iterator[str]:
    """Parts of about ``STRETCH`` characters, cut at spaces."""
    first = 0
    while first < len(text):
        last = text.find(" ", first + STRETCH)
        last = len(text) if last < 0 else last
        yield text[first:last]
        first = last
