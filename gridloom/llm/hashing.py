"""Hashes of many tokens at once, from the bytes of a text."""

from collections.abc import Iterator

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PERIOD = 1024
_POWERS = np.cumprod(np.full(_PERIOD, np.uint64(0x100000001B3 | 1), np.uint64))

SPACE, WORD, MARK = 0, 1, 2
#: ASCII letters and digits, and all bytes of other characters, make words.
CLASSES = np.full(256, MARK, np.uint8)
CLASSES[[9, 10, 11, 12, 13, 32]] = SPACE
CLASSES[48:58] = CLASSES[65:91] = CLASSES[97:123] = CLASSES[128:] = WORD
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes handled together.
STRETCH = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _FACTOR
    return values ^ (values >> np.uint64(29))


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of word bytes and of marks start, and a hash of each, lower-cased."""
    classes = CLASSES[data]
    starts = np.flatnonzero(np.diff(classes, prepend=SPACE + 255) != 0)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    values = (LOWER[data].astype(np.uint64) + np.uint64(1)) * _POWERS[place & (_PERIOD - 1)]
    hashes = mix(np.add.reduceat(values, starts))
    real = classes[starts] != SPACE
    return starts[real], hashes[real]


def stretches(texts: list[bytes], size: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All texts in order as byte arrays of about ``size``, with the text each byte run is of.

    Yields the bytes, texts apart by a blank, and rows of (first byte, text number).
    A longer text is a stretch of its own.
    """
    held, owners, length = [], [], 0
    for number, text in enumerate(texts):
        held.append(text)
        owners.append((length, number))
        length += len(text) + 1
        if length >= size:
            yield np.frombuffer(b" ".join(held) + b" ", np.uint8), np.array(owners)
            held, owners, length = [], [], 0
    if held:
        yield np.frombuffer(b" ".join(held) + b" ", np.uint8), np.array(owners)
