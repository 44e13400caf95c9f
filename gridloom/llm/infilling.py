"""Fill-in-the-middle: a text is cut at two token boundaries and its parts change places.

Tokens are runs of ASCII letters and all other characters one by one. The places
between them go into a compressed position set (``boundaries``), whose selects
turn the two drawn ordinals into offsets of code points. Draws come from a hash of
the document's id, so reruns and repeats of a row agree.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.boundaries import PositionSet
from gridloom.llm.common import text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred documents, those that change form, and of these the ones that start with the suffix.
CHANGED, SUFFIX_FIRST = 90, 20
#: Characters of results handed on together.
STRETCH = 1 << 22


def boundaries(text: str) -> np.ndarray:
    """Offsets in code points before the first token and after each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lower = points | 32
    letter = (lower >= 97) & (lower <= 122)
    inside = letter[1:] & letter[:-1]
    return np.concatenate([[0], np.flatnonzero(~inside) + 1, [len(points)]])


def rearranged(text: str, draws: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, str]:
    """Tokens, form, lengths of prefix and middle, and the text in that form."""
    if not text:
        return 0, PLAIN, None, None, text
    places = boundaries(text)
    n = len(places) - 1
    if draws[2] % 100 >= CHANGED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    cuts = PositionSet(places)
    a, b = (cuts.select(k) for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < SUFFIX_FIRST:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _draws() -> list[Column]:
    """Four numbers from the SHA-256 of ``1:`` and the id; a null id counts as no digits."""
    number = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), number), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


_KINDS = {
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "output": pa.string(),
}


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        draws = list(zip(*(batch.column(k).to_pylist() for k in range(1, 5))))
        texts = batch.column(5)
        first, rows, size = 0, [], 0
        for k in range(len(texts)):
            rows.append(rearranged(texts[k].as_py(), draws[k]))
            size += len(rows[-1][-1])
            if size > STRETCH or k + 1 == len(texts):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS.values())]
                ids = batch.column(0).slice(first, len(rows))
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *_KINDS])
                first, rows, size = k + 1, [], 0


def transformed(docs: DataFrame) -> DataFrame:
    """Each row's ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts tokens; lengths are in code points and null where the form is plain.
    A null text counts as empty; empty texts, and those that hold a marker, stay
    plain. A null id draws like an id without digits. Repeated rows come out alike. An
    empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_draws(), text_or_empty().alias("body"))
    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(_run, kinds)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that was brought into ``form``; no part of it holds a marker."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    marks = {PSM: (PREFIX, SUFFIX), SPM: (SUFFIX, PREFIX)}

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a = F.length(F.lit(first)) + 1
        b, c = F.instr(output, second), F.instr(output, MIDDLE)
        return (
            F.substr(output, a, b - a),
            F.substr(output, b + len(second), c - b - len(second)),
            F.substr(output, c + len(MIDDLE)),
        )

    one, two, middle = parts(*marks[PSM])
    text = F.when(form == PSM, F.concat(one, middle, two))
    one, two, middle = parts(*marks[SPM])
    return text.when(form == SPM, F.concat(two, middle, one)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """As :func:`transformed`, with the SHA-256 of the output and of the text rebuilt from it."""
    found = transformed(docs)
    return found.select(
        *found.columns[:-1],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )
