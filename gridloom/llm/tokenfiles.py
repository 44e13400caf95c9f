"""Token ids in files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds the
first chunk of every id, level 1 the second chunk of those ids that need one, and so
on. Beside each level lies a bitmap that says which of its ids go on, and a
directory of how many did so up to every ``RANK_BITS``-th id. The place of an id
in the next level is its rank in the bitmap, so any id is read with a few array
accesses and nothing before it is decoded.

A file is ``MAGIC``, eight-byte little-endian counts, then the sections in the
order of ``_sections``. Documents lie in ascending ``doc_id`` order within and
across files; the directory of a file holds their ids and first positions.
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, row_key, text_or_empty
from gridloom.llm.tokens import Encoder

MAGIC = b"DACODES1"
CHUNK_BITS = 8
LEVELS = 32 // CHUNK_BITS
RANK_BITS = 512
END_ID = 2
#: A task begins a new file once this many ids wait.
FILE_TOKENS = 1 << 23


# --- one file ----------------------------------------------------------------


def _levels(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap and rank directory of each level."""
    left = ids
    for _ in range(LEVELS):
        chunks = (left & 0xFF).astype(np.uint8)
        left = left >> CHUNK_BITS
        more = left > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, bool)
        padded[: len(more)] = more
        ranks = np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.int64))
        yield chunks, bits, np.concatenate([[0], ranks]).astype("<i8")
        left = left[more]


def encode(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """The file of documents whose ids are little-endian uint32 bytes."""
    every = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum([len(x) // 4 for x in ids], dtype="<i8")
    sections = [
        np.array([0 if d is None else d for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], np.uint8),
        np.concatenate([[0], ends]).astype("<i8"),
    ]
    sizes = []
    for chunks, bits, ranks in _levels(every):
        sizes.append(len(chunks))
        sections += [chunks, bits, ranks]
    head = np.array([len(doc_ids), *sizes], "<i8")
    return MAGIC + head.tobytes() + b"".join(s.tobytes() for s in sections)


class TokenFile:
    """Random access to the ids of one file."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self._data, self._at = data, len(MAGIC)
        documents, *sizes = self._next("<i8", 1 + LEVELS).tolist()
        self.doc_ids = self._next("<i8", documents)
        self.no_id = self._next("u1", documents).astype(bool)
        self.starts = self._next("<i8", documents + 1)
        self.levels = [
            (
                self._next("u1", n),
                self._next("u1", -(-n // 8)),
                self._next("<i8", -(-n // RANK_BITS) + 1),
            )
            for n in sizes
        ]

    def _next(self, kind: str, count: int) -> np.ndarray:
        found = np.frombuffer(self._data, kind, count, self._at)
        self._at += found.nbytes
        return found

    def _rank(self, level: int, at: int) -> int:
        """How many of the first ``at`` ids of a level go on."""
        _, bits, ranks = self.levels[level]
        block = at // RANK_BITS
        part = bits[block * RANK_BITS // 8 : -(-at // 8)]
        if at % 8:
            part = part.copy()
            part[-1] &= (1 << at % 8) - 1
        return int(ranks[block]) + int(np.bitwise_count(part).sum())

    def token(self, at: int) -> int:
        """The id at a position of the file."""
        return int(self.tokens(at, at + 1)[0])

    def tokens(self, first: int, last: int) -> np.ndarray:
        """The ids of positions from ``first`` to before ``last``."""
        values = np.zeros(last - first, np.uint32)
        open_ids = np.arange(last - first)
        for level, (chunks, bits, _) in enumerate(self.levels):
            values[open_ids] |= chunks[first:last].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            byte = first // 8
            more = np.unpackbits(bits[byte : -(-last // 8)], bitorder="little")
            more = more[first - 8 * byte : last - 8 * byte].astype(bool)
            open_ids = open_ids[more]
            if not len(open_ids) or level + 1 == len(self.levels):
                break
            first = self._rank(level, first)
            last = first + len(open_ids)
        return values

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's ``k``-th document."""
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a Hadoop-style path or URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


# --- the operator ------------------------------------------------------------


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write all texts' ids to ``folder``; the manifest of its files, in order.

    Columns: ``part, file, name, documents, tokens`` and ``start``, the ids in files
    before. Rows are sorted by ``doc_id``, null ids first, then by row hash; each
    task writes its range. A task that runs again writes files of new names, and
    only files that the manifest names count. Null texts are empty and hold
    ``end_id`` alone. An empty table gives an empty manifest.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        encoder, made = Encoder(tokenizer), 0
        numbers, ids, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, numbers, ids, size
            store, path = _store(folder)
            store.create_dir(path)
            name = f"tokens-{part:05}-{made:05}-{attempt}.dac"
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(encode(numbers, ids))
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "file": made, "name": name, "documents": len(ids), "tokens": size}]
            )
            made, numbers, ids, size = made + 1, [], [], 0
            return row

        for these, found in encoder.encode_batches(batches):
            for number, data in zip(these, found):
                numbers.append(number)
                ids.append(data + end)
                size += len(ids[-1]) // 4
                if size >= FILE_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("body"),
        row_key(docs)[1].alias("row_hash"),
    )
    manifest = checkpoint(
        rows.repartitionByRange("doc_id", "row_hash")
        .sortWithinPartitions("doc_id", "row_hash")
        .select("doc_id", "body")
        .mapInArrow(run, "part long, file long, name string, documents long, tokens long")
    )
    # One row per file.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document in the files: ``doc_id, start, n_tokens, ids``, ids as uint32 bytes."""
    return _read(manifest, folder, "ids binary", pa.binary(), lambda ids: ids)


def digests(manifest: DataFrame, folder: str) -> DataFrame:
    """As :func:`read`, with ``ids_crc32`` of the ids in place of them."""
    return _read(manifest, folder, "ids_crc32 long", pa.int64(), zlib.crc32)


def _read(manifest: DataFrame, folder: str, column: str, kind: pa.DataType, value) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = _store(folder)
                with store.open_input_file(f"{path}/{name}") as stream:
                    tokens = TokenFile(stream.read())
                yield from _documents(tokens, start)

    def _documents(tokens: TokenFile, start: int) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(tokens.doc_ids), 1024):
            b = min(a + 1024, len(tokens.doc_ids))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens.doc_ids[a:b], pa.int64(), mask=tokens.no_id[a:b]),
                    pa.array(tokens.starts[a:b] + start),
                    pa.array(np.diff(tokens.starts[a : b + 1])),
                    pa.array([value(tokens.document(k).tobytes()) for k in range(a, b)], kind),
                ],
                names=["doc_id", "start", "n_tokens", column.split()[0]],
            )

    files = manifest.select("name", "start").repartition("name")
    return files.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def encoded(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    return digests(write(docs, folder, tokenizer, end_id), folder)

