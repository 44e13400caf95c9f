"""Quality selection by importance resampling over hashed n-grams.

Two generative models of a text's bag of hashed word and word-pair counts are
fitted: one on texts known to be good, the target, one on all texts. The sum of
log ratios over a text's n-grams is its log importance weight. Adding Gumbel noise
and keeping the largest k draws k texts without replacement in proportion to
their weights (DSIR, Xie et al. 2023).

Counts of the raw model cover all documents and are summed by bucket. The k-th
largest key is found by counting keys in ever finer bins.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import hashing
from gridloom.llm.common import checkpoint, row_key, text_or_empty

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Good documents that the target model is fitted on, at most.
TARGET_DOCS = 20_000
#: Bins that one round of the search for the k-th key counts in.
BINS = 4096
SMOOTHING = 1.0


def _buckets(data: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every word, mark and neighbouring pair."""
    starts, hashes = hashing.tokens(data)
    owner = owners[np.searchsorted(owners[:, 0], starts, "right") - 1, 1]
    pairs = hashing.mix(hashes[:-1] * np.uint64(31) + hashes[1:])
    same = owner[:-1] == owner[1:]
    found = np.concatenate([hashes, pairs[same]]) >> np.uint64(64 - BUCKET_BITS)
    return np.concatenate([owner, owner[:-1][same]]), found.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch.column(0).to_numpy(zero_copy_only=False)
        for data, owners in hashing.stretches(batch.column(1).cast(pa.binary()).to_pylist()):
            owner, bucket = _buckets(data, owners)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[owner]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"]
    )


def fit(docs: DataFrame, good: DataFrame, target_docs: int = TARGET_DOCS) -> np.ndarray:
    """The log ratio of target to raw probability of each bucket.

    ``good`` names good documents by ``doc_id``; at most ``target_docs`` of them, by hash,
    make the target model. All documents make the raw one. Without good documents all
    ratios are 0.
    """
    chosen = (
        good.select(F.col("doc_id").cast("long").alias("good_id"))
        .where("good_id is not null")
        .distinct()
        .orderBy(F.xxhash64("good_id"), "good_id")
        .limit(target_docs)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("body"))
    marked = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("good_id"), "left").select(
        F.col("good_id").isNotNull().alias("good"), "body"
    )
    sums = (
        marked.mapInArrow(_count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()
    )
    counts = np.zeros((2, BUCKETS))
    counts[:, sums.column("bucket").to_numpy()] = [
        sums.column(c).to_numpy() for c in ("target", "raw")
    ]
    if not counts[0].any():
        return np.zeros(BUCKETS)
    smooth = counts + SMOOTHING
    return np.log(smooth[0] / smooth[0].sum()) - np.log(smooth[1] / smooth[1].sum())


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int, *keep: Column) -> DataFrame:
    """``keep``, ``log_weight``, the noisy ``key`` and ``place``, a long in the order of the keys."""
    noise = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *row_key(docs)), 11).alias("draw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for data, owners in hashing.stretches(batch.column(-1).cast(pa.binary()).to_pylist()):
                owner, bucket = _buckets(data, owners)
                weight += np.bincount(owner, ratios[bucket], minlength=batch.num_rows)
            uniform = (batch.column(-2).to_numpy() + 0.5) / (1 << 53)
            key = weight - np.log(-np.log(uniform)) + 0.0
            bits = key.view(np.int64)
            place = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(weight), pa.array(key), pa.array(place)],
                names=[*batch.schema.names[:-2], "log_weight", "key", "place"],
            )

    rows = docs.select(*keep, noise, text_or_empty().alias("body"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])
    return rows.mapInArrow(run, f"{kinds}log_weight double, key double, place long")


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, or None if there are fewer; nulls do not count."""
    low, high, left = -(1 << 63), (1 << 63) - 1, k
    if k < 1 or rows.where(F.col(column).isNotNull()).count() < k:
        return None
    while low < high:
        width = -(-(high - low + 1) // BINS)
        # Decimals hold the distance of any two longs.
        distance = F.col(column).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        counts = (
            rows.where(F.col(column).between(low, high))
            .groupBy(F.floor(distance / F.lit(width).cast("decimal(20,0)")).cast("int").alias("bin"))
            .count()
            .orderBy(F.desc("bin"))
            .collect()
        )
        for row in counts:
            if left <= row["count"]:
                low = low + row["bin"] * width
                high = min(high, low + width - 1)
                break
            left -= row["count"]
    return low


def resampled(
    docs: DataFrame,
    good: DataFrame,
    share: float,
    target_docs: int = TARGET_DOCS,
    seed: int = 0,
) -> DataFrame:
    """Each row's ``doc_id, log_weight, key, kept``; the ``share`` of rows with the largest keys is kept.

    Null and empty texts weigh as much as the average of all, log weight 0. Rows that
    repeat each other share a key; at the cut all of them stay. Reruns agree. An empty
    table gives an empty table.
    """
    ratios = fit(docs, good, target_docs)
    scored = checkpoint(weigh(docs, ratios, seed, F.col("doc_id").cast("long").alias("doc_id")))
    wanted = round(share * scored.count())
    least = kth_largest(scored, "place", wanted)
    kept = F.lit(False) if least is None else F.col("place") >= F.lit(least)
    return scored.select("doc_id", "log_weight", "key", kept.alias("kept"))
