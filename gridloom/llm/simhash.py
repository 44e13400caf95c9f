"""SimHash near-duplicates: pigeonhole blocks, then the exact bit distance.

A document's fingerprint holds, per bit, the majority of the hashes of its word
shingles. Fingerprints link when they differ in at most ``max_bits`` bits. Cut
into ``blocks`` blocks, two such fingerprints agree in at least
``blocks - max_bits`` whole blocks, so every link shows in a bucket of some
choice of that many blocks. More blocks mean longer keys: the number follows
from the number of different fingerprints and never changes the result.

Copies are one fingerprint. Near copies can still fill a bucket, so its members
are not paired with each other: first each is compared with two members of its
bucket and joined up; then only members that are still apart are paired, and of
each pair one lies outside the bucket's largest component. No link between
components is lost, none inside one is written out.
"""

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ROW_KEY, checkpoint, keep_rows, row_key, text_or_empty
from gridloom.llm.components import connected_components

BITS = 64
SEED = 42
SLICE = 1 << 15


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of UTF-8 bytes; zero if they hold no word."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    size = min(words, len(parts))
    counts, total, digest = np.zeros(BITS, np.int64), len(parts) - size + 1, xxhash.xxh64_intdigest
    for k in range(0, total, SLICE):
        last = min(k + SLICE, total)
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(starts[k:last], ends[k + size - 1 : last + size - 1])
            ],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, words: int, *keep: Column) -> DataFrame:
    """``keep`` and the fingerprint of each row, as a long; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            prints = pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], prints], names=[*batch.schema.names[:-1], "fp"]
            )

    rows = docs.select(*keep, text_or_empty().alias("body"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """For each choice of ``blocks - max_bits`` blocks the bits they cover."""
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    ones = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(ones, blocks - max_bits)]


def blocks_for(fingerprints: int, max_bits: int) -> int:
    """The fewest blocks whose keys have more values than there are fingerprints."""
    need = math.log2(max(fingerprints, 2)) + 1
    blocks = max_bits + 1
    while blocks < 2 * max_bits + 4 and BITS * (blocks - max_bits) / blocks < need:
        blocks += 1
    return blocks


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _close(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, cluster)`` for each different fingerprint that links with another.

    ``prints`` has one row per different fingerprint ``fp``.
    """
    masks = block_masks(blocks_for(prints.count(), max_bits), max_bits)
    keys = F.array(
        *(
            F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for k, m in enumerate(masks)
        )
    )
    dealt = prints.select("fp", F.explode(keys).alias("b")).select("fp", "b.t", "b.key")
    pivots = (
        dealt.groupBy("t", "key")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("low <> high")
    )
    buckets = checkpoint(dealt.join(pivots, ["t", "key"]))
    near = [
        buckets.where((F.col("fp") != F.col(p)) & _close("fp", p, max_bits)).select("fp", p)
        for p in ("low", "high")
    ]
    first = checkpoint(connected_components(near[0].union(near[1])))

    placed = (
        buckets.select("t", "key", "fp")
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    placed = checkpoint(placed)
    largest = (
        placed.groupBy("t", "key", "component")
        .count()
        .groupBy("t", "key")
        .agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("n"))
        .where("n > 1")
        .select("t", "key", "main")
    )
    mixed = placed.join(largest, ["t", "key"])
    few = mixed.where("component <> main").select(
        "t", "key", F.col("fp").alias("fp_a"), F.col("component").alias("a")
    )
    rest = mixed.select(
        "t",
        "key",
        F.col("fp").alias("fp_b"),
        F.col("component").alias("b"),
        (F.col("component") == F.col("main")).alias("in_main"),
    )
    bridges = few.join(
        rest,
        (few.t == rest.t)
        & (few.key == rest.key)
        & ((F.col("a") < F.col("b")) | (F.col("in_main") & (F.col("a") != F.col("b"))))
        & _close("fp_a", "fp_b", max_bits),
    ).select("a", "b")
    second = connected_components(bridges).toDF("component", "cluster")
    alone = second.select(F.col("component").alias("node"), "component").join(
        first, "node", "left_anti"
    )
    every = first.select("node", "component").union(alone)
    return every.join(second, "component", "left").select(
        F.col("node").alias("fp"), F.coalesce("cluster", "component").alias("cluster")
    )


def least_by_cluster(rows: DataFrame, max_bits: int, value: Column) -> DataFrame:
    """``fp, least``: for each fingerprint of ``rows`` the smallest ``value`` of its component.

    Copies meet by fingerprint first, so that a large group of them is one row in
    all that follows.
    """
    prints = checkpoint(rows.groupBy("fp").agg(F.min(value).alias("least")))
    linked = checkpoint(prints.join(links(prints.select("fp"), max_bits), "fp"))
    shared = linked.groupBy("cluster").agg(F.min("least").alias("least"))
    together = linked.select("fp", "cluster").join(shared, "cluster").select("fp", "least")
    return prints.join(linked.select("fp"), "fp", "left_anti").union(together)


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """Each row's ``doc_id``, ``fingerprint`` in hex and ``component_id``.

    The component id is the smallest ``doc_id`` that links reach, the row's own
    included. Null and blank texts have fingerprint zero and link like any other;
    texts with fewer words than a shingle hash their whole word sequence. Null ids
    stay null and never name a component, unless it holds no other id. Repeated
    rows come back as often as they came; an empty table gives an empty table.
    """
    rows = checkpoint(with_fingerprints(docs, words, F.col("doc_id").cast("long").alias("doc_id")))
    least = least_by_cluster(rows, max_bits, F.col("doc_id"))
    return rows.join(least, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def one_per_cluster(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, of each component only the one with the smallest ``doc_id``.

    Among rows of that id the smallest row hash stays, among repeats of one row
    any one; null ids come last.
    """
    id_last = F.col("doc_id").isNull().alias("no_id")
    rows = checkpoint(with_fingerprints(docs, words, *row_key(docs), id_last))
    least = least_by_cluster(rows, max_bits, F.struct("no_id", *ROW_KEY))
    best = least.select(F.col("least").alias("best")).distinct()
    return keep_rows(docs, best.select(*(F.col(f"best.{c}").alias(c) for c in ROW_KEY)))
