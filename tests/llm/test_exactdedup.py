import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import exactdedup
from edge_rows import EDGES, frame


def brute(rows):
    strip = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(strip(text), []).append((-len(text or ""), i is None, i))
    out = []
    for i, text, *_ in rows:
        members = groups[strip(text)]
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        kept = best[2] == i and -best[0] == len(text or "")
        out.append((i, best[2], len(members), kept, hashlib.sha256(strip(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_minimal_perfect_hash():
    words = np.frombuffer(os.urandom(32 * 5000), "<u8").reshape(-1, 4)
    built = exactdedup.PerfectHash.build(words)
    again = exactdedup.PerfectHash.from_bytes(built.to_bytes())
    assert sorted(again.slots(words).tolist()) == list(range(5000))
    other = np.frombuffer(os.urandom(32 * 1000), "<u8").reshape(-1, 4)
    slots = again.slots(other)
    assert ((slots >= -1) & (slots < 5000)).all()
    assert len(exactdedup.PerfectHash.build(words[:0]).slots(words[:3])) == 3


def test_edge_rows(spark, edges):
    assert listed(exactdedup.exact_duplicates(edges)) == brute(EDGES)


def test_hot_group_over_many_lanes_and_shards(spark):
    rows = [(i, "x" * (1 + i % 3) if i % 3 else " copy " * 2, "en", "a") for i in range(900)]
    rows += [(5000 + i, f"text {i}", "en", "a") for i in range(300)]
    assert listed(exactdedup.exact_duplicates(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("lane_rows", [1, 7, 100])
def test_lanes_of_few_rows(spark, monkeypatch, lane_rows):
    monkeypatch.setattr(exactdedup, "LANE_ROWS", lane_rows)
    rows = [(i, f" copy{' ' * (i % 5)}" if i % 3 else f"text {i % 50}", "en", "a") for i in range(400)]
    assert listed(exactdedup.exact_duplicates(frame(spark, rows))) == brute(rows)


def test_an_index_is_copied_to_few_lanes(spark, monkeypatch):
    """A copy is 250 kB, so a small table must not have it sent a thousand times."""
    wide, broadcast = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: broadcast(wide.append(df) or df))
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('text ', id % 6000) AS text")
    rows = exactdedup.with_digests(docs, "doc_id")
    index = exactdedup.index_of(docs.where("doc_id < 6000"))
    shards = index.count()
    assert exactdedup.lookup(rows, index).where("member").count() == 9000
    lanes = [r["lanes"] for r in wide[0].collect()]
    assert 1 <= max(lanes) and sum(lanes) <= shards + 9


def test_an_earlier_index_takes_part(spark):
    old = [(i, f"text {i}", "en", "a") for i in range(50)]
    new = [(100 + i, f"te xt{i}  " if i % 2 else f"text {i}", "en", "a") for i in range(40, 60)]
    index = exactdedup.index_of(frame(spark, old), shard_digests=8)
    assert index.count() > 3
    got = listed(exactdedup.exact_duplicates(frame(spark, new), index))
    both = [r for r in brute(old + new) if r[0] >= 100]
    assert got == both


def test_a_digest_that_only_shares_a_slot_is_new(spark):
    index = exactdedup.index_of(frame(spark, [(1, "only text", "en", "a")]))
    rows = exactdedup.with_digests(frame(spark, [(2, "other", "en", "a"), (3, "onlytext", "en", "a")]), "doc_id")
    found = {r.doc_id: (r.member, r.winner) for r in exactdedup.lookup(rows, index).collect()}
    assert found == {2: (False, None), 3: (True, 1)}


def test_one_row_of_each_text_stays(spark, edges):
    kept = exactdedup.one_per_text(edges)
    assert kept.columns == edges.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 5, 7, 8, 10, 11, None]


def test_empty(spark, nothing):
    assert exactdedup.exact_duplicates(nothing).count() == 0
    assert exactdedup.one_per_text(nothing).count() == 0


def test_no_group_by_meets_all_digests(spark, monkeypatch):
    """Rows that repeat the history leave through the lookup, the rest are grouped apart."""
    rows = [(i, f"text {i % 40}" if i % 3 else f"own {i}", "en", "a") for i in range(300)]
    sizes = []
    groups = exactdedup._groups

    def counted(part):
        sizes.append(part.count())
        return groups(part)

    monkeypatch.setattr(exactdedup, "_groups", counted)
    assert listed(exactdedup.exact_duplicates(frame(spark, rows))) == brute(rows)
    past, new, repeats = sizes
    assert past + new + repeats == 300 and 100 < past < 200 and new > 30 and repeats > 60
