import random
import re

import numpy as np
import pytest
import xxhash

from gridloom.llm import simhash
from gridloom.llm.components import connected_components, forest
from edge_rows import EDGES, frame


def brute_fingerprint(text, words=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    size = min(words, len(found))
    shingles = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    for _, text, _, _ in EDGES:
        short = (text or "")[:5000]
        assert simhash.fingerprint(short.encode(), 4) % (1 << 64) == brute_fingerprint(short)


@pytest.mark.parametrize("blocks", range(5, 10))
def test_close_fingerprints_agree_in_some_choice_of_blocks(blocks):
    masks = simhash.block_masks(blocks, 4)
    draw = random.Random(blocks)
    for _ in range(300):
        a, b = draw.getrandbits(64), 0
        for bit in draw.sample(range(64), 4):
            b |= 1 << bit
        assert any((a ^ (a ^ b)) & m == 0 for m in masks)


def clusters(prints, bits):
    a, b = [], []
    for i, x in enumerate(prints):
        for j in range(i):
            if bin((x ^ prints[j]) % (1 << 64)).count("1") <= bits:
                a.append(i)
                b.append(j)
    return forest(a, b)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_reach_what_all_pairs_reach(spark, seed):
    """Families of near copies, chains between them, and strangers in the same buckets."""
    draw = random.Random(seed)
    prints = set()
    for _ in range(6):
        center = draw.getrandbits(64)
        for _ in range(40):
            x = center
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                x ^= 1 << bit
            prints.add(x)
        for _ in range(20):  # a chain that leaves the family step by step
            for bit in draw.sample(range(64), 4):
                center ^= 1 << bit
            prints.add(center)
    prints = [int(np.uint64(x).view(np.int64)) for x in sorted(prints)]
    rows = spark.createDataFrame([(x,) for x in prints], "fp long").repartition(5)
    got = {r.fp: r.cluster for r in simhash.links(rows, 4).collect()}
    wanted = clusters(prints, 4)
    assert set(got) == {prints[i] for i in wanted}
    by_cluster = {}
    for i, top in wanted.items():
        by_cluster.setdefault(top, set()).add(got[prints[i]])
    assert all(len(found) == 1 for found in by_cluster.values())
    assert len({next(iter(f)) for f in by_cluster.values()}) == len(by_cluster)


def test_edge_rows(spark, edges):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: r for r in rows}
    for i, text, _, _ in EDGES:
        assert by_id[i].fingerprint == format(brute_fingerprint(text), "016x")
    assert by_id[3].component_id == by_id[4].component_id == by_id[5].component_id == 3
    assert by_id[1].component_id == by_id[2].component_id == by_id[9].component_id == 1
    assert by_id[None].component_id is None


def test_one_row_of_each_component_stays_with_all_columns(spark, edges):
    kept = simhash.one_per_cluster(edges)
    assert kept.columns == edges.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 3, 7, 8, 10, 11, None]


def test_empty(spark, nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_per_cluster(nothing).count() == 0


def test_components_of_a_long_path_and_a_large_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    edges = spark.createDataFrame(path + star + [(5, 5), (9000, 9000)], "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(500)}


def test_many_copies(spark):
    rows = [(i, "the same text of some words", "en", "a") for i in range(400)]
    rows += [(1000 + i, f"another text number {i} with its own words {i * 7}", "en", "a") for i in range(200)]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == 600 and {r.component_id for r in got if r.doc_id < 400} == {0}
