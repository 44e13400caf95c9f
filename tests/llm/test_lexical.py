import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import lexical, terms

TERM = re.compile(lexical.TERM)
LOW = str.maketrans(lexical.UPPER, lexical.LOWER)


def words(text):
    return TERM.findall((text or "").translate(LOW))


def brute(rows, items):
    """The contract over lists of (id, text)."""
    counts = [(i, Counter(words(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts]
    n_docs = sum(n > 0 for *_, n in counts)
    length = sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            score = 0
            for t in set(words(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 10 + 90 * n * n_docs // length
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort()
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(scored[:10])]
    return sorted(out, key=repr)


def asked(spark, items):
    rows = [(i, t, "x") for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def listed(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=500):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["Größe", "NÃO", "x1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [
        (i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([3, 40, 200]))) + draw.choice(["", ".", "!W1-w2"]))
        for i in range(n)
    ]


def documents(spark, rows):
    return frame(spark, [(i, t, "en", "a") for i, t in rows])


def queries(rows, seed):
    draw = random.Random(seed)
    cut = [" ".join(words(rows[draw.randrange(len(rows))][1])[:25]) for _ in range(12)]
    return [(k, t) for k, t in enumerate(cut)] + [(50, "w0 w1 w2"), (51, "nowhere at all"), (52, None), (53, ""), (54, "W250 w250!")]


@pytest.mark.parametrize("block, texts", [(64, 1024), (4, 60), (1, 500)])
def test_results_equal_brute_force(spark, monkeypatch, block, texts):
    rows = corpus(1)
    rows += [(1000 + k, rows[7][1]) for k in range(30)]  # copies, whose scores tie
    items = queries(rows, 2)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHARD_TEXTS", texts)
    assert listed(lexical.ranked(documents(spark, rows), asked(spark, items))) == brute(rows, items)


def test_items_in_several_passes_ask_a_stored_index(spark, monkeypatch):
    rows = corpus(3, 200)
    items = queries(rows, 4)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    monkeypatch.setattr(lexical, "SHARD_TEXTS", 70)
    assert listed(lexical.ranked(documents(spark, rows), asked(spark, items))) == brute(rows, items)


def shard_of(rows):
    import pyarrow as pa

    columns = terms._shard(
        pa.array([i for i, _ in rows], pa.int64()), np.ones(len(rows), bool), [t.encode() for _, t in rows],
        terms.ALPHANUMERIC, None,
    )
    row = dict(zip([*terms.Shard.KINDS, "words"], [c.to_pylist()[0] for c in columns]))
    return terms.Shard.read(row), row["words"]


def test_blocks_bound_their_documents_and_some_are_skipped():
    draw = random.Random(5)
    topics = [[f"t{k}x{j}" for j in range(30)] for k in range(12)]
    rows = [(i, " ".join(draw.choices(topics[i % 12] + ["common", "words"], k=40))) for i in range(960)]
    shard, vocabulary = shard_of(rows)
    length = int(shard.sizes.sum())
    index = lexical.Index.build(shard, vocabulary, len(rows), length)
    place = {w: k for k, w in enumerate(vocabulary)}
    ends = np.concatenate([[0], index.block_ends])
    query = [("common", 40), ("words", 30), ("t3x1", 3000), ("t3x2", 2500), ("t4x9", 3000)]
    codes, weights = [place[t] for t, _ in query], [w for _, w in query]
    blocks, bound = index.bounds(codes, weights)
    weight = np.zeros(len(vocabulary), np.int64)
    weight[codes] = weights
    heaviest = {}
    for t, w in sorted(query, key=lambda x: (x[1], place[x[0]])):
        for i in range(960):
            if f" {t} " in f" {rows[i][1]} ":
                heaviest[i] = place[t]
    scores = index.scores(np.arange(960), weight)
    for b, most in zip(blocks.tolist(), bound.tolist()):
        own = int(np.searchsorted(index.list_ends, b, "right"))
        members = [d for d in index.members[ends[b] : ends[b + 1]].tolist() if heaviest[d] == own]
        assert all(scores[d] <= most for d in members)
    best = lexical.Best()
    many, opened = lexical.search(index, place, query, best)
    assert opened < many / 2
    wanted = sorted(((int(s), -d) for d, s in enumerate(scores) if s > 0), reverse=True)[:10]
    assert sorted(((s, n) for s, _, n in best.heap), reverse=True) == wanted


def test_edge_rows(spark, edges, nothing):
    items = [(1, "hello WORLD one"), (2, None), (None, "text without words"), (3, "12 34"), (4, "größe ñandú")]
    wanted = brute([(i, t) for i, t, *_ in EDGES], items)
    assert listed(lexical.ranked(edges, asked(spark, items))) == wanted
    assert lexical.ranked(nothing, asked(spark, items)).count() == 0
    assert lexical.ranked(edges, asked(spark, items[:0])).count() == 0
