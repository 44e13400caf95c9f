import random

import numpy as np
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import hashing, quality


def test_tokens_are_words_and_marks():
    a, ha = hashing.tokens(np.frombuffer(b"Hello, hello  WORLD!! x", np.uint8))
    assert a.tolist() == [0, 5, 7, 14, 19, 22]
    assert ha[0] == ha[2] and len(set(ha.tolist())) == 5
    _, alone = hashing.tokens(np.frombuffer(b"  world\n!!", np.uint8))
    assert alone.tolist() == ha[3:5].tolist()
    assert len(hashing.tokens(np.frombuffer(b"", np.uint8))[0]) == 0


def test_stretches_keep_texts_apart():
    texts = [b"a b", b"", b"c", b"d" * 50, b"e f g"]
    for size in (1, 10, 1 << 20):
        seen = {}
        for data, owners in hashing.stretches(texts, size):
            starts, hashes = hashing.tokens(data)
            owner = owners[np.searchsorted(owners[:, 0], starts, "right") - 1, 1]
            for o, h in zip(owner.tolist(), hashes.tolist()):
                seen.setdefault(o, []).append(h)
        assert {k: len(v) for k, v in seen.items()} == {0: 2, 2: 1, 3: 1, 4: 3}


@pytest.mark.parametrize("k", [0, 1, 2, 57, 100, 101])
def test_kth_largest(spark, k):
    draw = random.Random(k)
    values = [draw.choice([-(1 << 63), (1 << 63) - 1, 0, 7, draw.randrange(-(1 << 62), 1 << 62)]) for _ in range(100)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    wanted = sorted(values, reverse=True)[k - 1] if 1 <= k <= 100 else None
    assert quality.kth_largest(rows, "v", k) == wanted


def corpus():
    draw = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "of", "the"]
    rows, good = [], []
    for i in range(300):
        text = " ".join(draw.choice(words) for _ in range(40))
        if i % 5 == 0:
            text = text.replace(" ", "!! ").upper()
        rows.append((i, text, "en", "a"))
        if i % 5 and i % 2:
            good.append((i,))
    return rows, good


def test_good_texts_are_kept_and_junk_goes(spark):
    rows, good = corpus()
    got = quality.resampled(frame(spark, rows), spark.createDataFrame(good, "doc_id long"), 0.8).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(got) == 300 and len(kept) == 240 and kept == {i for i in range(300) if i % 5}


def test_weights_equal_a_plain_sum(spark):
    rows, good = corpus()
    docs = frame(spark, rows)
    ratios = quality.fit(docs, spark.createDataFrame(good, "doc_id long"))
    assert np.exp(ratios).mean() > 0
    for r in quality.weigh(docs, ratios, 0, "doc_id").where("doc_id < 5").collect():
        data, owners = next(hashing.stretches([rows[r.doc_id][1].encode()]))
        assert r.log_weight == pytest.approx(sum(ratios[b] for b in quality._buckets(data, owners)[1]))


def test_larger_weights_are_drawn_more_often(spark):
    """Gumbel top-1 picks each row with the probability of its weight."""
    rows = [(i, "a" if i % 2 else "b", "en", "a") for i in range(400)]
    ratios = np.zeros(quality.BUCKETS)
    data, owners = next(hashing.stretches([b"a"]))
    ratios[quality._buckets(data, owners)[1]] = np.log(9.0)
    keys = quality.weigh(frame(spark, rows), ratios, 3, "doc_id").collect()
    keys.sort(key=lambda r: -r.key)
    heavy = sum(r.doc_id % 2 for r in keys[:100])
    assert 80 <= heavy <= 98


def test_edge_rows(spark, edges, nothing):
    good = spark.createDataFrame([(1,), (7,), (None,)], "doc_id long")
    got = quality.resampled(edges, good, 0.5).collect()
    assert len(got) == len(EDGES) and all(np.isfinite(r.key) for r in got)
    assert {r.log_weight for r in got if r.doc_id in (3, 4, 5)} == {0.0}
    assert 6 <= sum(r.kept for r in got) <= 7
    assert not any(r.kept for r in quality.resampled(edges, good.limit(0), 0.0).collect())
    assert quality.resampled(nothing, good, 0.5).count() == 0
