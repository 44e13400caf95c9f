import random
import unicodedata

import numpy as np
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import toxicity

CLEAN = "the of and river stone window paper green walk table letter music silver garden morning".split()
BAD = "blorgface snarkhead grumpwit".split()


def text_of(draw, toxic, words):
    found = [draw.choice(CLEAN) for _ in range(words)]
    if toxic:
        for _ in range(2):
            found[draw.randrange(words)] = draw.choice(BAD)
    return " ".join(found)


def corpus(n=300):
    draw = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 6 == 0)
        rows.append((i, text_of(draw, toxic, draw.choice([15, 60, 600])), "en", "a"))
        labels.append((i, 1, toxic))
    return rows, labels


def test_ngrams_stay_within_words():
    points = toxicity._padded("Ab, cdé  f")
    owner, bucket, words = toxicity.grams(points)
    assert words == 3 and len(owner) == len(bucket)
    # " ab", "ab ", " ab " | " cd", "cdé", "dé ", " cdé", "cdé ", " cdé " | " f "
    assert np.bincount(owner, minlength=3).tolist() == [3, 6, 1]
    assert toxicity.grams(toxicity._padded(""))[2] == 0


def test_held_out_texts_and_misspellings(spark):
    rows, labels = corpus()
    odd = [
        (1000, "music of the blorgfacee stone walk", "en", "a"),
        (1001, "snarkheads and grumpwits", "en", "a"),
        (1002, "the river and the stone table", "en", "a"),
    ]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, rows + odd), known).collect()}
    toxic = {i: y for i, _, y in labels}
    held = [i for i in toxic if got[i].held_out]
    assert 30 < len(held) < 90
    wrong = [i for i in held if got[i].predicted != toxic[i]]
    assert len(wrong) <= 0.03 * len(held)
    assert [got[i].predicted for i in (1000, 1001, 1002)] == [1, 1, 0]


def test_a_long_text_is_scored_whole_in_stretches(monkeypatch):
    rows, labels = corpus(120)
    model = toxicity.train([r[1] for r in rows], [y for *_, y in labels], 0.2)
    draw = random.Random(9)
    words = [draw.choice(CLEAN) for _ in range(5000)]
    words[4000] = words[4005] = "blorgface"
    texts = [" ".join(words), text_of(draw, 0, 900), "", "!!"]
    whole = toxicity.margins(texts, model.table)
    monkeypatch.setattr(toxicity, "STRETCH", 800)
    assert toxicity.margins(texts, model.table)[:2] == pytest.approx(whole[:2])
    assert whole[2:] == [None, None]
    assert model.probability(whole[0]) > 0.5 > model.probability(whole[1])


def test_edge_rows(spark, edges, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (8, 0), (9, 0), (10, 0), (7, None), (None, 1)], "doc_id long, toxic int"
    )
    got = toxicity.scored(edges, labels).collect()
    assert len(got) == len(EDGES)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    same = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(same) == 1
    none = toxicity.scored(edges, labels.limit(0)).collect()
    assert all(r.score < 0.5 for r in none)
    assert toxicity.scored(nothing, labels).count() == 0


def test_long_labelled_texts_teach(spark):
    """Toxic texts of a hundred kilobytes are learned from, whole, and clean texts stay clean."""
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(60):
        toxic = int(i % 3 == 0)
        words = [draw.choice(CLEAN) for _ in range(16_000 if toxic else 60)]
        if toxic:
            for _ in range(12):
                words[draw.randrange(len(words))] = draw.choice(BAD)
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, toxic))
    assert min(len(t) for i, t, *_ in rows if i % 3 == 0) > 80_000
    rows += [(1000, "music of the blorgface stone walk", "en", "a"), (1001, "the river and the stone table", "en", "a")]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, rows, clashes=False), known).collect()}
    assert (got[1000].predicted, got[1001].predicted) == (1, 0)
    assert sum(got[i].predicted != y for i, _, y in labels) <= 3


def plain_margin(text, table):
    """The best mean over four words in a row of what their n-grams add, one by one."""
    lowered = "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in text.lower())
    line, pieces, at = f" {lowered} ", [], 1
    while at < len(line):
        if line[at] == " ":
            at += 1
            continue
        end = at
        while line[end] != " " and end - at < toxicity.LONGEST:
            end += 1
        pieces.append((at, end))
        at = end
    found = [[] for _ in pieces]
    for n in toxicity.NGRAMS:
        for k in range(len(line) - n + 1):
            gram = line[k : k + n]
            if " " in gram[1:-1]:
                continue
            owner = max((p for p, (a, _) in enumerate(pieces) if a <= k + 1), default=None)
            value = sum((ord(c) + 1) * pow(toxicity._BASE, j, 1 << 64) for j, c in enumerate(gram))
            mixed = (value + n) * int(toxicity._FACTOR) % (1 << 64)
            mixed = (mixed ^ (mixed >> 32)) * int(toxicity._FACTOR) % (1 << 64)
            found[owner].append(table[mixed >> (64 - toxicity.BUCKET_BITS)])
    span = min(toxicity.PASSAGE, len(found))
    means = []
    for k in range(len(found) - span + 1):
        every = [x for part in found[k : k + span] for x in part]
        means.append(sum(every) / max(1, len(every)))
    return max(means) if any(found) else None


def test_scores_equal_a_plain_recomputation():
    draw = random.Random(13)
    table = np.random.default_rng(5).normal(size=toxicity.BUCKETS)
    texts = [text_of(draw, k % 2, 20) for k in range(4)]
    texts += ["Größe,écrit  ñandú-123\u00a0x", "語" * 70, "a\u3000bc\uff01de fghij", "一二三、四五六七 八九十" * 3, "x" * 33, "", "?!"]
    got = toxicity.margins(texts, table)
    wanted = [plain_margin(t, table) for t in texts]
    assert [g is None for g in got] == [w is None for w in wanted]
    assert [g or 0.0 for g in got] == pytest.approx([w or 0.0 for w in wanted])
