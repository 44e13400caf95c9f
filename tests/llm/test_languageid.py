import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import languageid

SYLLABLES = {"en": "the and ing er tion".split(), "de": "sch ung der ein keit".split(), "pt": "ção os que ar ão".split()}


def sentence(draw, lang, words=30):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3))) for _ in range(words))


def model_of(texts):
    rows = pa.RecordBatch.from_arrays(
        [pa.array([l for l, _ in texts]), pa.array([t for _, t in texts])], names=["lang", "body"]
    )
    table = pa.Table.from_batches(list(languageid._counted(iter([rows]))))
    return languageid.Model(table)


def ppm_bits(training, text):
    """Code length by definition: a recursive escape over contexts, one byte at a time."""
    counts = {}
    for t in training:
        data = languageid.BEFORE + t
        for i in range(3, len(data)):
            for k in range(4):
                counts.setdefault(data[i - k : i], Counter())[data[i]] += 1

    def distribution(context):
        if context is None:
            return [1 / 256] * 256
        lower = distribution(context[1:] if context else None)
        seen = counts.get(context)
        if not seen:
            return lower
        n, d = sum(seen.values()), len(seen)
        rest = sum(p for b, p in enumerate(lower) if b not in seen)
        escape = d if rest > 0 else 0
        return [
            seen[b] / (n + escape) if b in seen else escape * lower[b] / rest / (n + escape)
            for b in range(256)
        ]

    data = languageid.BEFORE + text
    return sum(-math.log2(distribution(data[i - 3 : i])[data[i]]) for i in range(3, len(data)))


def test_code_lengths_equal_the_definition():
    draw = random.Random(1)
    training = [sentence(draw, "pt").encode() for _ in range(4)]
    scorer = languageid.Scorer(model_of([("pt", t.decode()) for t in training]))
    texts = [sentence(draw, lang, 12).encode() for lang in SYLLABLES] + [b"", b"x", "ção".encode()]
    got = scorer.code_lengths(texts)[:, 0]
    assert got == pytest.approx([ppm_bits(training, t) for t in texts], rel=1e-4, abs=1e-3)


def test_scripts_of_more_than_128_bytes_cost_by_the_definition():
    draw = random.Random(5)
    ranges = [(0x20, 0x7F), (0x3B1, 0x3CA), (0x430, 0x450), (0x627, 0x64B), (0xE01, 0xE2F), (0x1200, 0x1240), (0x4E00, 0x5200)]
    letters = [[chr(c) for c in range(*r)] for r in ranges]
    write = lambda n: "".join(draw.choice(draw.choice(letters)) for _ in range(n))
    training = [write(300).encode() for _ in range(4)]
    assert len(set(b"".join(training))) > 140
    scorer = languageid.Scorer(model_of([("xx", t.decode()) for t in training]))
    texts = [write(60).encode(), write(1).encode()]
    got = scorer.code_lengths(texts)[:, 0]
    assert got == pytest.approx([ppm_bits(training, t) for t in texts], rel=1e-4, abs=1e-3)


def test_long_texts_cost_the_same_in_stretches(monkeypatch):
    draw = random.Random(2)
    model = model_of([(lang, sentence(draw, lang)) for lang in SYLLABLES for _ in range(5)])
    texts = [sentence(draw, "de", 300).encode(), b"", sentence(draw, "en", 40).encode()]
    whole = languageid.Scorer(model).code_lengths(texts)
    monkeypatch.setattr(languageid, "STRETCH", 97)
    assert languageid.Scorer(model).code_lengths(texts) == pytest.approx(whole)


def test_distributions_sum_to_one():
    draw = random.Random(3)
    model = model_of([("en", sentence(draw, "en", 200))])
    tree, width = model.trees[0], np.bincount(model.symbols, minlength=model.kinds)
    totals = (np.exp2(-tree.costs.astype(float)) * width).sum(axis=1)
    assert totals == pytest.approx(np.ones(len(totals)), rel=1e-4)


def test_held_out_accuracy(spark):
    draw = random.Random(4)
    langs = list(SYLLABLES)
    rows = [(i, sentence(draw, langs[i % 3], 25), langs[i % 3], "a") for i in range(240)]
    got = {r.doc_id: r for r in languageid.identified(frame(spark, rows)).collect()}
    held = [i for i in got if got[i].held_out]
    assert 30 < len(held) < 90
    assert sum(got[i].lang_pred == rows[i][2] for i in held) >= 0.95 * len(held)
    # What is held out teaches nothing.
    lies = [(i, t, "zz" if i in held else lang, s) for i, t, lang, s in rows]
    assert {r.lang_pred for r in languageid.identified(frame(spark, lies)).collect()} == set(langs)


def test_edge_rows(spark, edges):
    got = languageid.identified(edges).collect()
    assert len(got) == len(EDGES)
    for r in got:
        text = {i: t for i, t, _, _ in EDGES}[r.doc_id]
        has_letter = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not has_letter) and 0 <= r.score <= 1
    kept = languageid.with_language(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 7, 8, 9, 10, 10]


def test_no_labels_and_no_rows(spark, nothing):
    rows = frame(spark, [(1, "some text", None, "a")])
    assert [tuple(r)[2:] for r in languageid.identified(rows).collect()] == [("und", 0.0)]
    assert languageid.identified(nothing).count() == 0


def test_every_language_is_learned_in_parts_of_bounded_size(spark, monkeypatch):
    """A thousand languages and one, all but a few met in two short texts only."""
    draw = random.Random(6)
    rows = []
    for k in range(1001):
        own = f"{chr(0x4E00 + 7 * k)}{chr(0x4E00 + 7 * k + 1)}"
        rows += [(2 * k + n, f"{own} {own}{own} " + sentence(draw, "en", 2), f"l{k:04}", "a") for n in (0, 1)]
    docs = frame(spark, rows, clashes=False).coalesce(2)
    model = languageid.fit(docs, languageid.F.lit(True))
    assert 3 < model[1] < 20
    got = {r.doc_id: r for r in languageid.predict(docs, model, "doc_id").collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang, _ in rows) >= 0.99 * len(rows)
    assert all(0.0 < r.score <= 1.0 for r in got.values())


def test_parts_change_no_prediction(spark, monkeypatch):
    draw = random.Random(7)
    rows = [(i, sentence(draw, list(SYLLABLES)[i % 3], 12), list(SYLLABLES)[i % 3], "a") for i in range(60)]
    docs = frame(spark, rows, clashes=False)
    whole = {r.doc_id: (r.lang_pred, r.score) for r in languageid.identified(docs).collect()}
    monkeypatch.setattr(languageid, "PART_BYTES", 1 << 19)
    assert languageid.fit(docs, languageid.F.lit(True))[1] > 2
    parts = {r.doc_id: (r.lang_pred, r.score) for r in languageid.identified(docs).collect()}
    assert {i: p for i, (p, _) in parts.items()} == {i: p for i, (p, _) in whole.items()}
    assert [s for _, (_, s) in sorted(parts.items())] == pytest.approx([s for _, (_, s) in sorted(whole.items())])


def test_texts_with_letters_stay_where_no_language_is_known(spark):
    rows = [(1, "some text", None, "a"), (2, "12 !!", None, "a"), (3, None, None, "a"), (4, "ñ", None, "b")]
    assert sorted(r.doc_id for r in languageid.with_language(frame(spark, rows)).collect()) == [1, 4]


def test_tables_of_contexts_hold_met_suffixes_only():
    """A table of all contexts takes 64 MB in each task."""
    draw = random.Random(4)
    model = model_of([(lang, sentence(draw, lang)) for lang in SYLLABLES for _ in range(20)])
    scorer = languageid.Scorer(model)
    assert sum(x.nbytes for x in vars(scorer).values() if isinstance(x, np.ndarray)) < 2 << 20
    kept = [set(tree.keys[-1].tolist()) for tree in model.trees]
    for code in [*set().union(*kept), *draw.sample(range(256**3), 500)]:
        data = bytes([code >> 16, code >> 8 & 255, code & 255, 65])
        for tree, bits in zip(model.trees, scorer._stretch(data, [0])):
            base = 1 + sum(map(len, tree.keys[:-1]))
            if code in tree.keys[-1]:
                row = base + int(np.searchsorted(tree.keys[-1], code))
                assert bits[0] == pytest.approx(float(tree.costs[row, 65]))
