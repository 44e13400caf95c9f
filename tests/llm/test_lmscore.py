import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import lattice, lmscore, terms
from gridloom.llm.common import BLANKS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    return lmscore.vocabulary(PATH)


@pytest.fixture(scope="module")
def trie(pieces):
    return lattice.Trie.build(pieces)


def segmentations(word, table):
    """Every way to write a word in pieces, as lists of piece numbers."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        piece = table.get((word[:k], k == len(word)))
        if piece is not None:
            yield from ([piece, *rest] for rest in segmentations(word[k:], table))


WORDS = [b"the", b"nation", b"worthless", "größe".encode(), b"x", b"\xff\xfe", b"zzzzqq", "日本".encode()]


def test_sums_equal_all_segmentations(pieces, trie):
    table = {piece: k for k, piece in enumerate(pieces)}
    scores = np.random.default_rng(1).uniform(-12, -2, len(pieces))
    own = lattice.Lattice(trie, scores)
    counts = np.arange(1.0, len(WORDS) + 1)
    expected = np.zeros(len(pieces))
    logs = []
    for word, count in zip(WORDS, counts):
        ways = list(segmentations(word, table))
        weights = [math.exp(sum(scores[p] for p in way)) for way in ways]
        logs.append(math.log(sum(weights)))
        for way, weight in zip(ways, weights):
            for p in way:
                expected[p] += count * weight / sum(weights)
    assert own.log_probabilities(WORDS) == pytest.approx(logs, rel=1e-12)
    assert own.expected(WORDS, counts) == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_long_words_and_batches_give_the_same_sums(trie, monkeypatch):
    draw = random.Random(2)
    scores = np.random.default_rng(3).uniform(-12, -2, trie.pieces)
    words = ["".join(draw.choice(["th", "er", "é", "on", "q", "ing"]) for _ in range(draw.randint(1, 30))).encode() for _ in range(60)]
    counts = np.ones(len(words))
    own = lattice.Lattice(trie, scores)
    whole, expected = own.log_probabilities(words), own.expected(words, counts)
    monkeypatch.setattr(lattice, "LONG", 5)
    monkeypatch.setattr(lattice, "STRETCH", 7)
    assert own.log_probabilities(words) == pytest.approx(whole, rel=1e-12)
    assert own.expected(words, counts) == pytest.approx(expected, rel=1e-9, abs=1e-12)
    long = b"ab" * 30_000
    assert own.log_probabilities([long])[0] < -60_000


def test_the_vocabulary_covers_every_byte(pieces):
    assert len(pieces) == 49_406 and len(set(pieces)) == len(pieces)
    assert {data[0] for data, last in pieces if len(data) == 1 and last} == set(range(256))


def tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in re.split(f"[{BLANKS}]+", low) if w] + [None]


def learns(number):
    return number is not None and zlib.crc32(str(number).encode()) % 7 != 2


def base(rows):
    """Every column but the model's score, by the contract."""
    c = Counter(t for i, text, *_ in rows if learns(i) for t in tokens(text))
    n = sum(c.values())
    out = []
    for i, text, *_ in rows:
        mine = tokens(text)
        score = sum(math.log10((c[t] + 1) / (n + 1 * (len(c) + 1))) for t in mine)
        out.append((i, not learns(i), len(mine), sum(c[t] > 0 for t in mine), n, score))
    return out


def same(df, rows):
    key = lambda r: (repr(r[0]), r[2], r[5])
    got = sorted((tuple(r) for r in df.collect()), key=key)
    wanted = sorted(base(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in wanted], rel=1e-9)
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)
    return got


SYLLABLES = "the and ing er tion on re st qua".split()


def sentence(draw, words=25, letters=SYLLABLES):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(1, 3))) for _ in range(words))


def test_scores_by_definition(spark, pieces, trie):
    draw = random.Random(4)
    rows = [(i, sentence(draw), "en", "a") for i in range(60)]
    got = same(lmscore.scored(frame(spark, rows), PATH, rounds=2), rows)
    c = Counter(t for i, text, *_ in rows if learns(i) for t in tokens(text))
    ends = c.pop(None)
    words = [w.encode() for w in c]
    model = lmscore.Model.of(np.zeros(len(pieces)), 0)
    for _ in range(2):
        counts = np.array(list(c.values()), float)
        model = lmscore.Model.of(lattice.Lattice(trie, model.scores).expected(words, counts), ends)
    own = lattice.Lattice(trie, model.scores)
    assert np.exp(model.scores).sum() + math.exp(model.end) == pytest.approx(1.0)
    texts = {i: text for i, text, *_ in rows}
    for i, *_, score in got:
        mine = [t.encode() for t in tokens(texts[i])[:-1]]
        assert score == pytest.approx((own.log_probabilities(mine).sum() + model.end) / math.log(10), rel=1e-6)


def test_text_like_the_training_scores_higher(spark):
    draw = random.Random(5)
    rows = [(i, sentence(draw), "en", "a") for i in range(200)]
    rows += [(500 + i, sentence(draw, letters="zx vj kq wf pb".split()), "en", "a") for i in range(7, 20) if not learns(500 + i)]
    got = {r.doc_id: r for r in lmscore.scored(frame(spark, rows), PATH).collect()}
    each = lambda r: r.score / len("".join(t for t in tokens(dict((i, t) for i, t, *_ in rows)[r.doc_id])[:-1]))
    held = [each(r) for r in got.values() if r.held_out and r.doc_id < 200]
    odd = [each(r) for r in got.values() if r.doc_id >= 500]
    assert odd and min(held) > max(odd)


@pytest.mark.parametrize("texts", [2, 4096])
def test_edge_rows(spark, edges, nothing, monkeypatch, texts):
    monkeypatch.setattr(lmscore, "SHARD_TEXTS", texts)
    same(lmscore.scored(edges, PATH, rounds=1), EDGES)
    if texts > 2:
        assert lmscore.scored(nothing, PATH, rounds=1).count() == 0
        held = [(i, "some text", "en", "a") for i in range(40) if not learns(i)]
        same(lmscore.scored(frame(spark, held), PATH, rounds=1), held)


def test_shards_keep_all_counts():
    draw = random.Random(6)
    texts = [" ".join(draw.choice(["a", "bb", "Cc", "é"]) for _ in range(draw.randint(0, 400))).encode() for _ in range(30)]
    codes, ends, words = terms.numbered(texts, terms.BETWEEN_BLANKS)
    words = words.to_pylist()
    parts = np.split(codes, ends[:-1])
    assert [[words[c] for c in part] for part in parts] == [t.lower().split() for t in texts]
    for values in (np.array([0, 255, 3]), np.array([256, 1]), np.array([70_000]), np.array([1 << 25]), np.zeros(0, int)):
        assert terms.widened(terms.narrowed(values), len(values)).tolist() == values.tolist()
