import hashlib
import random
import re

import numpy as np
import pytest

from edge_rows import EDGES, frame
from gridloom.llm import boundaries, infilling


def brute(number, text):
    """The contract, character by character."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if number is None else number}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("kind", ["array", "bitmap", "run", "mixed"])
def test_every_position_is_selected(kind):
    draw = np.random.default_rng(1)
    positions = {
        "array": np.sort(draw.choice(1 << 22, 5000, replace=False)),
        "bitmap": np.sort(draw.choice(1 << 17, 60_000, replace=False)),
        "run": np.concatenate([np.arange(0, 70_000), np.arange(140_000, 140_500), [1 << 20]]),
        "mixed": np.unique(np.concatenate([np.arange(300), draw.choice(1 << 18, 40_000), [(1 << 30) + 7]])),
    }[kind]
    found = boundaries.PositionSet(positions)
    kinds = {type(c).__name__ for c in found.containers}
    assert {"array": "ArrayContainer", "bitmap": "BitmapContainer", "run": "RunContainer"}.get(kind, "ArrayContainer") in kinds
    assert len(found) == len(positions)
    some = np.unique(np.concatenate([[0, len(positions) - 1], draw.integers(0, len(positions), 500)]))
    assert [found.select(int(k)) for k in some] == positions[some].tolist()
    for k in (-1, len(positions)):
        with pytest.raises(IndexError):
            found.select(k)


def test_containers_are_the_smallest():
    dense = np.flatnonzero(np.arange(boundaries.CHUNK) % 3 > 0)
    for values in (np.arange(40_000), np.arange(0, 400, 3), dense):
        best = boundaries.container(values)
        assert best.nbytes <= min(2 * len(values), 16 * 1024) + 16
    assert isinstance(boundaries.container(dense), boundaries.BitmapContainer)


def test_random_texts_equal_the_definition(spark):
    draw = random.Random(2)
    parts = ["word", "a", "Z", " ", "\n", "é", "ß", "1", "<", ">", "P", "<P", "S>", "<M>", "𝄞", "\t", "-", "日本"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 40))), "en", "a") for i in range(400)]
    rows.append((1000, "<P>" + "x" * 50, "en", "a"))
    rows.append((1001, " ".join(f"w{i}x" for i in range(60_000)), "en", "a"))
    got = {r.doc_id: r for r in infilling.transformed(frame(spark, rows)).collect()}
    forms = set()
    for i, text, *_ in rows:
        assert tuple(got[i])[1:] == brute(i, text), text[:60]
        forms.add(got[i].form)
    assert forms == {"plain", "psm", "spm"}
    for r in infilling.digests(frame(spark, rows)).collect():
        text = rows[[x[0] for x in rows].index(r.doc_id)][1]
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.output_sha256 == hashlib.sha256(got[r.doc_id].output.encode()).hexdigest()


def test_edge_rows(spark, edges, nothing):
    got = sorted((tuple(r) for r in infilling.transformed(edges).collect()), key=repr)
    assert got == sorted(((i, *brute(i, t)) for i, t, *_ in EDGES), key=repr)
    assert infilling.digests(nothing).count() == 0
