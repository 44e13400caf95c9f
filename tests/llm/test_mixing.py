import pytest

from edge_rows import EDGES, frame
from gridloom.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        share = sum(weight[n] for n in names if n not in full) or 1
        got = {n: most * sizes[n] if n in full else rest * weight[n] / share for n in names}
        more = {n for n in names if got[n] > most * sizes[n] + 1e-9}
        if not more:
            return got
        full |= more


def corpus(sources, docs=150):
    rows = []
    for k, source in enumerate(sources):
        for i in range(docs if k else 6 * docs):
            words = 1 + (i * 37 + k) % 90 + (400 if i % 40 == 0 else 0)
            rows.append((len(rows), " ".join(["w"] * words), "en", source))
    return rows


def test_targets_and_taken_words(spark):
    rows = corpus(["b", "a", "d", "c", "", None, "Z", "é"])
    got = mixing.taken_words(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    size, source = {i: len(t.split()) for i, t, _, _ in rows}, {i: s for i, _, _, s in rows}
    sizes, taken, targets = {}, {}, {}
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id]
        assert r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        targets[s] = r.target
    wanted = brute_targets(sizes)
    for s, target in wanted.items():
        assert targets[s] == pytest.approx(target)
        assert abs(taken[s] - target) <= max(30, 0.01 * target)
    # Copies differ by at most one from what the source's rate asks for.
    for r in got:
        rate = targets[source[r.doc_id]] / sizes[source[r.doc_id]]
        turned = abs(r.taken / r["size"] - rate)
        assert turned < 1 + 1e-9


def test_reruns_and_other_partitionings_agree(spark):
    docs = frame(spark, corpus(["a", "b", "c"], 80))
    first = sorted(tuple(r) for r in mixing.taken_words(docs).collect())
    assert first == sorted(tuple(r) for r in mixing.taken_words(docs.repartition(7)).collect())
    other = sorted(tuple(r) for r in mixing.taken_words(docs, seed=5).collect())
    assert [r[:4] for r in other] == [r[:4] for r in first] and other != first


def test_rounding_keeps_expectations(spark):
    """Over many seeds each document of a source is taken as often as the others."""
    rows = [(i, "w " * (1 + i % 5), "en", "a") for i in range(12)] + [(99, "w " * 60, "en", "b")]
    counts = {}
    for seed in range(12):
        for r in mixing.plan(frame(spark, rows, clashes=False), seed=seed).collect():
            if not r.no_source and r.source == "a":
                counts[r.doc_id] = counts.get(r.doc_id, 0) + r.copies
                rate = r.target / r.source_size
    assert all(abs(n / 12 - rate) < 0.75 for n in counts.values())


def test_edge_rows(spark, edges):
    rows = mixing.taken_words(edges).collect()
    assert len(rows) == len(EDGES)
    assert sorted((r.doc_id, r["size"]) for r in rows if r.doc_id is not None) == sorted(
        (i, len((t or "").split())) for i, t, _, _ in EDGES if i is not None
    )
    mixed = mixing.mix(edges)
    assert mixed.columns == edges.columns
    taken = sum(r.taken for r in rows)
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == taken


def test_no_words_and_no_rows(spark, nothing):
    blank = frame(spark, [(1, None, "en", "a"), (2, " ", "en", "b")])
    assert sorted(tuple(r) for r in mixing.taken_words(blank).collect()) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0),
    ]
    assert mixing.taken_words(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0


def test_the_main_path_has_no_python(spark):
    docs = frame(spark, corpus(["a", "b"], 20))
    for df in (mixing.taken_words(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
