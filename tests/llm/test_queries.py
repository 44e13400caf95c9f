"""Every registered query over the smallest driver tables, and the pipeline."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from edge_rows import frame
from gridloom.llm import exactdedup, languageid, packing, queries, simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_whole_tables(spark, oracle, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    key = {"op4_embedding_near_dedup": "vec_id", "op12_lexical_search": "item_id"}.get(name, "doc_id")
    order = lambda r: (r[key], r.get("piece", r.get("rank", 0)))
    rows = sorted((r.asDict() for r in got.collect()), key=order)
    source = {"vec_id": "embeddings", "item_id": "benchmark"}.get(key, "documents")
    ids = [i for (i,) in oracle.execute(f"SELECT {key} FROM {source} ORDER BY 1").fetchall()]
    assert sorted({r[key] for r in rows}) == ids
    if name in queries.ORACLE:
        result = oracle.execute(queries.ORACLE[name])
        names = [column[0] for column in result.description]
        assert sorted(names) == sorted(got.columns)
        wanted = sorted((dict(zip(names, r)) for r in result.fetchall()), key=order)
        assert rows == wanted


def test_pipeline_equals_its_stages_one_by_one(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "source_mix", "packing",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = languageid.with_language(docs)
    once = exactdedup.one_per_text(found)
    apart = simhash.one_per_cluster(once)
    assert found.columns == once.columns == apart.columns == docs.columns
    assert docs.count() >= found.count() > once.count() >= apart.count() > 0
    ids = {r.doc_id for r in apart.collect()}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} <= ids and len({r.doc_id for r in rows}) > 0.3 * len(ids)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_pipeline_writes_sequences_that_decode_to_kept_texts(spark, tmp_path, monkeypatch):
    """Odd rows: null, empty, repeated, without language, with columns of any name."""
    text = "the quick brown fox jumps over the lazy dog number"
    rows = [(i, f"{text} {i} {'word ' * (i % 9)}and again {i * 7919}", None, "ab"[i % 2]) for i in range(30)]
    rows += [(40, None, None, "a"), (41, "", None, None), (42, "12 34", None, "a"), (7, rows[7][1], None, "b")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    path = public_tokenizers.path(corpus_pipeline.TOKENIZER)
    with_ids = ("packing", lambda spark, docs, sf_dir: packing.packed(docs, path, ids=True))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:-1], with_ids])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    plain = lambda t: "".join(t.split())
    texts = {i: plain(t) for i, t, *_ in rows if t}
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).extend(ids.tolist())
        assert plain(tokenizer.decode(ids[:-1].tolist()).replace("</w>", "")) == texts[r.doc_id] and ids[-1] == 1
    assert all(len(s) <= 4096 for s in sequences.values())
    assert {r.doc_id for r in got} <= set(range(30)) and len({r.doc_id for r in got}) > 10


def test_pipeline_without_rows(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
