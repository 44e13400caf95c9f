"""The registered queries: thin digests of the operators, over whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import embeddings, exactdedup, infilling, languageid, lexical, lmscore, mixing, packing, pii
from gridloom.llm import quality, simhash, tokenfiles, toxicity
from gridloom.llm.common import new_folder

#: A file of the public tokenizers package.
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _query(name: str):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        return build

    return register


@_query("op1_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), words=4, max_bits=4)


@_query("op5_exact_dedup")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_documents(spark, sf_dir))


ORACLE["op5_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT h, count(*) AS group_size,
         min({'a': -n, 'b': doc_id}).b AS keep_id
  FROM t GROUP BY h)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.h AS text_sha256
FROM t JOIN g USING (h)
"""


@_query("op9_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_documents(spark, sf_dir))


@_query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


@_query("op6_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    return tokenfiles.encoded(_documents(spark, sf_dir), folder, public_tokenizers.path(TOKENIZER))


@_query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languageid.identified(_documents(spark, sf_dir))


@_query("op2_quality_resampling")
def quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    share = labels.agg(F.avg("quality")).first()[0] or 0.0
    good = labels.where("quality = 1")
    return quality.resampled(_documents(spark, sf_dir), good, share)


@_query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(_documents(spark, sf_dir), labels)


@_query("op4_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE["op4_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT a AS vec_id,
       (SELECT count(*) FROM l WHERE l.a = r.a) AS n_links,
       min(b) AS component_id, min(b) = a AS kept
FROM r GROUP BY a
"""


@_query("op3_pii_sanitisation")
def pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return pii.found(_documents(spark, sf_dir)).select("doc_id", *counts, "base_sha256", "spans")


@_query("op11_fill_in_middle")
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.digests(_documents(spark, sf_dir))


ORACLE["op11_fill_in_middle"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
d AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t),
c AS (
  SELECT doc_id, text, n, units, h4,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR h3 % 100 >= 90 AS plain
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c),
o AS (
  SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n, form,
       CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars,
       CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
"""


@_query("op12_lexical_search")
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE["op12_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM d WHERE len(terms) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
e AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM e
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term),
x AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN p USING (term), s
  GROUP BY item_id, r, doc_id),
k AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank
  FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@_query("op13_lm_score")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scored(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
