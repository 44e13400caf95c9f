"""A corpus from raw documents to training sequences, one written stage at a time."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exactdedup, languageid, mixing, packing, simhash
from gridloom.llm.common import new_folder

TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; texts without letters go."""
    return languageid.with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the longest."""
    return exactdedup.one_per_text(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_per_cluster(docs, words=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences; ``packing.sequences`` joins the ids."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", mix),
    ("packing", pack),
]

#: Language models, fingerprints, dependent rounding and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next.

    Rows are the pieces of the mixed corpus; the pieces of a ``sequence_id``, in the
    order of ``offset``, are a training sequence. Null texts and those without a letter go in the first stage. Where
    no document has a ``lang``, texts with letters stay. Repeated rows are one
    document. Further columns, of any name, travel along. An empty table gives an empty table.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
