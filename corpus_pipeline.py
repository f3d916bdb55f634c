"""A training corpus out of the documents, stage by stage.

Each stage takes what the one before it kept, written as Parquet and read again,
so a lost executor costs part of a stage. All but the last return the columns of
the documents.
"""

from pyspark.sql import DataFrame, SparkSession

from searchtide.llm import jaccard, language, mixing, packing, queries, secret_scan
from searchtide.llm.common import read, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a single letter go."""
    return language.known_language(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one of least doc_id."""
    return jaccard.first_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask where a secret was; n_chars follows the text."""
    return secret_scan.without_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents once, those of small sources up to twice, by temperature."""
    return mixing.mixed_sources(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document that the mix repeats is packed each time."""
    return packing.pack(docs, queries.word_tokenizer())


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", one_of_each),
    ("secret_scan", without_secrets),
    ("source_mix", mixed),
    ("packing", packed),
]

#: No SQL: models and packing are not expressible; tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
