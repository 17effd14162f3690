"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next one's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import jaccard_join, line_dedup
from tabforge.llm.common import table
from tabforge.llm.queries import languages, packed, quality
from tabforge.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document goes if no language explains so much of it.
LEAST_LANGUAGE_SHARE = 0.4

# From ten words on lines may be one edit apart, from these numbers on one more.
MORE_EDITS = (20, 30)


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is among ``ids``; their columns stay as they are."""
    ids = ids.select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(ids, F.col("doc_id") == F.col("__kept"), "left_semi")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go; so do rows without an id."""
    found = languages(docs)
    return _kept(docs, found.filter(
        (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SHARE)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict to be good go."""
    return _kept(docs, quality(docs, table(spark, sf_dir, "labels")).filter("predicted = 1"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats, but for few words, go, and documents that have no other line.

    Every line that is not blank is compared, also of one word or of a script without spaces.
    """
    out = line_dedup.without_duplicate_lines(docs, least_words=1, more_edits=MORE_EDITS)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Shingles of five words and a similarity of at least 0.8.
    """
    found = jaccard_join.similar_components(docs, width=5, num=80, den=100)
    return _kept(docs, found.filter("doc_id = component_id"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 1024 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("best_fit_packing", packing_stage),
]

# Language, quality and tokens come from fitted models and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
