"""Corpus pipeline: quality, lines, near-duplicates, benchmark leaks, tokens. Part of the training-data subpackage.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir), works on all rows that the one before kept and
returns the columns of ``documents``, the last its token counts and digests. ``run`` writes every stage's
result as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.llm import bpe, factorisation, latent, lines, simhash
from corpuslab.llm.common import materialise, read_table, ship
from corpuslab.llm.queries import tokenizer_path


#: Columns that the operators work with; others are set aside under neutral names, so that no name can clash.
OWN = ("doc_id", "text", "n_chars")


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that returns the columns it was given, whatever further columns they are."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        placed = docs.toDF(*[c if c in OWN else f"further_{k}" for k, c in enumerate(docs.columns)])
        return work(spark, placed, sf_dir).select(placed.columns).toDF(*docs.columns)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at least 0.5; null and empty texts are scored like any other."""
    labels = read_table(spark, sf_dir, "labels").where(factorisation.held_in())
    scored = factorisation.score(docs, factorisation.fit(docs, labels))
    return scored.where(F.col("_score") >= 0.5)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; ``n_chars`` follows the text. Null texts stay null."""
    kept = lines.drop_frequent_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("_kept_text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        length = F.char_length("_kept_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return kept.withColumns(changed)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents that share 0.8 of their five-word shingles, directly or in steps, the one with the smallest id."""
    return simhash.one_of_similar(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return latent.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the text decoded from them."""
    ship(spark)
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

#: The classifier, the fingerprints, the latent space and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
