"""TF-IDF features in relational form: one row per document and term.

Term counts are made inside the document row, so counting needs no shuffle.
Document frequencies are one map-side-combined aggregate. Weights join terms to
the vocabulary, which Spark broadcasts when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import same_keys
from ..functions.text import DEFAULT_TOKEN_PATTERN, ngrams, term_counts, tokens
from ..session import materialise


@dataclass(frozen=True)
class TfidfParams:
    """Feature parameters; names and defaults follow the documented configuration."""

    ngram_range: Sequence[int] = (1, 1)
    min_df: int | float = 1
    max_df: int | float = 1.0
    max_features: int | None = None
    stop_words: str | Sequence[str] | None = None
    lowercase: bool = True
    token_pattern: str = DEFAULT_TOKEN_PATTERN
    binary: bool = False
    norm: str | None = "l2"
    use_idf: bool = True
    smooth_idf: bool = True
    sublinear_tf: bool = False

    def __post_init__(self) -> None:
        if self.norm not in ("l1", "l2", None):
            raise ValueError(f"norm must be 'l1', 'l2' or None, got {self.norm!r}")
        if isinstance(self.stop_words, str) and self.stop_words != "english":
            raise ValueError("stop_words must be 'english', a list of words or None")
        low, high = self.ngram_range
        if not 1 <= low <= high:
            raise ValueError(f"bad ngram_range {self.ngram_range!r}")

    @classmethod
    def from_mapping(cls, params: Mapping) -> TfidfParams:
        params = {k: v for k, v in params.items() if k != "dtype"}  # weights are always doubles
        unknown = set(params) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown feature parameters: {sorted(unknown)}")
        return cls(**params)

    def as_dict(self) -> dict:
        values = asdict(self)
        values["ngram_range"] = list(self.ngram_range)
        return values

    def token_rule(self) -> tuple:
        """What decides the tokens of a text."""
        stops = self.stop_words
        return self.lowercase, self.token_pattern, tuple(stops) if isinstance(stops, list) else stops

    def stop_word_list(self) -> list[str] | None:
        if self.stop_words == "english":
            from pyspark.ml.feature import StopWordsRemover

            return StopWordsRemover.loadDefaultStopWords("english")
        return list(self.stop_words) if self.stop_words else None


def document_tokens(text: Column, params: TfidfParams) -> Column:
    return tokens(text, params.lowercase, params.token_pattern, params.stop_word_list())


def document_terms(text: Column, params: TfidfParams) -> Column:
    """Array of the n-grams of one text."""
    return ngrams(document_tokens(text, params), *params.ngram_range)


def term_frequencies(
    documents: DataFrame, params: TfidfParams = TfidfParams(), keep: Sequence[str] = ("record_id",)
) -> DataFrame:
    """Rows ``(*keep, term, tf)``; documents without terms give one row with a null term.

    The outer form of the generator keeps Spark from deriving a size filter
    that would evaluate the tokeniser a second and third time.
    """
    counted = term_counts(document_terms(F.col("text"), params))
    return documents.select(*keep, F.inline_outer(counted))


def tf_value(params: TfidfParams) -> Column:
    if params.binary:
        return F.lit(1.0)
    if params.sublinear_tf:
        return 1.0 + F.log("tf")
    return F.col("tf").cast("double")


def idf_value(df: Column, n_docs: Column, params: TfidfParams) -> Column:
    if not params.use_idf:
        return F.lit(1.0)
    if params.smooth_idf:
        return F.log((1.0 + n_docs) / (1.0 + df)) + 1.0
    return F.log(n_docs / df) + 1.0


def _df_bound(bound: int | float, n_docs: Column) -> Column:
    """Counts for whole numbers, shares of the documents for fractions."""
    if isinstance(bound, float):
        return F.lit(bound) * n_docs
    return F.lit(bound)


def vocabulary(
    train_terms: DataFrame, n_docs: Column, params: TfidfParams = TfidfParams()
) -> DataFrame:
    """Terms of the training documents that survive pruning: ``(term, df, total_tf, idf)``."""
    counted = (
        train_terms.where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))
        .withColumn("_n", n_docs)
    )
    kept = counted.where(
        (F.col("df") >= _df_bound(params.min_df, F.col("_n")))
        & (F.col("df") <= _df_bound(params.max_df, F.col("_n")))
    )
    if params.max_features is not None:
        kept = kept.orderBy(F.desc("total_tf"), "term").limit(params.max_features)
    return kept.select(
        "term", "df", "total_tf", idf_value(F.col("df"), F.col("_n"), params).alias("idf")
    )


def document_count(documents: DataFrame) -> Column:
    return documents.agg(F.count("*")).scalar()


#: Terms of a vocabulary that are broadcast at most, the most frequent ones. They hold some 0.93 of the words of a text.
HEAD_TERMS = 200_000


def count_table(documents: DataFrame, params: TfidfParams = TfidfParams(), keep: Sequence[str] = ("record_id",)) -> DataFrame:
    """Written ``(*keep, counts)``: the terms of every document with their counts, one row a document. Runs a job.

    Texts are tokenised once for it, and what needs terms later reads them here.
    """
    return materialise(documents.select(*keep, term_counts(document_terms(F.col("text"), params)).alias("counts")), "counts")


def head_bound(side: DataFrame, order: str, head_rows: int) -> int:
    """Smallest ``order`` of a head: as many of the greatest whole numbers as ``head_rows`` rows have. Runs a small job.

    The rows are counted by number, so that nothing but this histogram is sorted. Terms of one number are all in or all out.
    """
    counted = side.groupBy(F.col(order).alias("order")).agg(F.count("*").alias("n"))
    running = counted.withColumn("above", F.sum("n").over(W.partitionBy(F.lit(1)).orderBy(F.desc("order"))))
    found = running.where(F.col("above") <= head_rows).agg(F.min("order")).first()[0]
    # Where even the greatest number has more rows than that, no single term is frequent.
    return 2**63 - 1 if found is None else found


def join_terms(rows: DataFrame, side: DataFrame, order: str = "df", head_rows: int = HEAD_TERMS, key: str = "term") -> DataFrame:
    """Inner join of token rows with a written table that has one row a term. Runs a small job.

    A word of nearly every document would fill one task of a shuffled join, and most words of a text are among the frequent ones. So the
    ``head_rows`` terms with the greatest ``order``, fewer where equals would exceed them, are joined by broadcast, their number being bounded, and never
    shuffled; only the rare terms that are left meet in a join that Spark may shuffle. Both parts run always.
    """
    bound = head_bound(side, order, head_rows)
    head = side.where(F.col(order) >= bound)
    frequent = F.broadcast(head.select(key))
    common = rows.join(F.broadcast(head), key)
    rare = rows.join(frequent, key, "left_anti").join(side.join(frequent, key, "left_anti"), key)
    return common.unionByName(rare)


def _weighted(counts: DataFrame, vocab: DataFrame, params: TfidfParams, keep: Sequence[str], name: str = "term") -> DataFrame:
    """tf times idf of the terms that are in the vocabulary."""
    terms = counts.select(*keep, F.inline("counts"))
    return join_terms(terms, vocab.select(*{"term": 0, name: 0}, "df", "idf")).withColumn("weight", tf_value(params) * F.col("idf"))


#: Stands between the terms of a moved document. One whose terms hold it is moved with an array of terms.
SEPARATOR = "\u0001"


def join_sizes(counts: DataFrame, sizes: DataFrame, key: str = "record_id") -> DataFrame:
    """Count table with the columns of ``sizes``, one row a document, null keys being equal.

    Documents are moved for it with their terms as one string, a third of the bytes of an array of structs.
    """
    kind = counts.schema["counts"].dataType
    names = kind.elementType.fieldNames()
    joined = F.array_join("counts.term", SEPARATOR)
    whole = F.size(F.split(joined, SEPARATOR)) == F.size("counts")
    moved = {f"_{f}": F.col(f"counts.{f}") for f in names if f != "term"}
    moved["_tf"] = moved["_tf"].cast("array<int>")
    slim = counts.withColumns({**moved, "_joined": F.when(whole, joined), "_term": F.when(~whole, F.col("counts.term"))}).drop("counts")
    met = slim.join(sizes, same_keys(slim, sizes, [key])).drop(sizes[key])
    met = met.withColumn("_term", F.coalesce("_term", F.split("_joined", SEPARATOR)))
    return met.withColumn("counts", F.arrays_zip(*[f"_{f}" for f in names]).cast(kind)).drop("_joined", *[f"_{f}" for f in names])


def norms(counts: DataFrame, vocab: DataFrame, params: TfidfParams, key: str = "record_id") -> DataFrame:
    """``(key, norm)`` of the documents with a known term; the terms of a document fold to one row before they are moved."""
    w = F.col("weight")
    size = F.sum(F.abs(w)) if params.norm == "l1" else F.sqrt(F.sum(w * w))
    return _weighted(counts, vocab, params, [key]).groupBy(key).agg(size.alias("norm"))


def weights_of(
    counts: DataFrame, vocab: DataFrame, params: TfidfParams = TfidfParams(), keep: Sequence[str] = ("record_id",), name: str = "term"
) -> DataFrame:
    """Normalised weights ``(*keep, term, idf, weight)`` from a count table; ``name`` puts another column of the vocabulary in the term's place.

    Norms come first and are joined while a document is one row, so no row of a frequent term is ever moved.
    """
    if params.norm is None:
        return _weighted(counts, vocab, params, keep, name).select(*keep, name, "idf", "weight")
    sizes = norms(counts, vocab, params, keep[0])
    sized = join_sizes(counts, sizes, keep[0])
    return _weighted(sized, vocab, params, [*keep, "norm"], name).select(*keep, name, "idf", (F.col("weight") / F.col("norm")).alias("weight"))


def tfidf(
    documents: DataFrame,
    vocab: DataFrame,
    params: TfidfParams = TfidfParams(),
    keep: Sequence[str] = ("record_id",),
    counts: DataFrame | None = None,
) -> DataFrame:
    """Normalised weights ``(*keep, term, idf, weight)`` of any documents. Runs a job that counts their terms, unless ``counts`` is their count table."""
    return weights_of(count_table(documents, params, keep) if counts is None else counts, vocab, params, keep)


def truncate(sequence: Column, max_length: int) -> Column:
    """First ``max_length`` items of a token array."""
    return F.slice(sequence, 1, max_length)
