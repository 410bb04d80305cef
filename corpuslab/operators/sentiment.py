"""Lexicon sentiment: compound score and class, mean polarity and subjectivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import same_keys, sentiment_class
from .features import TfidfParams, term_frequencies

# Fixed value: normalisation constant of the compound score (Hutto & Gilbert 2014).
COMPOUND_NORM = 15.0


def lexicon_sentiment(
    documents: DataFrame, lexicon: DataFrame, keep: Sequence[str] = ("record_id",)
) -> DataFrame:
    """Sentiment of every document, also those without any lexicon term.

    Terms are counted inside the document row and met with the lexicon, an input
    table ``(term, valence, polarity, subjectivity)`` with one row per term. Only terms that it has go on: they are folded to one row per
    document, and the documents without any join at the end.
    """
    counted = term_frequencies(documents, TfidfParams(), keep)
    tf = F.col("tf")
    hits = counted.join(lexicon, "term").groupBy(*keep).agg(
        F.sum(tf).alias("n_hits"), *[F.sum(tf * F.col(c)).alias(n) for c, n in (("valence", "valence"), ("polarity", "polarity_sum"), ("subjectivity", "subjectivity_sum"))]
    )
    zero = {"n_hits": F.lit(0).cast("bigint"), "valence": F.lit(0.0), "polarity_sum": F.lit(0.0), "subjectivity_sum": F.lit(0.0)}
    every = documents.select(*keep)
    sums = every.join(hits, same_keys(every, hits, keep), "left").select(*[every[c] for c in keep], *[F.coalesce(F.col(n), z).alias(n) for n, z in zero.items()])
    total = F.col("valence")
    compound = total / F.sqrt(total * total + COMPOUND_NORM)
    hits = F.col("n_hits")
    return sums.select(
        *keep,
        "n_hits",
        compound.alias("compound"),
        sentiment_class(compound).alias("sentiment"),
        F.when(hits > 0, F.col("polarity_sum") / hits).otherwise(0.0).alias("polarity"),
        F.when(hits > 0, F.col("subjectivity_sum") / hits).otherwise(0.0).alias("subjectivity"),
    )
