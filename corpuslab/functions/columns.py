"""General Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    The optimizer inlines a projected column into every place that uses it, and
    inside a lambda that means once per element. Binding it to a lambda
    variable keeps it evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def null_if_blank(value: Column) -> Column:
    """Empty string becomes null; other values pass."""
    return F.nullif(value, F.lit(""))


def first_truthy(*values: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[null_if_blank(v) for v in values])


def flag(value: Column) -> Column:
    """Boolean column with null read as false."""
    return F.coalesce(value, F.lit(False))


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def agreement_band(value: Column) -> Column:
    """Verbal band of a chance-corrected agreement coefficient; null stays null."""
    # Lower bound of each band and its name.
    bands = (
        (0.8, "Excellent"),
        (0.6, "Good"),
        (0.4, "Moderate"),
        (0.2, "Fair"),
        (0.0, "Poor"),
    )
    band = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in bands:
        band = band.when(value >= bound, F.lit(name))
    return band.otherwise(F.lit("Worse than random"))


def sentiment_class(score: Column, threshold: float = 0.05) -> Column:
    """Positive / Negative / Neutral by a symmetric threshold on a compound score."""
    return (
        F.when(score >= threshold, F.lit("Positive"))
        .when(score <= -threshold, F.lit("Negative"))
        .otherwise(F.lit("Neutral"))
    )


def report_round(value: Column, digits: int) -> Column:
    """Half-even rounding used in reports."""
    return F.bround(value, digits)


def evaluated_once(**columns: Column) -> Column:
    """Generator that yields the given columns as one row.

    Predicates are not pushed through a generator, so expensive expressions
    that are both filtered on and returned are computed once per row instead of
    once per use.
    """
    return F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition: equal keys, null being equal to null."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def iso_timestamp(value: Column) -> Column:
    """ISO form of a time stamp in the session's time zone: no fraction where it is zero, else six digits."""
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def compact_timestamp(value: Column) -> Column:
    """Form for names of files and runs: ``yyyymmdd_hhmmss``."""
    return F.date_format(value, "yyyyMMdd_HHmmss")
