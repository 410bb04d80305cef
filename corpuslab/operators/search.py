"""Story and URL search over an article table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import evaluated_once
from ..functions.text import matches_term

# Fixed value: first day searched when no start date is given.
DEFAULT_START = dt.date(2020, 1, 1)


def parse_day(day: str | dt.date | None, default: dt.date) -> dt.date:
    """Strict ``YYYY-MM-DD``; None gives the default."""
    if day is None:
        return default
    if isinstance(day, dt.date):
        return day
    return dt.datetime.strptime(day, "%Y-%m-%d").date()


def validate_dates(start: dt.date, end: dt.date, today: dt.date | None = None) -> None:
    """Reject reversed ranges and days in the future."""
    today = today or dt.date.today()
    if end < start:
        raise ValueError("the end date lies before the start date")
    if start > today or end > today:
        raise ValueError("dates must not lie in the future")


def date_between(
    column: Column, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> Column:
    """Inclusive date window with the default bounds filled in; null dates fail.

    A reversed window, or a bound in the future, is an error rather than an empty result.
    """
    first = parse_day(start, DEFAULT_START)
    last = parse_day(end, dt.date.today())
    validate_dates(first, last)
    return column.between(F.lit(first), F.lit(last))


def date_window_or_null(
    column: Column, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> Column:
    """Inclusive date window that lets null dates pass; absent bounds are open."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (column >= F.lit(parse_day(start, DEFAULT_START)))
    if end is not None:
        inside = inside & (column <= F.lit(parse_day(end, dt.date.today())))
    return column.isNull() | inside


def story_search(
    articles: DataFrame,
    all_of: Sequence[str] = (),
    any_of: Sequence[str] = (),
    none_of: Sequence[str] = (),
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    collections: Sequence[str] | None = None,
    collection_column: str = "media_id",
) -> DataFrame:
    """Articles whose title or text matches the terms, within dates and collections.

    ``(a OR b) AND c`` is ``any_of=["a", "b"], all_of=["c"]``. A term with
    spaces is a phrase and a trailing ``*`` matches word prefixes. The date and
    collection predicates are plain comparisons and reach the Parquet scan.
    """
    hits = articles.where(date_between(F.col("publish_date"), start, end))
    if collections is not None:
        hits = hits.where(F.col(collection_column).isin(list(collections)))
    if not (all_of or any_of or none_of):
        return hits
    # Lower-cased once per row, not once per term.
    text = F.lower(F.concat_ws("\n", F.col("title"), F.col("text")))
    hits = hits.select("*", evaluated_once(_haystack=text))
    haystack = F.col("_haystack")
    condition = F.lit(True)
    for term in all_of:
        condition = condition & matches_term(haystack, term)
    if any_of:
        either = F.lit(False)
        for term in any_of:
            either = either | matches_term(haystack, term)
        condition = condition & either
    for term in none_of:
        condition = condition & ~matches_term(haystack, term)
    return hits.where(condition).drop("_haystack")


def story_count(hits: DataFrame, by: str = "media_id") -> DataFrame:
    """Number of matching stories per source or collection."""
    return hits.groupBy(by).agg(F.count("*").alias("n_stories"))


def list_sources(hits: DataFrame, column: str = "media_id") -> DataFrame:
    """Distinct sources that have at least one matching story."""
    return hits.select(column).distinct()


def url_search(
    articles: DataFrame,
    url: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """Exact URL, or URL prefix when ``url`` ends with ``*``."""
    within = articles.where(date_between(F.col("publish_date"), start, end))
    if url.endswith("*"):
        return within.where(F.col("url").startswith(url[:-1]))
    return within.where(F.col("url") == url)


def keyword_filter(
    articles: DataFrame, keywords: Sequence[str], columns: Sequence[str] = ("title", "text")
) -> DataFrame:
    """Articles that contain any keyword as a case-insensitive substring."""
    lowered = {f"_{c}": F.lower(F.coalesce(c, F.lit(""))) for c in columns}
    hit = F.lit(False)
    for name in lowered:
        for keyword in keywords:
            hit = hit | F.col(name).contains(keyword.lower())
    return articles.select("*", evaluated_once(**lowered)).where(hit).drop(*lowered)
