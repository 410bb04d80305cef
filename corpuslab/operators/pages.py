"""Links and articles of crawled pages ``(page_id, url, html)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import evaluated_once
from ..functions.html import body_text, links, publish_date, title
from ..functions.text import contains_any_ci, snippet
from ..functions.urls import absolute_url
from .search import date_window_or_null

# Fixed value: texts shorter than this are not articles.
MIN_ARTICLE_LENGTH = 200


def page_links(pages: DataFrame, pattern: str | None = None) -> DataFrame:
    """Distinct resolved links of every page: ``(page_id, link)``.

    ``pattern`` is a regular expression the raw link must match.
    """
    found = links(F.col("html"))
    if pattern is not None:
        found = F.filter(found, lambda h: h.rlike(pattern))
    resolved = F.array_distinct(F.transform(found, lambda h: absolute_url(h, F.col("url"))))
    return pages.select("page_id", F.explode_outer(resolved).alias("link")).where(
        F.col("link").isNotNull()
    )


def section_links(pages: DataFrame, pattern: str | None = None) -> DataFrame:
    """Distinct links over all pages of a section."""
    return page_links(pages, pattern).select("link").distinct()


def extract_articles(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title, text, publish_date)`` of every page."""
    html = F.col("html")
    return pages.select(
        "page_id",
        "url",
        evaluated_once(title=title(html), text=body_text(html), publish_date=publish_date(html)),
    )


def fetch_and_filter(
    pages: DataFrame,
    keywords: Sequence[str],
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    min_length: int = MIN_ARTICLE_LENGTH,
) -> DataFrame:
    """Articles that are long enough, in the window and about a keyword, as snippets."""
    return (
        extract_articles(pages)
        .where(F.length("text") >= min_length)
        .where(date_window_or_null(F.col("publish_date"), start, end))
        .where(contains_any_ci([F.col("title"), F.col("text")], keywords))
        .select("title", "url", "publish_date", snippet(F.col("text")).alias("snippet"))
    )
