"""Source catalogue matching and full-text fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import null_if_blank
from ..session import materialise
from ..functions.text import strip
from ..functions.urls import clean_domain


def says_yes(column: Column) -> Column:
    """Starts with "yes" after trimming, in any case; null is no."""
    return F.coalesce(F.lower(strip(column)).rlike("^yes"), F.lit(False))


def directory_ids(directory: DataFrame) -> DataFrame:
    """First directory id of every domain, as listed."""
    return directory.groupBy("domain").agg(F.min_by("id", "seq").alias("id"))


def match_sources(catalogue: DataFrame, directory: DataFrame) -> DataFrame:
    """Listed sources that are present, with domain and numeric source id or null."""
    present = catalogue.where(says_yes(F.col("present"))).withColumn(
        "clean_domain", clean_domain(F.col("homepage_url"))
    )
    ids = directory_ids(directory).select(F.col("domain").alias("_domain"), "id")
    return present.join(ids, null_if_blank(F.col("clean_domain")) == F.col("_domain"), "left").select(
        *present.columns, F.col("id").try_cast("bigint").alias("source_id")
    )


def unmatched_sources(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("source_id").isNull())


def match_counts(matched: DataFrame) -> DataFrame:
    """One row: sources, sources without an id, sources without a domain."""
    return matched.agg(
        F.count("*").alias("n_sources"),
        F.count_if(F.col("source_id").isNull()).alias("n_without_id"),
        F.count_if(F.col("clean_domain").isNull()).alias("n_without_domain"),
    )


def full_text(urls: DataFrame, archive: DataFrame, scraped: DataFrame) -> DataFrame:
    """Archive text of every URL, else the scraped title and text, else empty.

    Both sides are cut to the requested URLs and folded to one row per URL
    first: the first archive story by ``seq`` and the lowest page id. Pages are
    looked at only for URLs the archive does not have. Rows whose URL is null or blank are left out.
    """
    urls = urls.where(F.length(strip(F.col("url"))) > 0)
    wanted = urls.select("url").distinct()
    stories = (
        archive.join(wanted, "url", "left_semi")
        .groupBy("url")
        .agg(F.min_by(F.coalesce("text", F.lit("")), F.col("seq")).alias("archive_text"))
    )
    stories = materialise(stories, "archive-texts")
    missing = wanted.join(stories, "url", "left_anti")
    pages = (
        scraped.join(missing, "url", "left_semi")
        .groupBy("url")
        .agg(F.min_by(F.concat_ws("\n\n", "title", "text"), F.col("page_id")).alias("page_text"))
    )
    return (
        urls.join(stories, "url", "left")
        .join(pages, "url", "left")
        .select(
            *urls.columns,
            F.coalesce("archive_text", "page_text", F.lit("")).alias("full_text"),
            F.when(F.col("archive_text").isNotNull(), F.lit("archive"))
            .when(F.col("page_text").isNotNull(), F.lit("page"))
            .otherwise(F.lit("none"))
            .alias("origin"),
        )
    )
