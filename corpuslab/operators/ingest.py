"""Incremental retrieval: known-article handling, limits, index upkeep and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.columns import same_keys
from ..functions.text import is_blank
from ..session import materialise
from ..schemas import STATUS_NO_TEXT, STATUS_SUCCESS, STATUS_UNKNOWN
from .selection import value_at_ranks


def retrieved(status: Column, text_length: Column) -> Column:
    """An index entry counts as retrieved when it succeeded with some text."""
    return F.coalesce((status == STATUS_SUCCESS) & (text_length > 0), F.lit(False))


def derive_status(text: Column) -> Column:
    """success for any non-empty text (white space included), else failed_no_text."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) > 0, F.lit(STATUS_SUCCESS)).otherwise(
        F.lit(STATUS_NO_TEXT)
    )


def has_value(column: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(column, F.lit("")) != ""


def valid_index_keys(index: DataFrame) -> DataFrame:
    """Story ids that need no further retrieval."""
    return index.where(retrieved(F.col("status"), F.col("text_length"))).select("story_id").distinct()


def skip_retrieved(candidates: DataFrame, index: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Candidates that still have to be fetched; ``known`` are the valid keys of the index where a key table has them."""
    return candidates.join(valid_index_keys(index) if known is None else known, "story_id", "left_anti")


def reuse_stored(candidates: DataFrame, index: DataFrame, store: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Stored articles of candidates that were already retrieved."""
    keys = valid_index_keys(index) if known is None else known
    return candidates.select("story_id", "seq").join(keys, "story_id", "left_semi").join(store.drop("seq"), "story_id")


def ingest(
    candidates: DataFrame, index: DataFrame, store: DataFrame, limit: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """New articles plus stored ones, in candidate order given by ``seq``.

    ``limit`` counts new articles with a URL only. Stored articles that come
    before the cut are all kept; nothing is read after it. The result has the
    candidate columns plus ``origin`` (``new`` or ``existing``). ``known`` may name the index's valid keys, as a bucketed
    key table (``sources.keys``) gives them; then the index is not read.
    """
    if limit is not None and limit <= 0:
        return candidates.where(F.lit(False)).withColumn("status", derive_status(F.col("text"))).withColumn(
            "origin", F.lit("new")
        )
    if limit is None:
        fresh = skip_retrieved(candidates, index, known).where(has_value(F.col("url")))
        old = reuse_stored(candidates, index, store, known)
    else:
        keys = (valid_index_keys(index) if known is None else known).withColumn("_known", F.lit(True))
        narrow = candidates.select("story_id", "seq", has_value(F.col("url")).alias("_url")).join(keys, "story_id", "left")
        # The index is asked once; the cut is found in, and both parts are taken from, a table of keys.
        told = materialise(narrow.withColumn("_known", F.coalesce("_known", F.lit(False))).where("_known OR _url"), "told")
        counted = told.where("NOT _known AND seq IS NOT NULL").select("seq", F.lit(1).cast("bigint").alias("_m"))
        cut = F.coalesce(value_at_ranks(counted, "seq", [F.lit(limit)], weight="_m").select("seq").scalar(), F.lit(2**63 - 1))
        taken = told.where(F.col("seq") <= cut)
        first = taken.where("NOT _known").select("story_id", "seq")
        fresh = candidates.join(first, same_keys(candidates, first, ["story_id", "seq"]), "left_semi").where(has_value(F.col("url")))
        old = told.where(F.col("_known") & (F.col("seq") < cut)).select("story_id", "seq").join(store.drop("seq"), "story_id")
    new = fresh.withColumn("status", derive_status(F.col("text")))
    columns = candidates.columns if "status" in candidates.columns else [*candidates.columns, "status"]
    return (
        new.select(*columns).withColumn("origin", F.lit("new"))
        .unionByName(old.select(*columns).withColumn("origin", F.lit("existing")))
    )


def storable(articles: DataFrame) -> DataFrame:
    """Articles that may be saved: both URL and story id are present."""
    return articles.where(has_value(F.col("url")) & has_value(F.col("story_id")))


def index_entries(articles: DataFrame) -> DataFrame:
    """Index rows of saved articles."""
    return storable(articles).select(
        "story_id",
        F.coalesce(F.col("status"), F.lit(STATUS_UNKNOWN)).alias("status"),
        "retrieved_at",
        F.coalesce("title", F.lit("")).alias("title"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("text_length"),
        F.coalesce("query", F.lit("")).alias("query"),
        "url",
        "publish_date",
    )


def merge_index(index: DataFrame, entries: DataFrame) -> DataFrame:
    """Latest entry per story id; new entries win over old ones of the same time.

    An aggregate, not a ranking window: copies of one story are folded on the
    map side, so a story with very many copies does not fill one task.
    """
    columns = [c for c in index.columns if c != "story_id"]
    both = index.withColumn("_age", F.lit(0)).unionByName(entries.withColumn("_age", F.lit(1)))
    newest = both.groupBy("story_id").agg(
        F.max_by(
            F.struct(*columns), F.struct("retrieved_at", "_age", "status", "text_length", "url")
        ).alias("e")
    )
    return newest.select("story_id", *[F.col(f"e.{c}").alias(c) for c in columns])


def failed_urls(articles: DataFrame) -> DataFrame:
    """URLs of saved articles whose status is not success."""
    return storable(articles).where(
        F.coalesce(F.col("status"), F.lit(STATUS_UNKNOWN)) != STATUS_SUCCESS
    ).select("url")


def save_counts(articles: DataFrame, index: DataFrame) -> DataFrame:
    """One row: new successes and failures of a saving run."""
    seen = index.select("story_id").distinct().withColumn("_seen", F.lit(True))
    marked = storable(articles).join(seen, "story_id", "left")
    ok = F.coalesce(F.col("status") == STATUS_SUCCESS, F.lit(False))
    return marked.agg(
        F.count_if(ok & F.col("_seen").isNull()).alias("n_new_saved"),
        F.count_if(~ok).alias("n_failed"),
    )


def save_observed(articles: DataFrame, index: DataFrame, path: str) -> dict[str, int]:
    """Append the storable articles to ``path`` and return the counts of ``save_counts`` with those of all and of blank texts. Runs one job.

    The counts come out of the pass that writes (``DataFrame.observe``), so the articles are read once.
    """
    seen = index.select("story_id").distinct().withColumn("_seen", F.lit(True))
    watched, saved = Observation(), Observation()
    ok = F.coalesce(F.col("status") == STATUS_SUCCESS, F.lit(False))
    every = articles.observe(watched, F.count(F.lit(1)).alias("n_articles"), F.count_if(is_blank(F.col("text"))).alias("n_blank"))
    marked = storable(every).join(seen, "story_id", "left")
    counted = marked.observe(saved, F.count_if(ok & F.col("_seen").isNull()).alias("n_new_saved"), F.count_if(~ok).alias("n_failed"))
    counted.drop("_seen").write.mode("append").parquet(path)
    return {**watched.get, **saved.get}


def status_breakdown(articles: DataFrame) -> DataFrame:
    """Articles per status with the overall success rate in percent."""
    counts = articles.groupBy(
        F.coalesce(F.col("status"), F.lit(STATUS_UNKNOWN)).alias("status")
    ).agg(F.count("*").alias("n"))
    totals = counts.agg(
        (F.sum(F.when(F.col("status") == STATUS_SUCCESS, F.col("n")).otherwise(0)) * 100.0 / F.sum("n"))
    ).scalar()
    return counts.withColumn("success_rate", totals)


def text_length_stats(articles: DataFrame) -> DataFrame:
    """Mean, upper median, minimum and maximum length of the non-empty texts."""
    lengths = articles.select(F.length("text").alias("len")).where(F.col("len") > 0)
    # One scan of the texts: everything follows from the number of texts of each length.
    counts = materialise(lengths.groupBy("len").agg(F.count("*").alias("_m")), "lengths")
    middle = F.floor(F.col("n") / 2) + 1
    median = value_at_ranks(counts, "len", [middle], weight="_m").select("len")
    return counts.agg(
        (F.sum(F.col("len") * F.col("_m")) / F.sum("_m")).alias("mean_length"),
        F.min("len").alias("min_length"),
        F.max("len").alias("max_length"),
    ).withColumn("median_length", median.scalar())


def language_breakdown(articles: DataFrame) -> DataFrame:
    return articles.groupBy(
        F.coalesce(F.col("language"), F.lit("unknown")).alias("language")
    ).agg(F.count("*").alias("n"))

