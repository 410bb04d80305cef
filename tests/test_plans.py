"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import features, linediff, search
from corpuslab.plans.queries import REGISTRY
from corpuslab.schemas import ARTICLE
from corpuslab.session import materialise
from test_registry import SLOW

PYTHON_OK: set[str] = set()  # no query maps pandas frames


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SLOW))
def test_no_nested_loops_and_no_row_python(spark, sf, name):
    text = plan(REGISTRY[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("InPandas" in text) == (name in PYTHON_OK)


def test_search_predicates_reach_the_scan(spark, out):
    spark.createDataFrame(
        [("u", "t", "x", "s", None, "success", "1", dt.date(2024, 1, 1), "m", "en", "q")], ARTICLE
    ).write.parquet(out)
    hits = search.story_search(
        spark.read.schema(ARTICLE).parquet(out), start="2024-01-01", end="2024-02-01", collections=["m"]
    ).select("story_id")
    text = plan(hits)
    assert "GreaterThanOrEqual(publish_date" in text and "EqualTo(media_id" in text
    scan = text[text.index("ReadSchema") :]
    assert "retrieved_at" not in scan and "title" not in scan
    prefix = plan(search.url_search(spark.read.schema(ARTICLE).parquet(out), "https://a/*"))
    assert "StringStartsWith(url" in prefix


def test_counting_terms_and_lines_shuffles_nothing(spark):
    docs = spark.createDataFrame([(1, "a b", "c")], "record_id long, text string, old_text string")
    assert "Exchange" not in plan(features.term_frequencies(docs))
    assert "Exchange" not in plan(linediff.line_diff(docs, "record_id", "old_text", "text"))


def test_tokens_are_made_once_per_document(spark):
    docs = spark.createDataFrame([(1, "a b")], "record_id long, text string")
    text = plan(features.term_frequencies(docs).groupBy("term").agg(F.count("*")))
    assert text.count("regexp_extract_all") == 1


def test_frequent_terms_are_never_moved(spark):
    """One word in every document, broadcasts by size off: only rare terms are shuffled, and no task has a hot word."""
    rows = [(k, f"the the w{k % 700} x{k}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "record_id long, text string")
    counts = features.count_table(docs)
    vocab = materialise(features.vocabulary(counts.select(F.inline("counts")), features.document_count(counts)), "vocab")
    terms = counts.select("record_id", F.inline("counts"))
    want = sorted(tuple(r) for r in terms.join(vocab, "term").select("record_id", "term", "tf", "df").collect())
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = features.join_terms(terms, vocab, head_rows=5)
        assert sorted(tuple(r) for r in joined.select("record_id", "term", "tf", "df").collect()) == want
        text = plan(joined)
        assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 3
        rare = terms.join(F.broadcast(vocab.orderBy(F.desc("df"), "term").limit(5)), "term", "left_anti")
        sizes = [r["n"] for r in rare.repartition(4, "term").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
        weights = plan(features.weights_of(counts, vocab))
        assert "text:string" not in weights
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_texts_are_not_read_again_after_counting(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "record_id long, text string")
    counts = features.count_table(docs)
    vocab = materialise(features.vocabulary(counts.select(F.inline("counts")), features.document_count(counts)), "vocab")
    text = plan(features.weights_of(counts, vocab))
    assert "regexp_extract_all" not in text and "LocalTableScan" not in text
