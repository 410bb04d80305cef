"""Inverted index, keyword automaton, URL layout and observed counts against plain scans."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import ingest, keywords, search, textindex
from corpuslab.plans import queries as q
from corpuslab.schemas import ARTICLE
from corpuslab.sources.urls import UrlTable, _upper
from helpers import rows
from test_plans import plan
from test_store import stories

WORDS = ["of", "the", "sea", "Étude", "d_1", "x2", "seaside", "theory"]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    rng = random.Random(4)
    gaps = [" ", "  \n", ", ", "-", "\t", "\xa0", ". "]

    def text():
        return "".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(rng.randint(0, 40)))

    table = stories(spark, [(str(k), text() if k % 9 else "") for k in range(200)]).withColumn("media_id", F.concat(F.lit("m"), F.col("story_id").cast("int") % 3))
    table = table.withColumn("title", F.when(F.col("story_id").cast("int") % 5 > 0, F.concat(F.lit("The sea "), "story_id")))
    table = table.withColumn("url", F.concat(F.lit("https://h"), F.col("story_id").cast("int") % 7, F.lit("/"), F.col("story_id")))
    folder = str(tmp_path_factory.mktemp("archive"))
    table.write.parquet(f"{folder}/articles")
    return spark.read.schema(ARTICLE).parquet(f"{folder}/articles"), folder


QUESTIONS = [
    {"any_of": ["the"]}, {"all_of": ["of the"]}, {"all_of": ["sea", "x2"], "none_of": ["d_1"]}, {"any_of": ["of the sea", "theo*"]}, {"all_of": ["the sea*"]},
    {"any_of": ["étude of"], "none_of": ["sea the"]}, {"none_of": ["the", "of"]}, {"all_of": ["the the"]}, {"any_of": ["s*"]}, {"any_of": ["absent"]}, {},
    {"all_of": ["sea"], "collections": ["m1"]}, {"all_of": ["x2"], "end": "2024-06-01"}, {"all_of": ["the", "the"], "any_of": ["the"]},
]


def test_index_answers_equal_the_scan(spark, archive, out):
    articles, _ = archive
    index = textindex.TextIndex.build(articles, out, parts=4)
    for question in QUESTIONS:
        want = rows(search.story_search(articles, **question), "story_id")
        assert rows(index.search(**question), "story_id") == want, question
    with pytest.raises(ValueError):
        index.search(all_of=["e-mail"])


def test_index_reads_no_texts_and_few_parts(spark, archive, out):
    index = textindex.TextIndex.build(archive[0], out, parts=4)
    text = plan(index.search(all_of=["the sea"]))
    assert "text:" not in text and "title" not in text
    assert any("part#" in found for found in re.findall(r"PartitionFilters: \[(.*?)\]", text))
    assert "EqualTo(term,the)" in text and "EqualTo(term,sea)" in text
    assert "StringStartsWith(term,theo)" in plan(index.matches(["theo*"]))


def test_index_of_an_empty_archive(spark, archive, out):
    index = textindex.TextIndex.build(archive[0].limit(0), out)
    assert index.search(all_of=["the"]).count() == 0


# ---------------------------------------------------------------- keywords


def test_keywords_equal_the_filter(spark, archive):
    articles, _ = archive
    listed = ["SEA", "sea", "étude", "of the", "zzz", "d_1, x2", "a" * 50]
    found = {r["story_id"]: r["keywords"] for r in keywords.keyword_hits(articles, listed).collect()}
    assert sorted((i,) for i in found) == rows(search.keyword_filter(articles, listed), "story_id")
    for r in articles.collect():
        plain = sorted({k.lower() for k in listed if k.lower() in (r["title"] or "").lower() or k.lower() in (r["text"] or "").lower()})
        assert found.get(r["story_id"], []) == plain
    assert keywords.keyword_hits(articles, []).count() == 0
    assert keywords.keyword_hits(articles, [""]).count() == articles.count()
    clashing = articles.withColumn("keywords", F.lit(1))
    assert keywords.keyword_hits(clashing, ["sea"]).schema["keywords"].dataType.simpleString() == "array<string>"


def test_time_does_not_grow_with_the_number_of_keywords(spark, sf):
    articles = q.articles(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("copy")
    rng = random.Random(6)
    listed = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(10_000)]

    def took(words):
        begin = time.perf_counter()
        keywords.keyword_hits(articles, words).count()
        return time.perf_counter() - begin

    took(listed[:10])
    assert min(took(listed) for _ in range(2)) < 5 * min(took(listed[:10]) for _ in range(2)) + 1


# ---------------------------------------------------------------- URLs


def test_url_search_opens_matching_files_only(spark, archive, out):
    articles, _ = archive
    table = UrlTable.write(articles, out, files=10)
    whole = len(spark.read.parquet(f"{out}/articles").inputFiles())
    assert whole >= 8
    for url in ("https://h3/*", "https://h3/10", "https://h3/1*", "https://none/*", "*", "https://h0/0"):
        assert rows(table.search(url), "story_id") == rows(search.url_search(articles, url), "story_id"), url
    assert 1 <= len(table.rows("https://h3/*").inputFiles()) <= 4 and len(table.rows("https://h3/10").inputFiles()) <= 2
    assert not table.rows("https://none/*").inputFiles()
    text = plan(table.search("https://h3/*"))
    assert "StringStartsWith(url" in text


def test_upper_bound_of_a_prefix():
    assert _upper("ab") == "ac" and _upper("a\U0010ffff") == "b" and _upper("\U0010ffff") is None and _upper("") is None


# ---------------------------------------------------------------- observed counts


def test_observed_counts_equal_save_counts_in_one_scan(spark, archive, out):
    articles, folder = archive
    index = spark.createDataFrame([(str(k),) for k in range(0, 200, 3)], "story_id string")
    counts = ingest.save_observed(articles, index, out)
    want = ingest.save_counts(articles, index).first()
    assert (counts["n_new_saved"], counts["n_failed"]) == tuple(want)
    assert counts["n_articles"] == 200 and counts["n_blank"] == articles.where("text = ''").count()
    assert spark.read.parquet(out).count() == ingest.storable(articles).count()
