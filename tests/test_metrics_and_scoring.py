from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import catalogue, leaderboard, linear, linediff, metrics, pages, scoring, sentiment
from helpers import close, one, rows

PRED = "model_name string, y_true string, y_pred string"


def test_weighted_metrics_with_a_class_seen_only_in_predictions(spark):
    data = [("m", "a", "a"), ("m", "a", "x"), ("m", "b", "b"), ("m", "b", "a"), ("m", "b", "b")]
    got = one(metrics.weighted_metrics(spark.createDataFrame(data, PRED)))
    pa, ra, pb, rb = 1 / 2, 1 / 2, 1.0, 2 / 3
    f = lambda p, r: 2 * p * r / (p + r)
    assert close(got["accuracy"], 3 / 5) and close(got["recall"], 3 / 5)
    assert close(got["precision"], (2 * pa + 3 * pb) / 5)
    assert close(got["f1"], (2 * f(pa, ra) + 3 * f(pb, rb)) / 5)


def test_metrics_agree_with_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    pairs = [(float(i % 3), float((i * 7 + i // 5) % 3)) for i in range(60)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    ours = one(
        metrics.weighted_metrics(
            df.select(F.lit("m").alias("model_name"), F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))
        )
    )
    for ours_name, name in (("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("accuracy", "accuracy")):
        assert close(ours[ours_name], MulticlassClassificationEvaluator(metricName=name).evaluate(df))


def board_of(spark, values):
    data = [(n, v, v, v, v) for n, v in values]
    return spark.createDataFrame(data, "model_name string, accuracy double, precision double, recall double, f1 double")


def test_leaderboard_order_and_best(spark):
    failed = spark.createDataFrame([("broken", "boom")], "model_name string, error string")
    board = leaderboard.leaderboard(board_of(spark, [("b", 0.5), ("a", 0.5), ("c", 0.9)]), "f1", failed)
    assert [r["model_name"] for r in board.collect()] == ["c", "a", "b", "broken"]
    assert one(leaderboard.best_model(board))["model_name"] == "c"
    summary = one(leaderboard.evaluation_summary(board))
    assert tuple(summary) == (4, 3, 1, "c")
    with pytest.raises(ValueError):
        leaderboard.leaderboard(board, "auc")


def test_best_is_null_when_every_run_failed(spark):
    failed = spark.createDataFrame([("x", "boom")], "model_name string, error string")
    board = leaderboard.leaderboard(board_of(spark, []), "f1", failed)
    assert one(leaderboard.best_model(board))["model_name"] is None


def test_url_lookup_keeps_duplicates_and_misses(spark):
    day = dt.date(2024, 5, 1)
    archive = spark.createDataFrame(
        [(2, "s2", "u", "late", day), (1, "s1", "u", "early", day), (0, "s0", "u", "outside", dt.date(2023, 1, 1))],
        "seq long, story_id string, url string, text string, publish_date date",
    )
    urls = spark.createDataFrame([(1, "u"), (2, "u"), (3, "miss")], "line_no long, url string")
    found = scoring.lookup_urls(urls, archive, "2024-01-01", "2024-12-31")
    assert rows(found) == [(1, "u", "s1", "early"), (2, "u", "s1", "early"), (3, "miss", None, None)]
    assert tuple(one(scoring.lookup_counts(found))) == (3, 2, 1)
    lineage = one(scoring.with_lineage(found.limit(1), "m"))
    assert lineage["model_used"] == "m" and lineage["prediction_timestamp"] is not None


def test_batches_respect_the_batch_size(spark):
    def load():
        import numpy as np

        class Model:
            classes = ["low", "high"]

            def scores(self, values):
                assert len(values) <= 3
                v = np.asarray(list(values))
                return np.stack([1 - v, v], axis=1)

        return Model()

    df = spark.createDataFrame([(i, i / 10) for i in range(11)], "i long, x double").repartition(2)
    got = scoring.score_batches(df, load, "x", ["i"], batch_size=3, probabilities=True)
    answers = {r["i"]: r for r in got.collect()}
    assert answers[0]["y_pred"] == "low" and answers[10]["y_pred"] == "high"
    assert answers[5]["y_pred"] == "low"  # tie goes to the lowest class
    assert all(close(sum(r["probabilities"]), 1.0) for r in answers.values())
    assert rows(scoring.prediction_distribution(got)) == [("high", 5), ("low", 6)]


def test_linear_models_learn(spark, out):
    vectors = spark.createDataFrame(
        [(i, [float(i % 2), 1.0 - i % 2], str(i % 2)) for i in range(40)], "record_id long, embedding array<float>, label string"
    )
    model = linear.fit_linear_vectors(vectors)
    got = dict(rows(linear.predict_linear(model, vectors, "embedding")))
    assert all(got[i] == str(i % 2) for i in range(40))
    texts = spark.createDataFrame(
        [(i, "good film" if i % 2 else "bad plot", "p" if i % 2 else "n") for i in range(20)],
        "record_id long, text string, label string",
    )
    text_model = linear.fit_linear_text(texts, linear.LinearParams(n_features=1 << 10))
    text_model.write().overwrite().save(out)
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(out)
    assert dict(rows(linear.predict_linear(again, texts)))[3] == "p"


def test_links_sections_and_filtering(spark):
    body = "climate policy " * 20
    df = spark.createDataFrame(
        [
            (1, "https://x.org/p", f'<title>One</title><a href="/a">1</a><a href="https://x.org/a">2</a><article><p>{body}</p></article>'),
            (2, "https://x.org/q", '<title>Climate</title><a href="/b">1</a><article><p>short climate</p></article>'),
            (3, "https://x.org/r", f"<title>None</title><article><p>{'other words ' * 30}</p></article>"),
        ],
        "page_id long, url string, html string",
    )
    assert rows(pages.page_links(df)) == [(1, "https://x.org/a"), (2, "https://x.org/b")]
    assert rows(pages.section_links(df, "^/b")) == [("https://x.org/b",)]
    kept = one(pages.fetch_and_filter(df, ["CLIMATE"], start="2024-01-01"))
    assert kept["title"] == "One" and kept["publish_date"] is None and kept["snippet"].endswith("...")


def test_source_matching(spark):
    listed = spark.createDataFrame(
        [
            ("a", "https://www.x.org/p", " YES, since 2020"),
            ("b", "https://y.org", "no"),
            ("c", None, "yes"),
            ("d", "https://z.org", "yes"),
            ("e", "https://w.org", None),
            ("f", "https://bad.org", "yes"),
        ],
        "source_name string, homepage_url string, present string",
    )
    directory = spark.createDataFrame(
        [("x.org", "7", 2), ("x.org", "5", 1), ("bad.org", "n/a", 1)], "domain string, id string, seq long"
    )
    matched = catalogue.match_sources(listed, directory)
    assert rows(matched, "source_name", "clean_domain", "source_id") == [
        ("a", "x.org", 5), ("c", None, None), ("d", "z.org", None), ("f", "bad.org", None),
    ]
    assert tuple(one(catalogue.match_counts(matched))) == (4, 3, 1)
    assert catalogue.unmatched_sources(matched).count() == 3


def test_full_text_prefers_the_archive(spark):
    urls = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "line_no long, url string")
    archive = spark.createDataFrame([(1, "a", None)], "seq long, url string, text string")
    scraped = spark.createDataFrame([(1, "a", "T", "x"), (2, "b", "T", "y")], "page_id long, url string, title string, text string")
    got = rows(catalogue.full_text(urls, archive, scraped), "line_no", "full_text", "origin")
    assert got == [(1, "", "archive"), (2, "T\n\ny", "page"), (3, "", "none")]


def test_sentiment(spark):
    lexicon = spark.createDataFrame(
        [("good", 2.0, 0.5, 0.6), ("bad", -3.0, -0.7, 0.8)], "term string, valence double, polarity double, subjectivity double"
    )
    texts = spark.createDataFrame([(1, "good good day"), (2, "bad"), (3, "nothing"), (4, "")], "record_id long, text string")
    got = {r["record_id"]: r for r in sentiment.lexicon_sentiment(texts, lexicon).collect()}
    assert close(got[1]["compound"], 4 / (16 + 15) ** 0.5) and got[1]["sentiment"] == "Positive"
    assert close(got[1]["polarity"], 0.5) and got[1]["n_hits"] == 2
    assert got[2]["sentiment"] == "Negative" and close(got[2]["subjectivity"], 0.8)
    assert got[3]["compound"] == 0.0 and got[4]["sentiment"] == "Neutral"


def test_line_diff_counts_copies(spark):
    old = spark.createDataFrame([(1, "a\nb\nb\nc"), (2, "same"), (3, "gone")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "b\nc\nc\nd"), (2, "same"), (4, "come")], "doc_id long, text string")
    diff = linediff.line_diff(linediff.snapshot_pairs(old, new))
    assert rows(diff) == [(1, "a", -1), (1, "b", -1), (1, "c", 1), (1, "d", 1), (3, "gone", -1), (4, "come", 1)]
    assert tuple(one(linediff.diff_summary(diff))) == (3, 3, 3)
