from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import bayes, ingest, tasks
from corpuslab.plans import jobs as plans
from corpuslab.schemas import ARTICLE, TASK
from corpuslab.session import materialise, shared_dir
from corpuslab.sources import annotations, articles, splits as split_io
from corpuslab.streaming import jobs, runs
from helpers import one, rows

DAY = dt.datetime(2025, 1, 1)


def article_rows(spark, items):
    data = [
        (f"u/{i}", f'title "{i}"', text, "archive", when, "success" if text else "failed_no_text", i, None, "m", "en", "q")
        for i, text, when in items
    ]
    return spark.createDataFrame(data, ARTICLE)


def test_store_index_and_exports(spark, out):
    assert articles.read_articles(spark, out + "/none").count() == 0
    assert articles.read_index(spark, out + "/none").count() == 0
    first = article_rows(spark, [("1", "line\nbreak, \"quoted\"", DAY), ("2", "", DAY)])
    articles.append_articles(first, out + "/store")
    assert articles.read_articles(spark, out + "/store").count() == 2
    articles.append_index(ingest.index_entries(first), out + "/index")
    later = article_rows(spark, [("2", "now there", DAY + dt.timedelta(1))])
    articles.append_index(ingest.index_entries(later), out + "/index")
    got = rows(articles.read_index(spark, out + "/index"), "story_id", "status", "text_length")
    assert got == [("1", "success", 20), ("2", "success", 9)]
    articles.compact_index(spark, out + "/index", out + "/index2")
    assert rows(articles.read_index(spark, out + "/index2"), "story_id", "status", "text_length") == got

    articles.export_csv(first, out + "/csv")
    back = articles.read_csv_export(spark, out + "/csv", ARTICLE)
    assert rows(back.where("story_id = '1'"), "text", "title") == [('line\nbreak, "quoted"', 'title "1"')]
    articles.write_failed_urls(first, out + "/failed")
    assert rows(spark.read.text(out + "/failed")) == [("u/2",)]
    articles.export_tasks(tasks.label_tasks(first), out + "/tasks")
    assert rows(articles.read_tasks(spark, out + "/tasks"), "external_id") == [("mc_story_1",)]


def test_small_inputs(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("  https://a  \n\n \nhttps://b\n")
    assert rows(articles.read_url_list(spark, str(tmp_path / "urls.txt")), "url") == [("https://a",), ("https://b",)]
    (tmp_path / "cat.csv").write_text(
        'name,url,present,health,climate,notes\n"A, ""b""",https://a,Yes,,,"two\nlines"\n'
    )
    (tmp_path / "lex.csv").write_text("term,valence,polarity,subjectivity\ngood,1.5,0.4,0.6\n")
    assert rows(articles.read_lexicon(spark, str(tmp_path / "lex.csv"))) == [("good", 1.5, 0.4, 0.6)]
    row = one(articles.read_source_catalogue(spark, str(tmp_path / "cat.csv")))
    assert (row["source_name"], row["notes"], row["has_health"]) == ('A, "b"', "two\nlines", None)


def test_split_and_report_files(spark, out):
    data = spark.createDataFrame([(1, "t", "a", "train"), (2, "t", "b", "test")], "record_id long, text string, label string, split string")
    split_io.write_split(data, out + "/split")
    train, test = split_io.read_split(spark, out + "/split")
    assert rows(train, "record_id") == [(1,)] and rows(test, "record_id") == [(2,)]
    split_io.write_split(data.drop("text"), out + "/bad")
    with pytest.raises(ValueError, match="text"):
        split_io.read_split(spark, out + "/bad")
    board = spark.createDataFrame([("m", 0.5)], "model_name string, f1 double")
    split_io.write_leaderboard(board, board, out + "/board")
    assert spark.read.option("header", True).csv(out + "/board/results").count() == 1
    split_io.write_predictions(data, out + "/pred")
    split_io.write_predictions(data, out + "/pred_csv", as_csv=True)
    assert spark.read.parquet(out + "/pred").count() == 2
    annotations.write_sections({"one": board}, out + "/sections")
    assert spark.read.json(out + "/sections/one").count() == 1


def test_materialised_tables_live_in_the_shared_folder(spark):
    table = materialise(spark.range(3).toDF("i"), "test")
    assert table.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark).removeprefix("file:"))
    assert table.count() == 3


# ---------------------------------------------------------------- streams


def deliver(table, path):
    table.write.mode("append").parquet(path)


def test_stream_ingest_is_idempotent_and_retries_failures(spark, out):
    source, store = out + "/in", out + "/store"
    deliver(article_rows(spark, [("1", "one", DAY), ("1", "one", DAY), ("2", "", DAY)]), source)

    def run(name):
        stream = spark.readStream.schema(ARTICLE).parquet(source)
        runs.finish(jobs.start_ingest(stream, store, f"{out}/cp-{name}"))
        return rows(runs.read_store(spark, store, ARTICLE), "story_id", "status")

    assert run("a") == [("1", "success"), ("2", "failed_no_text")]
    assert run("a") == [("1", "success"), ("2", "failed_no_text")]  # nothing new arrived
    deliver(article_rows(spark, [("2", "two", DAY), ("3", "three", DAY), ("1", "again", DAY)]), source)
    assert run("a") == [("1", "success"), ("2", "failed_no_text"), ("2", "success"), ("3", "success")]
    # A new checkpoint sees everything again and stores nothing twice.
    assert run("b") == [("1", "success"), ("2", "failed_no_text"), ("2", "success"), ("3", "success")]


def test_stream_tasks_push_each_story_once(spark, out):
    source, project = out + "/in", out + "/project"
    deliver(article_rows(spark, [("1", "one", DAY), ("2", " ", DAY)]), source)
    stream = lambda: spark.readStream.schema(ARTICLE).parquet(source)
    runs.finish(jobs.start_task_push(stream(), project, out + "/cp1"))
    deliver(article_rows(spark, [("3", "three", DAY)]), source)
    runs.finish(jobs.start_task_push(stream(), project, out + "/cp2"))
    got = runs.read_store(spark, project, TASK).select(F.col("data.story_id").alias("s"))
    assert rows(got) == [("1",), ("3",)]


def test_stream_scores_equal_batch_scores(spark, out):
    data = [(1, "good film", "p"), (2, "bad plot", "n"), (3, "good good", "p"), (4, "bad", "n")]
    docs = spark.createDataFrame(data, "record_id long, text string, label string")
    model = bayes.fit(docs)
    deliver(docs.select("record_id", "text"), out + "/in")
    stream = spark.readStream.schema("record_id long, text string").parquet(out + "/in")
    runs.finish(jobs.start_scoring(stream, model, out + "/scores", out + "/cp"))
    got = runs.read_store(spark, out + "/scores", jobs.PREDICTION)
    assert rows(got, "record_id", "y_pred") == rows(model.predict(docs))


# ---------------------------------------------------------------- composed jobs


def test_collect_train_and_infer(spark, sf):
    from corpuslab.plans import queries as q

    archive = q.articles(spark, sf)
    project = spark.createDataFrame([("0",)], "story_id string")
    found = plans.collect(archive, q.index(spark, sf), archive, project, limit=10, any_of=["the", "und"], end="2024-12-31")
    assert found.articles.where("origin = 'new'").count() == 10
    assert found.new_tasks.count() <= found.tasks.count()

    model, metrics = plans.train_and_evaluate(q.records(spark, sf))
    assert one(metrics)["accuracy"] > 0.9
    board = plans.evaluate_models({"nb": model, "broken": None}, q.records(spark, sf))
    assert [r["model_name"] for r in board.collect()] == ["nb", "broken"]
    urls = archive.where("url <> ''").select(F.col("seq").alias("line_no"), "url").limit(5)
    predicted = plans.infer_urls(urls, archive, model, "nb", "2024-01-01", "2024-12-31")
    assert predicted.count() == 5


def test_analysis_has_every_section(spark, sf):
    from corpuslab.plans import fixtures as fx

    sections = plans.analyse_annotations(fx.annotated_tasks(spark, sf), fx.REQUIRED_LABELS)
    assert len(sections) == 10
    assert one(sections["project_summary"])["total_tasks"] > 0
    assert sections["overall_agreement_metrics"].count() >= 2


def test_late_articles_are_kept(spark, out):
    """Four deliveries with retrieval times out of order; none may be lost."""
    source, store = out + "/in", out + "/store"
    for k, day in enumerate((20, 21, 22, 5)):
        deliver(article_rows(spark, [(str(k), f"text {k}", dt.datetime(2025, 1, day))]), source)
        stream = spark.readStream.schema(ARTICLE).parquet(source)
        runs.finish(jobs.start_ingest(stream, store, out + "/cp"))
    assert rows(runs.read_store(spark, store, ARTICLE), "story_id") == [("0",), ("1",), ("2",), ("3",)]


def test_grouped_split_keeps_every_row(spark):
    from corpuslab.operators import splits

    data = [(k, f"g{k % 5}" if k % 4 else None, "a" if k % 3 else None) for k in range(40)] + [(99, "none", None)]
    records = spark.createDataFrame(data, "record_id long, g string, label string")
    got = splits.stratified_split(records, group_by="g").collect()
    assert sorted(r["record_id"] for r in got) == sorted(k for k, _, _ in data)
    sides = {}
    for r in got:
        sides.setdefault(r["g"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values()) and sides["none"] == {None}
