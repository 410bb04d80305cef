from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import ingest, search, tasks
from corpuslab.operators.selection import value_at_ranks
from helpers import one, rows

CANDIDATE = "seq long, story_id string, url string, text string"


def candidates(spark):
    return spark.createDataFrame(
        [
            (1, "a", "u/a", "new a"),
            (2, "b", "u/b", "old b"),
            (3, "c", "", "no url"),
            (4, "d", "u/d", ""),
            (5, "e", "u/e", "old e"),
            (6, "f", "u/f", "  "),
            (7, "g", "u/g", "old g"),
        ],
        CANDIDATE,
    )


def index(spark):
    return spark.createDataFrame(
        [("b", "success", 5), ("e", "success", 3), ("g", "success", 0), ("f", "failed_no_text", 9), ("zz", None, None)],
        "story_id string, status string, text_length long",
    )


def stored(spark):
    return candidates(spark).withColumn("status", F.lit("success"))


def test_new_and_existing_articles(spark):
    got = rows(ingest.ingest(candidates(spark), index(spark), stored(spark)), "seq", "status", "origin")
    assert got == [
        (1, "success", "new"),
        (2, "success", "existing"),
        (4, "failed_no_text", "new"),
        (5, "success", "existing"),
        (6, "success", "new"),
        (7, "success", "new"),
    ]


@pytest.mark.parametrize(
    "limit, want",
    [(0, []), (1, [1]), (2, [1, 2, 4]), (3, [1, 2, 4, 5, 6]), (4, [1, 2, 4, 5, 6, 7]), (9, [1, 2, 4, 5, 6, 7])],
)
def test_limit_counts_new_articles_only(spark, limit, want):
    c = candidates(spark)
    got = ingest.ingest(c, index(spark), stored(spark), limit)
    assert [r[0] for r in rows(got, "seq")] == want


def test_limits_beyond_the_candidates(spark):
    c = candidates(spark)
    got = ingest.ingest(c, index(spark), stored(spark), 2)
    assert [r[0] for r in rows(got, "seq")] == [1, 2, 4]
    assert len(rows(ingest.ingest(c, index(spark), stored(spark), 99))) == 6


def test_second_run_adds_nothing(spark):
    base = stored(spark).withColumns(
        {
            "retrieved_at": F.lit(dt.datetime(2025, 1, 1)),
            "title": F.lit("t"),
            "query": F.lit("q"),
            "publish_date": F.lit(dt.date(2024, 1, 1)),
        }
    ).where("url != ''")
    entries = ingest.index_entries(base)
    again = ingest.ingest(base.drop("status"), entries, base)
    # Only the blank article is tried again.
    assert rows(again.where("origin = 'new'"), "story_id") == [("d",)]


def test_index_merge_keeps_the_latest_entry(spark):
    schema = "story_id string, status string, retrieved_at timestamp, title string, text_length long, query string, url string, publish_date date"
    day = dt.datetime(2025, 1, 1)
    old = spark.createDataFrame(
        [("a", "failed_no_text", day, "", 0, "", "u", None), ("b", "success", day, "", 4, "", "u", None)], schema
    )
    new = spark.createDataFrame(
        [("a", "success", day, "", 7, "", "u", None), ("b", "success", day - dt.timedelta(1), "", 1, "", "u", None)], schema
    )
    assert rows(ingest.merge_index(old, new), "story_id", "status", "text_length") == [
        ("a", "success", 7), ("b", "success", 4),
    ]


def test_upper_median_of_even_and_odd_counts(spark):
    for texts, want in ((["a", "bb", "ccc", "dddd"], 3), (["a", "bb", "ccc"], 2), (["a"], 1)):
        df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "text string")
        assert one(ingest.text_length_stats(df))["median_length"] == want


def test_values_at_ranks_over_a_long_tail(spark):
    numbers = [0.0] * 5 + [float(i) for i in range(500)] + [1e12, -3.5]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    ranks = [1, 2, 7, 250, len(numbers), len(numbers) + 1]
    got = dict(rows(value_at_ranks(df, "v", [F.lit(r) for r in ranks])))
    ordered = sorted(numbers)
    assert got == {i: ordered[r - 1] for i, r in enumerate(ranks) if r <= len(numbers)}


def test_reports(spark):
    df = spark.createDataFrame(
        [("success", "en"), ("failed_no_text", None), (None, "fr"), ("success", "en")], "status string, language string"
    )
    assert rows(ingest.status_breakdown(df)) == [
        ("failed_no_text", 1, 50.0), ("success", 2, 50.0), ("unknown", 1, 50.0),
    ]
    assert rows(ingest.language_breakdown(df)) == [("en", 2), ("fr", 1), ("unknown", 1)]


def test_dates_are_strict():
    with pytest.raises(ValueError):
        search.parse_day("2024/01/01", search.DEFAULT_START)
    with pytest.raises(ValueError):
        search.validate_dates(dt.date(2024, 2, 1), dt.date(2024, 1, 1))
    with pytest.raises(ValueError):
        search.validate_dates(dt.date(2024, 2, 1), dt.date(2999, 1, 1))
    search.validate_dates(dt.date(2024, 1, 1), dt.date(2024, 1, 1))


def test_search_combines_terms_dates_and_collections(spark):
    df = spark.createDataFrame(
        [
            ("1", "Climate", "protest in town", "m1", dt.date(2024, 1, 5)),
            ("2", "climate change", "quiet", "m1", dt.date(2024, 1, 5)),
            ("3", "", "an activist on climate change", "m2", dt.date(2024, 1, 6)),
            ("4", None, "climate activist", "m1", None),
        ],
        "story_id string, title string, text string, media_id string, publish_date date",
    )
    hits = search.story_search(df, all_of=["climate"], any_of=["protest", "activis*"], start="2024-01-01")
    assert rows(hits, "story_id") == [("1",), ("3",)]
    assert rows(search.story_count(hits)) == [("m1", 1), ("m2", 1)]
    assert rows(search.story_search(df, all_of=["climate"], collections=["m2"]), "story_id") == [("3",)]
    window = df.where(search.date_window_or_null(F.col("publish_date"), "2024-01-06"))
    assert rows(window, "story_id") == [("3",), ("4",)]


def test_tasks_leave_out_blank_text_and_empty_fields(spark):
    df = spark.createDataFrame(
        [("s1", "  hello\n", "", "u1", None, dt.date(2024, 1, 2)), ("s2", " \n", "t", "u", "en", None)],
        "story_id string, text string, title string, url string, language string, publish_date date",
    )
    built = tasks.label_tasks(df)
    assert [r["value"] for r in tasks.task_json(built).collect()] == [
        '{"data":{"text":"hello","story_id":"s1","url":"u1","publish_date":"2024-01-02"},"external_id":"mc_story_s1"}'
    ]


def test_new_tasks_keep_null_ids_and_match_missing_as_empty(spark):
    new = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("",)], "story_id string")
    project = spark.createDataFrame([("a",), (None,)], "story_id string")
    assert rows(tasks.new_tasks(new, project)) == [("b",), ("b",), (None,), (None,)]
    no_missing = spark.createDataFrame([("a",)], "story_id string")
    assert ("",) in rows(tasks.new_tasks(new, no_missing))


def test_a_limit_asks_the_index_once_and_keeps_rows_without_a_story(spark):
    found = candidates(spark).union(spark.createDataFrame([(8, None, "u/h", "no story"), (None, "i", "u/i", "no place")], CANDIDATE))
    plain = ingest.ingest(found, index(spark), stored(spark))
    limited = ingest.ingest(found, index(spark), stored(spark), limit=100)
    assert rows(limited, "seq", "story_id", "origin") == rows(plain.where("seq IS NOT NULL"), "seq", "story_id", "origin")
    assert ingest.ingest(found, index(spark), stored(spark), limit=4).columns == plain.columns
    text = limited._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in text  # the index was asked when the keys were written


@pytest.mark.parametrize("kind, data", [("decimal(38,3)", [10**30 + k for k in range(50)]), ("bigint", [2**62 + k for k in range(50)]), ("double", [k / 7 for k in range(50)])])
def test_ranks_of_values_that_doubles_cannot_tell_apart(spark, kind, data):
    from decimal import Decimal

    values = [Decimal(v).scaleb(-3) if "decimal" in kind else v for v in data]
    table = spark.createDataFrame([(v,) for v in reversed(values)], f"x {kind}")
    got = value_at_ranks(table, "x", [F.lit(1), F.lit(17), F.lit(50), F.lit(51)], buckets=4).orderBy("which").collect()
    assert [(r["which"], r["x"]) for r in got] == [(0, values[0]), (1, values[16]), (2, values[49])]
