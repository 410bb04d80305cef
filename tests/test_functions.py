from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.functions import columns, html, text, urls
from helpers import one


def value(spark, expression, **data):
    schema = ", ".join(f"{k} string" for k in data)
    return spark.createDataFrame([tuple(data.values())], schema).select(expression.alias("v")).first()["v"]


def test_strip_handles_unicode_space(spark):
    assert value(spark, text.strip(F.col("t")), t=" \t\n x y  　") == "x y"
    assert value(spark, text.is_blank(F.col("t")), t="  \x1c ") is True
    assert value(spark, text.is_blank(F.col("t")), t=None) is True
    assert value(spark, text.is_blank(F.col("t")), t=" a ") is False


def test_tokens_follow_the_default_pattern(spark):
    source = "L'été a 2 co-op_s, naïve ÜBER x yz!"
    want = re.findall(r"(?u)\b\w\w+\b", source.lower())
    assert value(spark, text.tokens(F.col("t")), t=source) == want


def test_custom_token_pattern_with_group_and_case(spark):
    found = value(spark, text.tokens(F.col("t"), lowercase=False, pattern=r"#(\w+)"), t="#Aé b #C1")
    assert found == ["Aé", "C1"]


def test_ngrams_and_stop_words(spark):
    words = text.tokens(F.col("t"), stop_words=["of"])
    assert value(spark, text.ngrams(words, 1, 2), t="end of the day") == [
        "end", "the", "day", "end the", "the day",
    ]
    assert value(spark, text.ngrams(words, 2, 3), t="one") == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "é", "z"]), max_size=12), min_size=1, max_size=8))
def test_term_counts_equal_a_counter(spark, lists):
    data = [(i, words) for i, words in enumerate(lists)]
    df = spark.createDataFrame(data, "i int, w array<string>").select(
        "i", text.term_counts(F.col("w")).alias("c")
    )
    for row in df.collect():
        words = lists[row["i"]]
        assert {e["term"]: e["tf"] for e in row["c"]} == {w: words.count(w) for w in words}


def test_whole_word_phrase_and_prefix_matching(spark):
    def hit(term, t):
        return value(spark, text.matches_term(F.lower(F.col("t")), term), t=t)

    assert hit("climate change", "The Climate\n change, now")
    assert not hit("climate change", "climate changes")
    assert hit("climate chang*", "climate changes")
    assert not hit("art", "party")
    assert hit("c++", "we use C++ here")
    assert not hit("art", None)


def test_snippet_is_one_line(spark):
    got = value(spark, text.snippet(F.col("t"), 5), t="ab\ncdefg")
    assert got == "ab cd..."


def test_domains_keep_port_and_drop_every_www(spark):
    assert value(spark, urls.clean_domain(F.col("u")), u="https://www.a.www.org:80/x?y") == "a.org:80"
    assert value(spark, urls.clean_domain(F.col("u")), u="no scheme") == ""
    assert value(spark, urls.clean_domain(F.col("u")), u=None) is None


def test_relative_links_become_absolute(spark):
    got = value(spark, urls.absolute_url(F.col("l"), F.col("p")), l="/a/b", p="https://x.org/z?q#f")
    assert got == "https://x.org/a/b"
    assert value(spark, urls.absolute_url(F.col("l"), F.col("p")), l="http://y/", p="https://x.org") == "http://y/"


PAGE = """<html><head><title>A &amp; B</title><script>var t="</p>";</script>
<meta property="article:published_time" content="2024-05-06T07:08:09"></head>
<body><nav><a href="/n">n</a></nav><article><h1>A</h1><!-- x <p> --><p>One <b>two<br>three</p>
<p>4 &lt; 5 &copy;</p></article></body></html>"""


def test_page_parts(spark):
    assert value(spark, html.title(F.col("h")), h=PAGE) == "A & B"
    assert value(spark, html.body_text(F.col("h")), h=PAGE) == "A\nOne two\nthree\n4 < 5 ©"
    assert str(value(spark, html.publish_date(F.col("h")), h=PAGE)) == "2024-05-06"
    assert value(spark, html.publish_date(F.col("h")), h="<p>x</p>") is None
    assert value(spark, html.links(F.col("h")), h=PAGE + "<A class='c' HREF=\"http://b/\">") == ["/n", "http://b/"]
    assert value(spark, html.body_text(F.col("h")), h="<body><p>only body</p></body>") == "only body"


def test_bands_and_sentiment_classes(spark):
    df = spark.createDataFrame(
        [(0.8,), (0.79,), (0.4,), (0.2,), (0.0,), (-0.1,), (None,)], "v double"
    ).select(columns.agreement_band(F.col("v")).alias("b"))
    assert [r["b"] for r in df.collect()] == [
        "Excellent", "Good", "Moderate", "Fair", "Poor", "Worse than random", None,
    ]
    marks = spark.createDataFrame([(0.05,), (-0.05,), (0.049,)], "v double").select(
        columns.sentiment_class(F.col("v")).alias("c")
    )
    assert [r["c"] for r in marks.collect()] == ["Positive", "Negative", "Neutral"]


def test_evaluated_once_keeps_the_row(spark):
    df = spark.createDataFrame([("a",)], "t string").select(
        columns.evaluated_once(u=F.upper("t"), n=F.length("t"))
    )
    assert tuple(one(df)) == ("A", 1)


def test_links_in_comments_and_scripts_are_none(spark):
    page = '<a href="/a">a</a><!-- <a href="/b">b</a> --><script>w("<a href=/c>c</a>")</script><STYLE><a href=/d></STYLE><a href=/e>e</a>'
    table = spark.createDataFrame([(page,)], "html string")
    assert table.select(html.links(F.col("html")).alias("l")).first()["l"] == ["/a", "/e"]
