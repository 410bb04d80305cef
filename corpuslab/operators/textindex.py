"""Positional inverted index of an article table: story search that reads postings instead of texts.

A posting is a term, a story and the places of the term in the story's lower-cased title and text. A place is coded as twice the number of
the word, plus one if only white space lies between it and the word before; so a phrase is a shift of places, and a comma inside it
is told from a blank. Postings are written in parts by a hash of a term's first letters, sorted by term within a part: a term, or a prefix of
three letters or more, reads one part and the row groups whose bounds hold it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import let
from ..functions.text import WORD
from .search import date_between

PARTS = 16
#: First letters of a term that decide its part.
LETTERS = 3
POSTING = "story_id string, term string, places array<int>, part int"
_WORDS = rf"[{WORD}]+"


def places(haystack: Column) -> Column:
    """``array<struct<term, places array<int>>>`` of a lower-cased text, computed inside the row."""

    def coded(words: Column, gaps: Column) -> Column:
        blank = lambda k: F.get(gaps, k).rlike(r"^\s+$").cast("int")
        return F.transform(words, lambda w, k: F.struct(w.alias("term"), (k * 2 + F.when(k > 0, blank(k)).otherwise(0)).alias("place")))

    def runs(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        numbers = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        term = lambda i: F.get(ordered, i)["term"]
        starts = F.filter(numbers, lambda i: (i == 0) | (term(i) != term(F.greatest(i - 1, F.lit(0)))))

        def cut(begin: Column) -> Column:
            end = lambda k: F.coalesce(F.get(begin, k + 1), F.size(ordered))
            of = lambda p, k: F.transform(F.slice(ordered, p + 1, end(k) - p), lambda e: e["place"])
            return F.transform(begin, lambda p, k: F.struct(term(p).alias("term"), of(p, k).alias("places")))

        return let(starts, cut)

    found = F.regexp_extract_all(haystack, F.lit(_WORDS), F.lit(0))
    gaps = F.split(haystack, _WORDS, -1)
    return let(found, lambda words: let(gaps, lambda between: let(F.sort_array(coded(words, between)), runs)))


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.substring(term, 1, LETTERS)), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class Term:
    """A search term as words of the index; the last may be a prefix."""

    words: tuple[str, ...]
    prefix: bool

    @classmethod
    def of(cls, term: str) -> Term:
        words = tuple(term.rstrip("*").lower().split())
        if not words or not all(c.isalnum() or c == "_" for w in words for c in w):
            raise ValueError(f"an index term consists of words of letters, digits and underscores, got {term!r}")
        return cls(words, term.endswith("*"))

    def tests(self) -> list[tuple[str, bool]]:
        """(word, whether it is a prefix) in order."""
        return [(w, self.prefix and k == len(self.words) - 1) for k, w in enumerate(self.words)]


@dataclass(frozen=True)
class TextIndex:
    """Index in a folder: ``postings`` by part and term, and ``stories``, the articles without their texts."""

    spark: SparkSession
    path: str
    parts: int = PARTS

    @classmethod
    def build(cls, articles: DataFrame, path: str, parts: int = PARTS) -> TextIndex:
        """Write the index of articles with one row a story. Runs jobs.

        Places are found where an article is read; only postings are moved. They are dealt by part, term and story, so that a term of all stories
        fills many files.
        """
        haystack = F.lower(F.concat_ws("\n", F.col("title"), F.col("text")))
        found = articles.select(F.col("story_id").cast("string"), F.inline_outer(places(haystack))).where("term is not null")
        placed = found.withColumn("part", _part(F.col("term"), parts))
        files = max(parts, int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = placed.repartitionByRange(files, "part", "term", "story_id").sortWithinPartitions("part", "term", "story_id")
        dealt.write.partitionBy("part").parquet(f"{path}/postings")
        articles.drop("title", "text").write.parquet(f"{path}/stories")
        return cls(articles.sparkSession, path, parts)

    def stories(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/stories")

    def _postings(self, tests: Sequence[tuple[str, bool]]) -> DataFrame:
        """Postings that a word or prefix asks for: few parts, and term predicates that reach the scan."""
        postings = self.spark.read.schema(POSTING).parquet(f"{self.path}/postings")
        wanted = F.lit(False)
        for word, prefix in tests:
            wanted = wanted | (F.col("term").startswith(word) if prefix else F.col("term") == word)
        if all(not p or len(w) >= LETTERS for w, p in tests):
            keys = [(w[:LETTERS],) for w, _ in tests]
            one = self.spark.createDataFrame(keys, "w string").select(_part(F.col("w"), self.parts).alias("p")).distinct()
            postings = postings.where(F.col("part").isin([r["p"] for r in one.collect()]))
        return postings.where(wanted)

    def matches(self, terms: Sequence[str]) -> DataFrame:
        """``(story_id, t0, t1, ...)``: which terms a story holds, for stories that hold a word of any."""
        asked = [Term.of(t) for t in terms]
        tests = list(dict.fromkeys(x for t in asked for x in t.tests()))
        number = {x: k for k, x in enumerate(tests)}
        nothing = F.array().cast("array<int>")

        def gathered(word: str, prefix: bool) -> Column:
            hit = F.col("term").startswith(word) if prefix else F.col("term") == word
            return F.flatten(F.collect_list(F.when(hit, F.col("places")))) if prefix else F.coalesce(F.max(F.when(hit, F.col("places"))), nothing)

        rows = self._postings(tests).groupBy("story_id").agg(*[gathered(w, p).alias(f"w{k}") for k, (w, p) in enumerate(tests)])

        def held(term: Term) -> Column:
            starts = None
            for shift, test in enumerate(term.tests()):
                found = F.col(f"w{number[test]}")
                if shift:  # only white space before the word, which is the shift-th after the first
                    found = F.filter(found, lambda x: x % 2 == 1)
                begins = _begins(found, shift)
                starts = begins if starts is None else F.array_intersect(starts, begins)
            return F.size(starts) > 0

        return rows.select("story_id", *[held(t).alias(f"t{k}") for k, t in enumerate(asked)])

    def search(
        self, all_of: Sequence[str] = (), any_of: Sequence[str] = (), none_of: Sequence[str] = (), start: str | dt.date | None = None, end: str | dt.date | None = None,
        collections: Sequence[str] | None = None, collection_column: str = "media_id",
    ) -> DataFrame:
        """Stories that ``search.story_search`` finds for the same question, without their title and text."""
        hits = self.stories().where(date_between(F.col("publish_date"), start, end))
        if collections is not None:
            hits = hits.where(F.col(collection_column).isin(list(collections)))
        terms = [*all_of, *any_of, *none_of]
        if not terms:
            return hits
        found = self.matches(terms)
        flags = [F.coalesce(F.col(f"t{k}"), F.lit(False)) for k in range(len(terms))]
        every, some, no = flags[: len(all_of)], flags[len(all_of) : len(all_of) + len(any_of)], flags[len(all_of) + len(any_of) :]
        condition = F.lit(True)
        for flag in every:
            condition = condition & flag
        if some:
            either = F.lit(False)
            for flag in some:
                either = either | flag
            condition = condition & either
        for flag in no:
            condition = condition & ~flag
        how = "inner" if every or some else "left"  # a question of exclusions alone keeps stories without any term
        return hits.join(found, "story_id", how).where(condition).select(hits.columns)


def _begins(found: Column, shift: int) -> Column:
    """Word numbers where a phrase would begin whose word number ``shift`` has these places."""
    return F.transform(found, lambda x: F.shiftright(x, 1) - shift)
