"""Many keywords at once: one Aho-Corasick automaton finds all of them in one pass over a text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def keyword_hits(articles: DataFrame, keywords: Sequence[str], columns: Sequence[str] = ("title", "text"), column: str = "keywords") -> DataFrame:
    """Articles that contain any keyword as a case-insensitive substring, with the sorted distinct keywords they contain.

    Equals ``search.keyword_filter`` on the articles it keeps; where that tests each keyword in turn, the time here does not depend on their number. The
    list is the caller's and goes to the tasks, which make the automaton once each. Texts are lower-cased by Spark, null ones are empty.
    Keywords are returned in lower case; an empty one is in every text, and of an empty list no article is kept. A column of the
    new name is replaced.
    """
    words = sorted({k.lower() for k in keywords})
    spark = articles.sparkSession
    held = spark.sparkContext.broadcast(words)
    plain = articles.drop(column)
    names, n = [*plain.columns, column], len(plain.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        known = held.value
        always = [k for k, w in enumerate(known) if not w]
        automaton = ahocorasick.Automaton()
        for number, word in enumerate(known):
            if word:
                automaton.add_word(word, number)
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            hits = []
            for texts in zip(*(batch.column(n + k).to_pylist() for k in range(len(columns))), strict=True):
                found = set(always)
                if len(automaton):
                    for text in texts:
                        found.update(number for _, number in automaton.iter(text))
                hits.append([known[k] for k in sorted(found)])
            made = pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(hits, pa.list_(pa.string()))], names=names)
            yield made.filter(pa.array([bool(h) for h in hits], pa.bool_()))

    lowered = [F.lower(F.coalesce(F.col(c), F.lit(""))).alias(f"lowered {c}") for c in columns]
    schema = T.StructType([*plain.schema.fields, T.StructField(column, T.ArrayType(T.StringType()))])
    return plain.select("*", *lowered).mapInArrow(run, schema)
