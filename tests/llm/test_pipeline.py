"""The pipeline, stage by stage, against plain Python on a small corpus with odd rows."""

from __future__ import annotations

import hashlib
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as pipeline  # noqa: E402
from corpuslab.llm import factorisation as fm, latent  # noqa: E402
from corpuslab.llm.queries import tokenizer_path  # noqa: E402
from test_mended_operators import plain_similar  # noqa: E402
from test_simhash_lines_bpe import plain_components, plain_lines  # noqa: E402

STAGES = dict(pipeline.STAGES)
NAMES = list(STAGES)


@pytest.fixture(scope="module")
def corpus(spark, sf, tmp_path_factory):
    """Documents of the driver with odd rows and columns whose names the operators use, beside labels and benchmark."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{sf}/documents.parquet' WHERE doc_id < 150").fetchall()
    odd = [(9001, None), (9002, ""), (9003, " \n \n"), (9004, "x" * 100_000), (None, "no id here"), (None, None)]
    rows = [*docs, *[(i, t, "en", "odd", None if t is None else len(t)) for i, t in odd], docs[3], docs[3]]
    rows += [(9100 + k, f"own words number {k}\nShared footer of twelve\n", "en", "odd", 40) for k in range(12)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def with_clashes(docs):
    return docs.selectExpr("*", "1 AS _score", "2 AS key", "'n' AS _kept_text", "3 AS h1", "4 AS fp", "5 AS id", "6 AS _h1")


def rows_of(table):
    return sorted(((r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()), key=repr)


def test_stages_equal_plain_python(spark, corpus):
    docs = with_clashes(spark.read.parquet(f"{corpus}/documents.parquet"))
    columns, now = docs.columns, docs.collect()

    # quality: the fitted machine in plain Python
    labels = spark.read.parquet(f"{corpus}/labels.parquet").where(fm.held_in())
    machine = fm.fit(docs, labels)
    scores = machine.score([fm.features((r.text or "").encode(), r.n_chars) for r in now])
    want = sorted(((r.doc_id, r.text) for r, s in zip(now, scores, strict=True) if s >= 0.5), key=repr)
    out = STAGES[NAMES[0]](spark, docs, corpus)
    assert out.columns == columns and rows_of(out) == want and 100 < len(want) < len(now)

    # lines
    out = STAGES[NAMES[1]](spark, docs, corpus)
    plain = plain_lines([(r.doc_id, r.text) for r in now], 10)
    assert out.columns == columns
    assert sorted(((r.doc_id, r.text or "") for r in out.collect()), key=repr) == sorted(((i, t) for i, t, _, _ in plain), key=repr)
    assert all((r.text is None) == (r.n_chars is None) or r.n_chars is not None for r in out.collect())
    assert all(r.n_chars == len(r.text) for r in out.where("doc_id >= 9100").collect())

    # near-duplicates: of every group of similar texts the smallest id; rows with the same id and text are one document
    out = STAGES[NAMES[2]](spark, docs, corpus)
    own = sorted({(r.doc_id, r.text) for r in now if r.doc_id is not None}, key=lambda r: (r[0], r[1] or ""))
    close = [(a, b) for a, b, _ in plain_similar([t for _, t in own])]
    roots = plain_components(range(len(own)), close)
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert out.columns == columns and kept == sorted(own[k][0] for k, r in roots.items() if k == r) and len(kept) < len(own)
    assert out.where("doc_id is null").count() == 2

    # benchmark: no item's words in any row that stays, and rows without an item stay
    out = STAGES[NAMES[3]](spark, docs, corpus)
    items = [latent.words_of(t.encode()) for (t,) in duckdb.sql(f"SELECT text FROM '{corpus}/benchmark.parquet/*.parquet'").fetchall()]
    joined = {i: b" " + b" ".join(latent.words_of((r.text or "").encode())) + b" " for i, r in enumerate(now)}
    whole = {i for i, t in joined.items() if any(b" " + b" ".join(w) + b" " in t for w in items)}
    want = sorted(((r.doc_id, r.text) for i, r in enumerate(now) if i not in whole), key=repr)
    assert out.columns == columns and rows_of(out) == want and whole

    # tokens
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    reference.no_truncation()
    out = {r.doc_id: r for r in STAGES[NAMES[4]](spark, docs, corpus).where("doc_id is not null").collect()}
    for r in now:
        if r.doc_id is not None:
            ids = reference.encode(r.text or "", add_special_tokens=False).ids
            assert out[r.doc_id].n_tokens == len(ids)
            assert out[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_take_an_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for stage in STAGES.values():
        assert stage(spark, docs, corpus).count() == 0


def test_run_joins_the_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, corpus)
    want = sorted((tuple(r) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in pipeline.run(spark, corpus).collect()), key=repr) == want and want
