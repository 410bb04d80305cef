"""Terms in blocks: postings, numbers, and what sweeps make and move of them."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

from corpuslab.operators import bayes, sweep, termblocks
from corpuslab.operators.bayes import NaiveBayesParams
from corpuslab.operators.features import TfidfParams
from helpers import rows

TRAIN = [(1, "red red apple pie", "f"), (2, "green apple tree", "f"), (3, "red car red road", "c"), (4, "green car", "c"), (5, "", "c"), (6, "red apple car", "f")]
TEST = [(11, "red apple", "f"), (12, "car road car road", "c"), (13, "nothing known", "c"), (14, "green tree apple tree", "f")]
DOCS = "record_id long, text string, label string"


def postings(tokens, low, high, parts):
    """What a block holds and sends, as {(n, term, document): count}."""
    flat = pa.array([w for d in tokens for w in d], pa.string())
    packed, sent = termblocks._block(flat, np.array([len(d) for d in tokens]), low, high, parts)
    groups, sizes, counts, docs, tfs = (termblocks._unpack(packed[k], "<i4") for k in termblocks._POSTINGS)
    assert [s["g"] for s in sent] == groups.tolist()
    terms = [t for s in sent for t in termblocks._strings(termblocks._unpack(s["lengths"], "<i4"), termblocks._unpack(s["terms"], "u1")).to_pylist()]
    assert np.concatenate([termblocks._unpack(s["dfs"], "<i4") for s in sent]).tolist() == counts.tolist()
    n = np.repeat(groups // parts + 1, sizes)
    at = np.repeat(np.arange(len(terms)), counts)
    found = [(int(n[p]), terms[p], int(d)) for p, d in zip(at, docs, strict=True)]
    assert len(set(found)) == len(found) and len(set(zip(n.tolist(), terms, strict=True))) == len(terms)
    return dict(zip(found, tfs.tolist(), strict=True))


def test_blocks_equal_plain_counts():
    """Also of tokens that hold spaces, whose n-grams may be equal as texts only, of empty tokens and documents."""
    rng = np.random.default_rng(3)
    documents = [[["a", "b c", "a b", "c", "", "dé"][k] for k in rng.integers(0, 6, size)] for size in (0, 9, 1, 40, 0, 3)]
    for low, high in ((1, 1), (1, 2), (2, 3)):
        want = Counter()
        for d, words in enumerate(documents):
            want.update((n, " ".join(words[i : i + n]), d) for n in range(low, high + 1) for i in range(len(words) - n + 1))
        for parts in (1, 7):
            assert postings(documents, low, high, parts) == dict(want)


def test_no_term_is_moved_by_scoring(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = sweep.fit_and_predict_many(spark.createDataFrame(TRAIN, DOCS), spark.createDataFrame(TEST, DOCS), [sweep.NaiveBayesConfig("a", ngram_hi=2)])
        assert "hashpartitioning(term" not in many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_share_an_id(spark):
    """They share their norm in training and their sums in scoring, as in a single fit; a null id of a test row meets nothing."""
    train = spark.createDataFrame([*TRAIN, (1, "tree car tree", "c"), (None, "red pie", "f"), (None, "road tree", "c")], DOCS)
    test = spark.createDataFrame([*TEST, (12, "green pie", "f")], DOCS)
    many = sweep.fit_and_predict_many(train, test, [sweep.NaiveBayesConfig("a", alpha=0.3), sweep.NaiveBayesConfig("b", alpha=0.3, features=TfidfParams(norm="l1"))])
    for name, norm in (("a", "l2"), ("b", "l1")):
        model = bayes.fit(train, TfidfParams(norm=norm), NaiveBayesParams(0.3))
        want = {r["record_id"]: r["y_pred"] for r in model.predict(test).collect()}
        got = many.where(f"config_id = '{name}'").collect()
        assert len(got) == 5 and {r["record_id"]: r["y_pred"] for r in got} == want


def test_trials_share_their_texts(spark, out, monkeypatch):
    made, plain = [], sweep.number_terms
    monkeypatch.setattr(sweep, "number_terms", lambda *a: made.append(1) or plain(*a))
    trials = [sweep.NaiveBayesConfig("0"), sweep.NaiveBayesConfig("1", ngram_hi=2, min_df=2, features=TfidfParams(norm=None)), sweep.NaiveBayesConfig("2", min_df=99)]
    train, test = spark.createDataFrame(TRAIN, DOCS), spark.createDataFrame(TEST, DOCS)
    done = {r["trial"]: r for r in sweep.run_trials(train, test, trials, out).collect()}
    assert len(made) == 1 and done[2]["error"] == "no vocabulary is left"
    for c in trials[:2]:
        want = sweep.evaluate_many(train, test, [c]).first()
        assert done[int(c.config_id)]["f1"] == want["f1"]
    assert rows(sweep.run_trials(train, test, trials, out), "trial") == [(0,), (1,), (2,)] and len(made) == 3
