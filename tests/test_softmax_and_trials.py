"""Softmax regression, folder models and durable trials."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.functions.columns import compact_timestamp, iso_timestamp
from corpuslab.operators import linear, scoring, softmax, sweep
from corpuslab.operators.features import TfidfParams
from helpers import rows
from test_plans import plan


def plain_softmax(x, y, k, params):
    """The same steps with dense arrays: weights and bias of every epoch."""
    w, b, out = np.zeros((x.shape[1], k)), np.zeros(k), []
    for _ in range(params.epochs):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        r = p / p.sum(axis=1, keepdims=True) - np.eye(k)[y]
        w = w - params.rate * (x.T @ r / len(x) + params.decay * w)
        b = b - params.rate * r.sum(axis=0) / len(x)
        out.append((w, b))
    return out


def test_epochs_equal_dense_gradient_steps(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(60, 5)), rng.integers(0, 3, 60)
    x[np.abs(x) < 0.3] = 0
    data = [(i, "abc"[y[i]], [float(v) for v in x[i]]) for i in range(60)]
    table = spark.createDataFrame(data, "record_id long, label string, embedding array<double>")
    feats = softmax.vector_features(table).where("x != 0")
    packed = softmax.pack(feats, table)
    params = softmax.SoftmaxParams(epochs=4, rate=0.7, decay=0.05)
    model = softmax.fit(packed.where("record_id < 40"), packed.where("record_id >= 40"), params)
    plain = plain_softmax(x[:40], y[:40], 3, params)
    for (w, b), table_, bias in zip(plain, model.weights, model.biases, strict=True):
        got = {r["feature"]: r["w"] for r in table_.collect()}
        assert np.allclose([got[f] for f in range(5)], w, atol=1e-12) and np.allclose(bias, b, atol=1e-12)
    history = {r["epoch"]: r for r in model.history.collect()}
    for e, (w, b) in enumerate(plain):
        assert history[e]["accuracy"] == pytest.approx(((x[40:] @ w + b).argmax(axis=1) == y[40:]).mean())
    assert [r["best"] for r in history.values()].count(True) == 1 and history[model.best]["f1"] == max(r["f1"] for r in history.values())
    w, b = plain[model.best]
    assert rows(model.predict(packed), "record_id", "y_pred") == sorted(((i, "abc"[c]) for i, c in enumerate((x @ w + b).argmax(axis=1).tolist())), key=repr)


def test_records_without_features_or_label(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "record_id long, label string")
    feats = spark.createDataFrame([(1, "f", 1.0), (2, "g", 1.0)], "record_id long, feature string, x double")
    packed = softmax.pack(feats, table)
    model = softmax.fit(packed, packed, softmax.SoftmaxParams(epochs=2, rate=1.0))
    assert rows(model.predict(packed)) == [(1, "a"), (2, "b"), (3, "a"), (4, "a")]  # without features the bias decides
    with pytest.raises(ValueError):
        softmax.fit(packed.where("label is null"), packed)
    with pytest.raises(ValueError):
        softmax.SoftmaxParams(metric="loss")


def test_fit_has_no_nested_loops(spark):
    table = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [2.0])], "record_id long, label string, embedding array<double>")
    packed = softmax.pack(softmax.vector_features(table), table)
    model = softmax.fit(packed, packed, softmax.SoftmaxParams(epochs=2))
    text = plan(model.predict(packed))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


# ---------------------------------------------------------------- model folder


def test_a_thousand_classes_without_a_broadcast_by_hand(spark, out):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(1000, 16))
    train = spark.createDataFrame([(f"c{k:04d}", [float(v) for v in c]) for k, c in enumerate(centres)], "label string, embedding array<double>")
    linear.write_centroids(train, out)
    ask = spark.createDataFrame([(k, [float(v) for v in centres[k]]) for k in range(0, 1000, 37)] + [(5000, None), (5001, [1.0])], "i long, embedding array<double>")
    found = {r["i"]: r for r in scoring.score_folder(ask, out, "embedding", ["i"], probabilities=True).collect()}
    assert all(found[k]["y_pred"] == f"c{k:04d}" for k in range(0, 1000, 37))
    assert len(found[0]["probabilities"]) == 1000 and sum(found[0]["probabilities"]) == pytest.approx(1)
    assert found[5000]["y_pred"] is None and found[5001]["probabilities"] is None
    with pytest.raises(ValueError):
        linear.write_centroids(train.limit(0), out + "-empty")
        scoring.score_folder(ask, out + "-empty", "embedding", ["i"])


def test_probabilities_are_the_softmax_of_the_scores(spark, out):
    train = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [1.0, 0.0]), ("b", [3.0, 0.0])], "label string, embedding array<double>")
    linear.write_centroids(train, out)
    got = scoring.score_folder(train, out, "embedding", ["label"], probabilities=True).collect()
    w = np.array([[0.0, 1.0], [2.0, 0.0]])
    for r, x in zip(got, ([0, 1], [1, 0], [3, 0]), strict=True):
        z = w @ x - 0.5 * (w * w).sum(axis=1)
        assert np.allclose(r["probabilities"], np.exp(z) / np.exp(z).sum())


# ---------------------------------------------------------------- trials


def test_draws_repeat_and_extend():
    assert sweep.draw_trials(3, 7) == sweep.draw_trials(9, 7)[:3] and sweep.draw_trials(3, 7) != sweep.draw_trials(3, 8)
    norms = {c.features.norm for c in sweep.draw_trials(40)}
    assert norms == {"l1", "l2", None} and {c.ngram_hi for c in sweep.draw_trials(40)} == {1, 2}


def test_a_sweep_goes_on_after_a_crash(spark, out, monkeypatch):
    data = [(k, "good film" if k % 2 else "bad plot", "p" if k % 2 else "n") for k in range(20)]
    docs = spark.createDataFrame(data, "record_id long, text string, label string")
    trials = [sweep.NaiveBayesConfig(str(k), alpha=0.1 * (k + 1), features=TfidfParams(norm=n)) for k, n in enumerate(("l2", "l1", None, "l2"))]
    whole, asked = sweep.evaluate_many, []

    def counted(train, test, configs):
        asked.append(configs[0].config_id)
        if len(asked) == 2:
            raise RuntimeError("trial breaks")
        if len(asked) == 3:
            raise KeyboardInterrupt
        return whole(train, test, configs)

    monkeypatch.setattr(sweep, "evaluate_many", counted)
    with pytest.raises(KeyboardInterrupt):
        sweep.run_trials(docs, docs, trials, out)
    done = {r["trial"]: r for r in sweep.read_history(spark, out).collect()}
    assert set(done) == {0, 1} and done[0]["f1"] == 1.0 and done[1]["f1"] == 0.0 and "breaks" in done[1]["error"]
    history = sweep.run_trials(docs, docs, trials, out)
    assert asked == ["0", "1", "2", "2", "3"]
    assert rows(history, "trial", "f1") == [(0, 1.0), (1, 0.0), (2, 1.0), (3, 1.0)]
    assert sweep.best_trial(history).first()["trial"] == 0
    sweep.run_trials(docs, docs, trials, out)
    assert len(asked) == 5


# ---------------------------------------------------------------- time stamps


def test_timestamp_forms(spark):
    at = [dt.datetime(2024, 2, 3, 4, 5, 6), dt.datetime(2024, 2, 3, 4, 5, 6, 70), None]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(at)], "k int, t timestamp")
    got = {r["k"]: (r["i"], r["c"]) for r in table.select("k", iso_timestamp(F.col("t")).alias("i"), compact_timestamp(F.col("t")).alias("c")).collect()}
    assert got == {k: (t and t.isoformat(), t and t.strftime("%Y%m%d_%H%M%S")) for k, t in enumerate(at)}
