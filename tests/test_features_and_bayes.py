from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import bayes, features, splits, sweep
from corpuslab.operators.bayes import NaiveBayesParams
from corpuslab.operators.features import TfidfParams
from helpers import close, one, rows

DOCS = [
    (1, "good good film", "pos"),
    (2, "good plot film", "pos"),
    (3, "bad film bad", "neg"),
    (4, "dull plot", "neg"),
    (5, "good", "pos"),
]
UNSEEN = [(10, "good good unknown", "pos"), (11, "", "neg"), (12, "bad plot film", "neg"), (13, None, "pos")]


def docs(spark, data=DOCS):
    return spark.createDataFrame(data, "record_id long, text string, label string")


def brute_fit(data, alpha=1.0, norm="l2"):
    counts = {i: Counter(t.split()) for i, t, _ in data}
    n = len(data)
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((1 + n) / (1 + d)) + 1 for w, d in df.items()}

    def vector(words):
        w = {t: k * idf[t] for t, k in Counter(words).items() if t in idf}
        size = {"l2": math.sqrt(sum(x * x for x in w.values())), "l1": sum(w.values()), None: 1.0}[norm]
        return {t: x / size for t, x in w.items()} if w else {}

    nct = defaultdict(lambda: defaultdict(float))
    for i, t, label in data:
        for term, x in vector(t.split()).items():
            nct[label][term] += x
    labels = Counter(label for _, _, label in data)

    def score(words):
        v = vector(words)
        out = {}
        for c in labels:
            nc = sum(nct[c].values())
            out[c] = math.log(labels[c] / n) + sum(
                x * math.log((nct[c].get(t, 0.0) + alpha) / (nc + alpha * len(idf))) for t, x in v.items()
            )
        return out

    return idf, score


@pytest.mark.parametrize("norm", ["l2", "l1", None])
@pytest.mark.parametrize("alpha", [1.0, 0.1])
def test_scores_match_the_definition(spark, norm, alpha):
    model = bayes.fit(docs(spark), TfidfParams(norm=norm), NaiveBayesParams(alpha=alpha))
    _, score = brute_fit(DOCS, alpha, norm)
    for row in model.score(docs(spark, UNSEEN)).collect():
        text = dict((i, t) for i, t, _ in UNSEEN)[row["record_id"]] or ""
        want = score(text.split())
        assert {e["label"] for e in row["scores"]} == set(want)
        for e in row["scores"]:
            assert close(e["score"], want[e["label"]])


def test_documents_without_known_terms_get_the_prior(spark):
    model = bayes.fit(docs(spark))
    predicted = dict(rows(model.predict(docs(spark, UNSEEN))))
    assert len(predicted) == 4 and predicted[11] == "pos" and predicted[13] == "pos"
    proba = model.predict_proba(docs(spark, UNSEEN))
    for row in proba.groupBy("record_id").agg(F.sum("probability").alias("s")).collect():
        assert close(row["s"], 1.0)
    prior = {r["label"]: r["probability"] for r in proba.where("record_id = 11").collect()}
    assert close(prior["pos"], 0.6)


def test_dense_likelihoods_sum_to_one_per_class(spark):
    dense = bayes.fit(docs(spark)).log_likelihood()
    assert dense.count() == 2 * 5
    for row in dense.groupBy("label").agg(F.sum(F.exp("log_lik")).alias("s")).collect():
        assert close(row["s"], 1.0)


def test_likelihoods_agree_with_spark_ml(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import Vectors

    model = bayes.fit(docs(spark), TfidfParams(norm=None, use_idf=False), NaiveBayesParams(alpha=0.5))
    terms = sorted(r["term"] for r in model.vocab.collect())
    points = [
        (float(label == "pos"), Vectors.dense([float(text.split().count(t)) for t in terms]))
        for _, text, label in DOCS
    ]
    ml = NaiveBayes(smoothing=0.5).fit(spark.createDataFrame(points, ["label", "features"]))
    theta = ml.theta.toArray()
    for r in model.log_likelihood().collect():
        assert close(r["log_lik"], theta[int(r["label"] == "pos")][terms.index(r["term"])])


def test_priors(spark):
    def prior(params):
        return dict(rows(bayes.fit(docs(spark), params=params).classes, "label", "log_prior"))

    assert close(prior(NaiveBayesParams(fit_prior=False))["neg"], math.log(0.5))
    assert close(prior(NaiveBayesParams(class_prior=[0.1, 0.9]))["neg"], math.log(0.1))
    with pytest.raises(ValueError):
        NaiveBayesParams(alpha=0)


def test_model_survives_saving_and_loading(spark, out):
    model = bayes.fit(docs(spark), TfidfParams(ngram_range=[1, 2]), path=out + "/a")
    again = bayes.load_model(spark, out + "/a")
    assert rows(again.predict(docs(spark, UNSEEN))) == rows(model.predict(docs(spark, UNSEEN)))
    again.save(out + "/a")  # its own folder stays whole
    assert rows(bayes.load_model(spark, out + "/a").predict(docs(spark, UNSEEN))) == rows(model.predict(docs(spark, UNSEEN)))
    again.save(out + "/b")
    with pytest.raises(Exception, match="(?i)exist"):
        model.save(out + "/b")
    info = bayes.load_model(spark, out + "/b").info()
    assert info["label_classes"] == ["neg", "pos"] and info["training_samples"] == 5
    assert info["hyperparameters"]["ngram_range"] == [1, 2]


def test_unknown_parameters_are_rejected():
    with pytest.raises(ValueError, match="num_epochs"):
        bayes.params_from_mapping({"num_epochs": 3})
    f, p = bayes.params_from_mapping({"alpha": 0.1, "ngram_range": [1, 2], "stop_words": "english"})
    assert p.alpha == 0.1 and f.stop_words == "english"
    with pytest.raises(ValueError):
        TfidfParams(norm="max")


def test_vocabulary_options(spark):
    d = docs(spark)

    def vocab(**params):
        p = TfidfParams(**params)
        found = features.vocabulary(features.term_frequencies(d, p), features.document_count(d), p)
        return {r["term"]: r for r in found.collect()}

    assert set(vocab(min_df=2)) == {"good", "film", "plot"}
    assert set(vocab(max_df=0.4)) == {"plot", "bad", "dull"}
    assert set(vocab(min_df=0.6)) == {"good", "film"}
    assert set(vocab(max_features=2)) == {"good", "film"}
    assert set(vocab(stop_words=["good", "bad"])) == {"film", "plot", "dull"}
    assert close(vocab(smooth_idf=False)["plot"]["idf"], math.log(5 / 2) + 1)
    assert vocab(use_idf=False)["plot"]["idf"] == 1.0


def test_term_weights_options(spark):
    d = docs(spark, [(1, "aa aa aa bb", "x")])

    def weights(**params):
        p = TfidfParams(use_idf=False, **params)
        v = features.vocabulary(features.term_frequencies(d, p), features.document_count(d), p)
        return {r["term"]: r["weight"] for r in features.tfidf(d, v, p).collect()}

    assert weights(norm=None) == {"aa": 3.0, "bb": 1.0}
    assert weights(norm=None, binary=True) == {"aa": 1.0, "bb": 1.0}
    assert close(weights(norm=None, sublinear_tf=True)["aa"], 1 + math.log(3))
    assert close(weights(norm="l1")["aa"], 0.75)
    assert close(weights(norm="l2")["bb"], 1 / math.sqrt(10))


def test_english_stop_words_come_from_spark(spark):
    d = docs(spark, [(1, "the film and the plot", "x")])
    found = features.term_frequencies(d, TfidfParams(stop_words="english"))
    assert rows(found, "term") == [("film",), ("plot",)]


def test_label_encoding_covers_both_sides(spark):
    train, test = docs(spark, DOCS[:2]), docs(spark, [(9, "x", "zzz"), (8, "y", "abc")])
    classes = bayes.encode_labels(train, test)
    assert rows(classes) == [("abc", 0), ("pos", 1), ("zzz", 2)]
    ids = spark.createDataFrame([(1, 2), (2, None)], "record_id long, class_id int")
    assert rows(bayes.decode_labels(ids, classes)) == [(1, "zzz"), (2, None)]


# ---------------------------------------------------------------- split


def labelled(spark, sizes):
    data, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            data.append((i, label))
            i += 1
    return spark.createDataFrame(data, "record_id long, label string")


@pytest.mark.parametrize(
    "sizes, ratio",
    [({"a": 50, "b": 30, "c": 20}, 0.8), ({"a": 7, "b": 5, "c": 3}, 0.7), ({"a": 101, "b": 2}, 0.5)],
)
def test_split_quotas_are_exact(spark, sizes, ratio):
    split = splits.stratified_split(labelled(spark, sizes), ratio)
    total = sum(sizes.values())
    n_train = math.floor(ratio * total)
    got = {(r["label"], r["split"]): r["n"] for r in splits.split_summary(split).collect()}
    assert sum(n for (_, s), n in got.items() if s == "train") == n_train
    for label, n in sizes.items():
        assert got.get((label, "train"), 0) + got.get((label, "test"), 0) == n
        assert abs(got.get((label, "train"), 0) - n_train * n / total) < 1


def test_split_is_reproducible_and_seeded(spark):
    records = labelled(spark, {"a": 40, "b": 40})
    first = rows(splits.stratified_split(records), "record_id", "split")
    assert first == rows(splits.stratified_split(records.repartition(7)), "record_id", "split")
    assert first != rows(splits.stratified_split(records, seed=7), "record_id", "split")


def test_split_orders_rows_by_their_key(spark):
    import hashlib

    records = labelled(spark, {"a": 20, "b": 10})
    key = {i: hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(30)}
    want = {*sorted(range(20), key=key.get)[:16], *sorted(range(20, 30), key=key.get)[:8]}
    split = splits.stratified_split(records)
    assert {r["record_id"] for r in split.where("split = 'train'").collect()} == want


def test_rare_class_falls_back_to_a_plain_split(spark):
    split = splits.stratified_split(labelled(spark, {"a": 9, "b": 1}), 0.8)
    sizes = {r["split"]: (r["n_rows"], r["ratio"]) for r in splits.split_sizes(split).collect()}
    assert sizes == {"train": (8, 0.8), "test": (2, 0.2)}
    with pytest.raises(ValueError):
        splits.check_split(splits.stratified_split(labelled(spark, {"a": 2, "b": 2, "c": 2}), 0.9))
    with pytest.raises(ValueError):
        splits.stratified_split(split, 1.0)


def test_groups_stay_together(spark):
    data = [(i, i // 2, "a" if i % 4 < 2 else "b") for i in range(40)]
    records = spark.createDataFrame(data, "record_id long, task_id long, label string")
    split = splits.stratified_split(records, 0.5, group_by="task_id")
    per_task = split.groupBy("task_id").agg(F.count_distinct("split").alias("n"), F.count("*").alias("rows"))
    assert per_task.where("n <> 1 or rows <> 2").count() == 0
    assert split.where("split = 'train'").count() == 20
    assert tuple(one(splits.task_id_range(split))) == (0, 19)


# ---------------------------------------------------------------- sweeps


def test_many_configs_equal_single_fits(spark):
    train, test = docs(spark), docs(spark, UNSEEN)
    configs = [
        sweep.NaiveBayesConfig("a", alpha=0.5),
        sweep.NaiveBayesConfig("b", alpha=1.0, ngram_hi=2, min_df=2),
        sweep.NaiveBayesConfig("none", min_df=100),
        sweep.NaiveBayesConfig("top", features=TfidfParams(max_features=3, norm=None)),
        sweep.NaiveBayesConfig("prior", features=TfidfParams(binary=True), class_prior=(0.9, 0.1)),
    ]
    many = sweep.fit_and_predict_many(train, test, configs)
    single_a = bayes.fit(train, params=NaiveBayesParams(alpha=0.5)).predict(test)
    single_b = bayes.fit(train, TfidfParams(ngram_range=(1, 2), min_df=2)).predict(test)
    assert rows(many.where("config_id = 'a'"), "record_id", "y_pred") == rows(single_a)
    assert rows(many.where("config_id = 'b'"), "record_id", "y_pred") == rows(single_b)
    metrics = {r["config_id"]: r["f1"] for r in sweep.evaluate_many(train, test, configs).collect()}
    assert set(metrics) == {"a", "b", "none", "top", "prior"} and metrics["none"] is None
    for c in configs[3:]:
        assert rows(many.where(F.col("config_id") == c.config_id), "record_id", "y_pred") == rows(bayes.fit(train, *c.whole()).predict(test))


def test_alpha_sweep_resume_and_best(spark):
    train, test = docs(spark), docs(spark, UNSEEN)
    model = bayes.fit(train)
    history = sweep.alpha_sweep(model, test, [(0, 0.0), (1, 1.0), (2, 5.0)])
    got = {r["trial"]: r for r in history.collect()}
    assert got[0]["f1"] == 0.0
    predicted = model.predict(test, keep=("record_id", "label"))
    accuracy = predicted.agg(F.avg((F.col("label") == F.col("y_pred")).cast("int"))).first()[0]
    assert close(got[1]["accuracy"], accuracy)
    trials = spark.createDataFrame([(1,), (3,)], "trial int")
    assert rows(sweep.remaining_trials(trials, history)) == [(3,)]
    assert one(sweep.best_trial(history))["trial"] == 1


def test_config_mappings_and_draws():
    models = [{"name": "n", "model_params": {"alpha": 0.1, "ngram_range": [1, 2]}}]
    assert sweep.configs_from_mappings(models)[0].ngram_hi == 2
    with pytest.raises(ValueError, match="batch_size"):
        sweep.configs_from_mappings([{"name": "n", "model_params": {"batch_size": 1}}])
    assert sweep.draw_configs(3) == sweep.draw_configs(3)


def test_rare_terms_of_big_vocabularies_are_joined_by_shuffle(spark, monkeypatch):
    model = bayes.fit(docs(spark))
    want = rows(model.predict(docs(spark, UNSEEN)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(bayes, "HEAD_TERMS", 2)
    try:
        predicted = bayes.fit(docs(spark)).predict(docs(spark, UNSEEN))
        plan = predicted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 3  # of the two frequent terms only
        assert "SortMergeJoin" in plan
        assert rows(predicted) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
