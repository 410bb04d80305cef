"""Multinomial logistic regression as DataFrame algebra: full-batch gradient steps, the best epoch by a held-out metric.

Features are rows ``(record_id, feature, x)``, so texts (tf-idf weights) and vectors (dimensions) are fitted alike. They are packed once, one
row a record in a table bucketed by record, and not moved again. An epoch sums the scores of a record over its features, writes the residuals,
probability minus label, one narrow row a record, joins them with the packed records by bucket, and sums them again by
feature; both sums fold on the map side. Weights are one row a feature with an array over the classes, written after every
epoch, so that a lost executor costs one epoch and Spark knows their size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, materialise_buckets, new_run_dir
from .bayes import HEAD_PAIRS, TIE_DIGITS
from .features import HEAD_TERMS, join_terms
from .metrics import METRICS, weighted_metrics


@dataclass(frozen=True)
class SoftmaxParams:
    """``epochs`` full passes; ``rate`` scales a step, ``decay`` draws the weights towards zero."""

    epochs: int = 3
    rate: float = 10.0
    decay: float = 0.0
    metric: str = "f1"

    def __post_init__(self) -> None:
        if self.epochs < 1 or not self.rate > 0 or self.decay < 0:
            raise ValueError(f"epochs and rate must be positive, decay not negative: {self}")
        if self.metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")


def _array(classes: list[str], value: Callable[[int], Column]) -> Column:
    return F.array(*[value(c) for c in range(len(classes))])


def _scores(packed: DataFrame, weights: DataFrame, bias: list[float], keep: list[str]) -> DataFrame:
    """``(record_id, *keep, scores)`` of packed records; a record without features scores the bias.

    Only the sums of a record are moved, and the features that ``weights`` count least.
    """
    k = len(bias)
    rows = packed.select("record_id", *keep, F.inline("features"))
    met = join_terms(rows, weights, "n", max(1, min(HEAD_TERMS, HEAD_PAIRS // k)), "feature")
    hits = met.select("record_id", *keep, *[(F.col("x") * F.get("w", F.lit(c))).alias(f"s{c}") for c in range(k)])
    # Every record once more with nothing, so that one without known features stays.
    every = packed.select("record_id", *keep, *[F.lit(0.0).alias(f"s{c}") for c in range(k)])
    kept = [F.first(c).alias(c) for c in keep]
    found = hits.unionByName(every).groupBy("record_id").agg(*kept, *[F.sum(f"s{c}").alias(f"s{c}") for c in range(k)])
    return found.select("record_id", *keep, F.array(*[F.col(f"s{c}") + bias[c] for c in range(k)]).alias("scores"))


def _best_class(classes: list[str]) -> Column:
    """Label of the greatest score, ties to the lowest class."""
    names = F.array(*[F.lit(c) for c in classes])
    ranked = F.transform("scores", lambda s, i: F.struct(F.round(s, TIE_DIGITS).alias("s"), (-i).alias("i")))
    return F.get(names, -F.array_max(ranked)["i"])


def pack(features: DataFrame, records: DataFrame, keep: tuple[str, ...] = ("label",), norm: str | None = None) -> DataFrame:
    """Written ``(record_id, *keep, features)``: every record with all its features in one row, bucketed by record.

    ``norm`` (l1 or l2) divides the features of a record by their norm, which costs no further move here.
    """
    x = F.col("x")
    size = {"l2": F.sqrt(F.sum(x * x)), "l1": F.sum(F.abs(x)), None: F.lit(1.0)}[norm]
    listed = features.groupBy("record_id").agg(F.collect_list(F.struct("feature", "x")).alias("features"), size.alias("_size"))
    if norm is not None:
        scaled = F.transform("features", lambda f: F.struct(f["feature"].alias("feature"), (f["x"] / F.col("_size")).alias("x")))
        listed = listed.withColumn("features", scaled)
    listed = listed.drop("_size")
    empty = F.array().cast(listed.schema["features"].dataType)
    rows = records.select("record_id", *keep).join(listed, "record_id", "left").withColumn("features", F.coalesce("features", empty))
    return materialise_buckets(rows, "packed", "record_id")


@dataclass(frozen=True)
class SoftmaxModel:
    """Weights of every epoch, and which one is best."""

    classes: list[str]
    weights: list[DataFrame]
    biases: list[list[float]]
    history: DataFrame  # epoch, the metrics, best
    best: int

    def predict(self, packed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``(record_id, *keep, y_pred)`` of packed records by the best epoch."""
        scored = _scores(packed, self.weights[self.best], self.biases[self.best], list(keep))
        return scored.select("record_id", *keep, _best_class(self.classes).alias("y_pred"))


def fit(train: DataFrame, held: DataFrame, params: SoftmaxParams = SoftmaxParams(), path: str | None = None) -> SoftmaxModel:
    """Fit packed records with a label, from zero weights; ``held`` decides the best epoch, the first of equals. Runs jobs.

    Records without a label are left out. The classes are the labels of ``train``, whose list is held by the driver.
    """
    path = path or new_run_dir(train.sparkSession, "softmax")
    train = train.where("label is not null")
    n, classes = train.count(), [r["label"] for r in train.select("label").distinct().orderBy("label").collect()]
    if not n:
        raise ValueError("no labelled records to fit")
    k = len(classes)
    names = F.array(*[F.lit(c) for c in classes])
    own = F.array_position(names, F.col("label")) - 1
    top = F.array_max("scores")
    powers = F.transform("scores", lambda s: F.exp(s - top))
    residual = F.transform("e", lambda e, i: e / F.col("all") - F.when(i == own, 1.0).otherwise(0.0)).alias("r")

    def missed(scored: DataFrame, *columns: str) -> DataFrame:
        """Probability minus label, an array ``r`` over the classes."""
        return scored.withColumn("e", powers).withColumn("all", F.aggregate("e", F.lit(0.0), lambda a, x: a + x)).select(*columns, residual)

    weights, bias = None, [0.0] * k
    all_weights, biases, rows = [], [], []
    for epoch in range(params.epochs):
        if weights is None:  # all records score the same, so that a residual stands in the record's row
            residuals = with_features = missed(train.withColumn("scores", F.array(*[F.lit(b) for b in bias])), "features")
        else:
            residuals = materialise(missed(_scores(train, weights, bias, ["label"]), "record_id"), "residuals")
            with_features = train.select("record_id", "features").join(residuals.hint("shuffle_hash"), "record_id")
        total = residuals.agg(*[F.sum(F.get("r", F.lit(c))).alias(f"r{c}") for c in range(k)]).first()
        step = with_features.select("r", F.inline("features")).groupBy("feature")
        step = step.agg(_array(classes, lambda c: F.sum(F.col("x") * F.get("r", F.lit(c)))).alias("g"), F.count("*").alias("n"))
        joined = step.withColumn("w", _array(classes, lambda c: F.lit(0.0))) if weights is None else step.drop("n").join(weights, "feature")
        moved = F.zip_with("w", "g", lambda w, g: w - params.rate * (g / n + params.decay * w))
        weights = materialise(joined.select("feature", moved.alias("w"), "n"), "weights", f"{path}/epoch={epoch}")
        bias = [b - params.rate * total[f"r{c}"] / n for c, b in enumerate(bias)]
        scored = _scores(held.where("label is not null"), weights, bias, ["label"])
        told = scored.select(F.lit(epoch).alias("epoch"), F.col("label").alias("y_true"), _best_class(classes).alias("y_pred"))
        found = weighted_metrics(told, ["epoch"]).first()
        rows.append((epoch, *[float(found[m]) if found else 0.0 for m in METRICS]))
        all_weights.append(weights)
        biases.append(bias)
    at = 1 + METRICS.index(params.metric)
    best = max(range(params.epochs), key=lambda e: (round(rows[e][at], TIE_DIGITS), -e))
    history = train.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "epoch int, " + ", ".join(f"{m} double" for m in METRICS) + ", best boolean"
    )
    return SoftmaxModel(classes, all_weights, biases, history, best)


def text_features(documents: DataFrame, vocab: DataFrame, **params) -> DataFrame:
    """tf-idf weights of documents as ``(record_id, feature, x)``.

    The feature is the term, or the number that the vocabulary gives it in a column ``number``.
    """
    from .features import TfidfParams, count_table, weights_of

    chosen = TfidfParams(**params)
    found = weights_of(count_table(documents, chosen), vocab, chosen, name="number" if "number" in vocab.columns else "term")
    return found.select("record_id", F.col(found.columns[1]).alias("feature"), F.col("weight").alias("x"))


def vector_features(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """Dimensions of an array column as ``(record_id, feature, x)``."""
    return rows.select("record_id", F.posexplode(column).alias("feature", "x")).withColumn("x", F.col("x").cast("double"))
