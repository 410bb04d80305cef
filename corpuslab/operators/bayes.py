"""Multinomial Naive Bayes on TF-IDF weights, fitted and scored as DataFrame algebra.

Fitting writes three parameter tables. They cut the lineage, and their file
sizes tell Spark whether they fit a broadcast.

With ``N_ct`` the weight of term t in class c, ``N_c`` its sum and V the
vocabulary size, the log-likelihood is ``ln((N_ct + a) / (N_c + a V))``. For pairs
never seen together it is ``ln a - ln(N_c + a V)``, so a document scores

    log_prior_c + (sum_t w_t) (ln a - ln(N_c + a V)) + sum_seen w_t (ln(N_ct + a) - ln a)

and only observed pairs are stored and joined.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.columns import same_keys
from ..session import materialise, new_run_dir
from .features import HEAD_TERMS, TfidfParams, count_table, document_count, join_terms, tf_value, vocabulary, weights_of

# Pseudo class that collects the total weight of a document.
TOTAL_CLASS = -1
#: Class and term pairs that are broadcast at most.
HEAD_PAIRS = 1_000_000
# Scores are compared after rounding, so equal sums in another order stay equal.
TIE_DIGITS = 9


@dataclass(frozen=True)
class NaiveBayesParams:
    alpha: float = 1.0
    fit_prior: bool = True
    class_prior: Sequence[float] | None = None

    def __post_init__(self) -> None:
        if not self.alpha > 0:
            raise ValueError(f"alpha must be positive, got {self.alpha}")


def params_from_mapping(values: Mapping) -> tuple[TfidfParams, NaiveBayesParams]:
    """Split a flat parameter mapping; unknown names are an error."""
    own = {f.name for f in fields(NaiveBayesParams)}
    bayes = {k: v for k, v in values.items() if k in own}
    return (
        TfidfParams.from_mapping({k: v for k, v in values.items() if k not in own}),
        NaiveBayesParams(**bayes),
    )


def encode_labels(*label_frames: DataFrame, label_column: str = "label") -> DataFrame:
    """``(label, class_id)``: dense rank of the sorted distinct labels of all frames."""
    labels = None
    for frame in label_frames:
        part = frame.select(F.col(label_column).alias("label"))
        labels = part if labels is None else labels.unionByName(part)
    distinct = labels.where(F.col("label").isNotNull()).distinct()
    # One row per class reaches the window.
    order = W.partitionBy(F.lit(1)).orderBy("label")
    return distinct.withColumn("class_id", F.row_number().over(order) - 1)


def decode_labels(predictions: DataFrame, classes: DataFrame, column: str = "class_id") -> DataFrame:
    """Replace a class id by its label."""
    side = classes.select(F.col("class_id").alias(column), "label")
    return predictions.join(side, column, "left").drop(column)


def term_sums(weights: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """``N_ct``: weight per class and term, with the idf of the term.

    Common terms fold on the map side.
    """
    return weights.groupBy(*by, "term").agg(
        F.sum("weight").alias("n_ct"), F.max("idf").alias("idf")
    )


def class_table(
    train: DataFrame, sums: DataFrame, vocab_size: Column, params: NaiveBayesParams
) -> DataFrame:
    """``(class_id, label, n_docs, n_c, log_prior, base)`` of the training classes."""
    docs = train.where(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n_docs"))
    totals = sums.groupBy("label").agg(F.sum("n_ct").alias("n_c"))
    everything = W.partitionBy(F.lit(1))
    ranked = docs.join(totals, "label", "left").select(
        (F.row_number().over(everything.orderBy("label")) - 1).alias("class_id"),
        "label",
        "n_docs",
        F.coalesce("n_c", F.lit(0.0)).alias("n_c"),
        (F.sum("n_docs").over(everything)).alias("_n"),
        (F.count("*").over(everything)).alias("_k"),
    )
    if params.class_prior is not None:
        given = F.array(*[F.lit(float(p)) for p in params.class_prior])
        prior = F.log(F.element_at(given, F.col("class_id") + 1))
    elif params.fit_prior:
        prior = F.log(F.col("n_docs") / F.col("_n"))
    else:
        prior = -F.log(F.col("_k").cast("double"))
    a = float(params.alpha)
    return ranked.select(
        "class_id",
        "label",
        "n_docs",
        "n_c",
        prior.alias("log_prior"),
        (F.log(F.lit(a)) - F.log(F.col("n_c") + a * vocab_size)).alias("base"),
    )


def score_sums(
    documents: DataFrame,
    vocab: DataFrame,
    gains: DataFrame,
    features: TfidfParams,
    keep: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Aggregates ``sums`` per document and class over the terms of the documents.

    ``gains`` has rows ``(term, idf, class_id, ...)`` of observed pairs. Every
    vocabulary term is added once more under the total class with nulls, so the
    document totals come out of the same join. Documents without a known term
    stay, with a null class. The terms of a document are folded before the
    shuffle. The pairs of a term are packed into one row of a written table, so that a
    token is joined once, whatever the number of classes; frequent terms are joined by broadcast
    (``features.join_terms``), as many as hold ``HEAD_PAIRS`` pairs at most.
    """
    counts = count_table(documents, features, keep)
    totals = vocab.select("term", "idf", F.lit(TOTAL_CLASS).alias("class_id"))
    pairs = gains.unionByName(totals, allowMissingColumns=True)
    packed = F.collect_list(F.struct(*[c for c in pairs.columns if c not in ("term", "idf")]))
    scorer = pairs.groupBy("term").agg(F.first("idf").alias("idf"), packed.alias("_pairs"))
    scorer = materialise(scorer.join(vocab.select("term", "df"), "term"), "scorer")
    widest = scorer.agg(F.max(F.size("_pairs"))).first()[0] or 1
    terms = counts.select(*keep, F.inline("counts"))
    weighted = (
        join_terms(terms, scorer, head_rows=max(1, min(HEAD_TERMS, HEAD_PAIRS // widest)))
        .withColumn("w", tf_value(features) * F.col("idf"))
        .select(*keep, "w", F.inline("_pairs"))
    )
    found = weighted.groupBy(*keep, "class_id").agg(*[c.alias(n) for n, c in sums.items()])
    every = counts.select(*keep).distinct()
    return every.join(found, same_keys(every, found, keep), "left").select(*[every[c] for c in keep], "class_id", *sums)


@dataclass(frozen=True)
class NaiveBayesModel:
    """Fitted model: parameter tables plus the parameters that made them."""

    vocab: DataFrame
    sums: DataFrame
    classes: DataFrame
    features: TfidfParams
    params: NaiveBayesParams
    n_terms: int
    path: str | None = None

    def info(self) -> dict:
        """Parameters and sizes. Runs a small job over the class table."""
        rows = self.classes.orderBy("class_id").select("label", "n_docs").collect()
        return {
            "model_type": "naive_bayes",
            "num_labels": len(rows),
            "label_classes": [r["label"] for r in rows],
            "training_samples": sum(r["n_docs"] for r in rows),
            "hyperparameters": {**self.features.as_dict(), **asdict(self.params)},
        }

    def log_likelihood(self) -> DataFrame:
        """Dense ``(label, term, log_lik)``: every class with every vocabulary term."""
        a = float(self.params.alpha)
        classes = self.classes.agg(
            F.collect_list(F.struct("label", "base"))
        ).scalar()
        grid = self.vocab.select("term", F.inline_outer(classes))
        return grid.join(self.sums, ["label", "term"], "left").select(
            "label",
            "term",
            (
                F.col("base")
                + F.log(F.coalesce("n_ct", F.lit(0.0)) + a)
                - F.log(F.lit(a))
            ).alias("log_lik"),
        )

    def score(self, documents: DataFrame, keep: Sequence[str] = ("record_id",)) -> DataFrame:
        """``(*keep, scores array<struct<class_id, label, score>>)`` of any documents.

        Documents without a known term get the priors. Norms are divided out
        after summing, so there is one join per term and one aggregate that
        folds the terms of a document before the shuffle.
        """
        a = float(self.params.alpha)
        gains = self.sums.join(self.classes.select("label", "class_id"), "label").select(
            "term", "idf", "class_id", (F.log(F.col("n_ct") + a) - F.log(F.lit(a))).alias("delta")
        )
        w = F.col("w")
        sums = score_sums(
            documents,
            self.vocab,
            gains,
            self.features,
            keep,
            {"s": F.sum(w * F.coalesce("delta", F.lit(1.0))), "sq": F.sum(w * w)},
        )
        is_total = F.col("class_id") == TOTAL_CLASS
        found = sums.groupBy(*keep).agg(
            F.map_from_entries(
                F.collect_list(F.when(F.col("class_id").isNotNull(), F.struct("class_id", "s")))
            ).alias("s"),
            F.max(F.when(is_total, F.col("s"))).alias("w"),
            F.max(F.when(is_total, F.col("sq"))).alias("sq"),
        )
        size = {"l2": F.sqrt("sq"), "l1": F.col("w"), None: F.lit(1.0)}[self.features.norm]
        classes = self.classes.agg(
            F.sort_array(F.collect_list(F.struct("class_id", "label", "log_prior", "base")))
        ).scalar()
        known = found.withColumn("_size", size).withColumn("_classes", classes)

        def one(c: Column) -> Column:
            seen = F.coalesce(F.try_element_at("s", c["class_id"]), F.lit(0.0))
            gain = F.coalesce((c["base"] * F.col("w") + seen) / F.col("_size"), F.lit(0.0))
            return F.struct(
                c["class_id"].alias("class_id"),
                c["label"].alias("label"),
                (c["log_prior"] + gain).alias("score"),
            )

        return known.select(*keep, F.transform("_classes", one).alias("scores"))

    def predict(self, documents: DataFrame, keep: Sequence[str] = ("record_id",)) -> DataFrame:
        """``(*keep, y_pred)``: the best class, ties to the lowest class."""
        best = F.array_max(
            F.transform(
                "scores",
                lambda c: F.struct(
                    F.round(c["score"], TIE_DIGITS), -c["class_id"], c["label"].alias("label")
                ),
            )
        )
        return self.score(documents, keep).select(*keep, best["label"].alias("y_pred"))

    def predict_proba(self, documents: DataFrame, keep: Sequence[str] = ("record_id",)) -> DataFrame:
        """``(*keep, label, probability)``: softmax of the scores, one row per class."""
        scored = self.score(documents, keep)
        top = F.array_max(F.transform("scores", lambda c: c["score"]))
        shifted = scored.withColumn("_top", top).withColumn(
            "_e", F.transform("scores", lambda c: F.exp(c["score"] - F.col("_top")))
        )
        total = F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x)
        probabilities = F.transform(
            F.col("scores"),
            lambda c, i: F.struct(
                c["label"].alias("label"), (F.get("_e", i) / F.col("_sum")).alias("probability")
            ),
        )
        return shifted.withColumn("_sum", total).select(*keep, F.inline_outer(probabilities))

    def transform(self, documents: DataFrame, keep: Sequence[str] = ("record_id",)) -> DataFrame:
        """Recipe contract: predictions of the documents."""
        return self.predict(documents, keep)

    def save(self, path: str) -> None:
        """Write the tables and the parameters to ``path``. Runs jobs.

        The model's own folder is left as it is; any other folder that exists is refused, since a
        model may not be replaced under its readers.
        """
        if self.path is not None and path.rstrip("/") == self.path.rstrip("/"):
            return
        for name, table in (("vocab", self.vocab), ("sums", self.sums), ("classes", self.classes)):
            table.write.mode("errorifexists").parquet(f"{path}/{name}")


def _params_text(features: TfidfParams, params: NaiveBayesParams) -> str:
    return json.dumps({**features.as_dict(), **asdict(params)})


def load_model(spark: SparkSession, path: str) -> NaiveBayesModel:
    """Open a model written by ``fit`` or ``save``."""
    classes = spark.read.parquet(f"{path}/classes")
    row = classes.select("params").first()
    if row is None:
        raise ValueError(f"the model at {path} has no classes")
    features, params = params_from_mapping(json.loads(row["params"]))
    vocab, sums = (spark.read.parquet(f"{path}/{name}") for name in ("vocab", "sums"))
    return NaiveBayesModel(
        vocab=vocab,
        sums=sums,
        classes=classes,
        features=features,
        params=params,
        n_terms=vocab.count(),
        path=path,
    )


def fit(
    train: DataFrame,
    features: TfidfParams = TfidfParams(),
    params: NaiveBayesParams = NaiveBayesParams(),
    path: str | None = None,
) -> NaiveBayesModel:
    """Fit on ``(record_id, text, label)`` and write the model to ``path``. Runs jobs.

    Without a path the model goes to a new folder below ``spark.checkpoint.dir``.
    """
    path = path or new_run_dir(train.sparkSession, "naive-bayes")
    labelled = train.where(F.col("label").isNotNull() & F.col("text").isNotNull())
    counts = count_table(labelled, features, ("record_id", "label"))
    counted = counts.select(F.inline("counts"))
    vocab = materialise(
        vocabulary(counted, document_count(counts), features), "vocab", f"{path}/vocab"
    )
    n_terms = vocab.count()
    weights = weights_of(counts, vocab, features, ("record_id", "label"))
    sums = materialise(term_sums(weights), "sums", f"{path}/sums")
    classes = class_table(counts, sums, F.lit(n_terms), params).withColumn(
        "params", F.lit(_params_text(features, params))
    )
    return NaiveBayesModel(
        vocab=vocab,
        sums=sums,
        classes=materialise(classes, "classes", f"{path}/classes"),
        features=features,
        params=params,
        n_terms=n_terms,
        path=path,
    )
