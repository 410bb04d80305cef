"""Linear text and vector classifiers, trained by Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    HashingTF,
    IDF,
    IndexToString,
    Normalizer,
    RegexTokenizer,
    StringIndexer,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..functions.text import token_regex, DEFAULT_TOKEN_PATTERN


@dataclass(frozen=True)
class LinearParams:
    """``max_iter`` plays the part of epochs, ``reg`` that of weight decay."""

    max_iter: int = 20
    reg: float = 0.01
    n_features: int = 1 << 18
    batch_size: int = 32


def _classifier(params: LinearParams) -> list:
    indexer = StringIndexer(
        inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="label_index",
        family="multinomial",
        maxIter=params.max_iter,
        regParam=params.reg,
    )
    return [indexer, lr]


def _with_vector(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col(column)))


def fit_linear_vectors(
    train: DataFrame, column: str = "embedding", params: LinearParams = LinearParams()
) -> PipelineModel:
    """Multinomial logistic regression on an array column. Runs jobs."""
    rows = _with_vector(train.withColumn("label", F.col("label").cast("string")), column)
    return _finish(Pipeline(stages=_classifier(params)).fit(rows))


def fit_linear_text(train: DataFrame, params: LinearParams = LinearParams()) -> PipelineModel:
    """Logistic regression on hashed, idf-weighted, normalised terms. Runs jobs."""
    regex, _ = token_regex(DEFAULT_TOKEN_PATTERN)
    stages = [
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=regex, gaps=False),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=params.n_features),
        IDF(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
        *_classifier(params),
    ]
    return _finish(Pipeline(stages=stages).fit(train))


def _finish(model: PipelineModel) -> PipelineModel:
    """Append the step that turns class indexes back into labels."""
    labels = next(s.labels for s in model.stages if hasattr(s, "labels"))
    back = IndexToString(inputCol="prediction", outputCol="y_pred", labels=[*labels, "__unknown"])
    return PipelineModel([*model.stages, back])


def predict_linear(
    model: PipelineModel, rows: DataFrame, column: str | None = None, keep: tuple[str, ...] = ("record_id",)
) -> DataFrame:
    """``(*keep, y_pred)``; ``column`` names the array column of a vector model."""
    prepared = _with_vector(rows, column) if column else rows
    return model.transform(prepared.withColumn("label", F.lit(None).cast("string"))).select(
        *keep, "y_pred"
    )


def write_centroids(train: DataFrame, path: str, column: str = "embedding") -> str:
    """Write the nearest-centroid model ``(label, weights, bias)``, one row a class, for ``scoring.score_folder``. Runs one job.

    The means are folded by class and dimension and never leave the executors.
    """
    per_dim = (
        train.select("label", F.posexplode(column).alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg("x").alias("x"))
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"])
    means = per_dim.groupBy("label").agg(listed.alias("weights"))
    bias = F.aggregate("weights", F.lit(0.0), lambda total, x: total - 0.5 * x * x)
    means.select("label", "weights", bias.alias("bias")).write.parquet(path)
    return path
