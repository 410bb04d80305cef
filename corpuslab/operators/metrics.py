"""Classification metrics from confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import share

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion(predictions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Rows per (model, true label, predicted label)."""
    return predictions.groupBy(
        *by,
        F.col("y_true").cast("string").alias("y_true"),
        F.col("y_pred").cast("string").alias("y_pred"),
    ).agg(F.count("*").alias("n"))


def class_metrics(counts: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Precision, recall and F1 per class, 0 where undefined."""
    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(none)
    roles = F.array(
        F.struct(F.col("y_true").alias("label"), n.alias("support"), none.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("y_pred").alias("label"), none.alias("support"), n.alias("predicted"), none.alias("tp")),
    )
    per_class = (
        counts.select(*by, F.inline(roles))
        .groupBy(*by, "label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("tp").alias("tp"),
        )
    )
    precision = share(F.col("tp"), F.col("predicted"))
    recall = share(F.col("tp"), F.col("support"))
    return (
        per_class.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn(
            "f1",
            share(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )


def weighted_metrics(predictions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 of every model at once."""
    per_class = class_metrics(confusion(predictions, by), by)
    support = F.sum("support")

    def weighted(name: str):
        return (F.sum(F.col(name) * F.col("support")) / support).alias(name)

    return per_class.groupBy(*by).agg(
        (F.sum("tp") / support).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
        support.alias("n_rows"),
    )
