"""Ranking of evaluated models, failed runs included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .metrics import METRICS


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"best metric must be one of {', '.join(METRICS)}, got {metric!r}")
    return metric


def leaderboard(
    metrics: DataFrame, metric: str = "f1", failed: DataFrame | None = None
) -> DataFrame:
    """Models by descending metric, null metrics last, ties by name.

    ``failed`` has columns ``(model_name, error)`` and adds rows without
    metrics. The table has one row per model, so ranking it is cheap.
    """
    check_metric(metric)
    rows = metrics.withColumn("error", F.lit(None).cast("string"))
    if failed is not None:
        rows = rows.unionByName(failed.select("model_name", "error"), allowMissingColumns=True)
    order = W.partitionBy(F.lit(1)).orderBy(F.desc_nulls_last(metric), "model_name")
    return rows.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def best_model(board: DataFrame, metric: str = "f1") -> DataFrame:
    """One row for the best model; its columns are null when every run failed."""
    check_metric(metric)
    usable = F.col(metric).isNotNull() & ~F.isnan(metric)
    order = F.struct(F.col(metric), -F.col("rank"))
    return board.agg(
        F.max_by(F.when(usable, F.col("model_name")), F.when(usable, order)).alias("model_name"),
        *[
            F.max_by(F.when(usable, F.col(m)), F.when(usable, order)).alias(m)
            for m in METRICS
        ],
    )


def evaluation_summary(board: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: how many models were evaluated and failed, and the best one."""
    failed = F.col("error").isNotNull()
    best = board.where(~failed & F.col(metric).isNotNull()).select("model_name", "rank")
    return board.agg(
        F.count("*").alias("total_models"),
        F.count_if(~failed).alias("successful_models"),
        F.count_if(failed).alias("failed_models"),
    ).withColumn("best_model", best.agg(F.min_by("model_name", "rank")).scalar())
