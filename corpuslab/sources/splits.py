"""Train/test splits, leaderboards and predictions on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .articles import export_csv


def write_split(split: DataFrame, path: str) -> None:
    """One table, one folder per split."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(
    spark: SparkSession, path: str, text_column: str = "text", label_column: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with the partition filter pushed to the file listing."""
    table = spark.read.parquet(path)
    missing = {text_column, label_column, "split"} - set(table.columns)
    if missing:
        raise ValueError(f"required columns not found: {sorted(missing)}")
    return (
        table.where(F.col("split") == "train").drop("split"),
        table.where(F.col("split") == "test").drop("split"),
    )


def write_leaderboard(board: DataFrame, summary: DataFrame, path: str) -> None:
    export_csv(board.coalesce(1), f"{path}/results")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/evaluation_summary")


def write_predictions(predictions: DataFrame, path: str, as_csv: bool = False) -> None:
    if as_csv:
        export_csv(predictions, path)
    else:
        predictions.write.mode("overwrite").parquet(path)
