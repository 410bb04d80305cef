"""Annotation exports and analysis reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import ANNOTATED_TASK
from .articles import export_csv


def read_annotated_tasks(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Exported tasks with annotations; ``multi_line`` for one JSON array per file."""
    return spark.read.schema(ANNOTATED_TASK).option("multiLine", multi_line).json(path)


def write_agreement_report(report: DataFrame, path: str) -> None:
    """Task-by-control report as CSV; the label distribution becomes text."""
    flat = report.withColumn(
        "control_label_distribution", F.to_json("control_label_distribution")
    )
    export_csv(flat, path)


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """Every analysis section as JSON lines in its own folder."""
    for name, table in sections.items():
        table.write.mode("overwrite").json(f"{path}/{name}")
