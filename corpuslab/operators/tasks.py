"""Labelling tasks: built from articles, exported as JSON, pushed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import null_if_blank
from ..functions.text import strip

# Fixed value: default prefix of the external task id.
EXTERNAL_ID_PREFIX = "mc_story_"


def label_tasks(articles: DataFrame, prefix: str = EXTERNAL_ID_PREFIX) -> DataFrame:
    """One task per article with text; empty optional fields become null."""
    text = strip(F.col("text"))
    optional = [
        null_if_blank(F.col(name).cast("string")).alias(name)
        for name in ("title", "url", "language", "publish_date")
    ]
    return (
        articles.withColumn("text", text)
        .where(F.length("text") > 0)
        .select(
            F.struct("text", "story_id", *optional).alias("data"),
            F.concat(F.lit(prefix), "story_id").alias("external_id"),
        )
    )


def task_json(tasks: DataFrame) -> DataFrame:
    """One JSON document per task; null fields are left out."""
    return tasks.select(F.to_json(F.struct(*tasks.columns)).alias("value"))


def new_tasks(tasks: DataFrame, project: DataFrame, key: str = "story_id") -> DataFrame:
    """Tasks whose story is not in the project yet.

    Tasks without a story id are always kept. They bypass the join, so that
    many of them do not meet in one shuffle partition. Project tasks without an
    id count as the empty string.
    """
    existing = project.select(F.coalesce(key, F.lit("")).alias(key)).distinct()
    keyed = tasks.where(F.col(key).isNotNull()).join(existing, key, "left_anti")
    return tasks.where(F.col(key).isNull()).unionByName(keyed)
