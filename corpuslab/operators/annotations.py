"""Flattening of nested annotations into labelled and analysis records.

All of it happens inside the task row with array functions; the only row
expansion is one per annotation or label, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import first_truthy, flag, let
from ..functions.text import is_blank, strip

# Result types that carry labels, and the name of an unnamed control.
LABEL_TYPES = ("choices", "textarea")
DEFAULT_CONTROL = "label"

_NO_LABELS = "array<string>"


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit(""))


def _string_list(value: Column, path: str) -> Column:
    """List at ``path`` as strings, one level of nested lists flattened."""
    items = F.try_variant_get(value, path, "array<variant>")

    def spread(item: Column) -> Column:
        return F.when(
            _kind(item).startswith("ARRAY"), F.try_variant_get(item, "$", "array<string>")
        ).otherwise(F.array(F.try_variant_get(item, "$", "string")))

    return F.filter(F.flatten(F.transform(items, spread)), lambda s: s.isNotNull())


def labels_of_value(value: Column) -> Column:
    """Labels in a result value: choices, text, a bare list or a bare string."""
    choices = F.try_variant_get(value, "$.choices", "variant")
    text = F.try_variant_get(value, "$.text", "variant")
    none = F.array().cast(_NO_LABELS)
    return (
        F.when(choices.isNotNull(), F.coalesce(_string_list(value, "$.choices"), none))
        .when(_kind(text).startswith("ARRAY"), F.coalesce(_string_list(value, "$.text"), none))
        .when(text.isNotNull(), F.array(F.try_variant_get(value, "$.text", "string")))
        .when(_kind(value).startswith("ARRAY"), F.coalesce(_string_list(value, "$"), none))
        .when(_kind(value) == "STRING", F.array(F.try_variant_get(value, "$", "string")))
        .otherwise(none)
    )


def _annotation_rows(tasks: DataFrame) -> DataFrame:
    """One row per annotation of tasks that have text."""
    return (
        tasks.where(~is_blank(F.col("data.text")))
        .select("id", "data", F.posexplode_outer("annotations").alias("ann_pos", "ann"))
        .where(F.col("ann").isNotNull())
    )


def labelled_records(
    tasks: DataFrame, target_label: str | None = None, multi: bool = False
) -> DataFrame:
    """Training view: one row per annotation that carries labels.

    ``labels`` holds all of them when ``multi`` is set and the first otherwise;
    ``label`` is the first one in both cases.
    """
    collected = F.flatten(
        F.transform(
            F.filter(F.col("ann.result"), lambda r: r["type"].isin(*LABEL_TYPES)),
            lambda r: labels_of_value(r["value"]),
        )
    )
    if target_label is not None:
        wanted = target_label.lower()
        collected = F.filter(collected, lambda s: F.lower(s).contains(wanted))
    rows = (
        _annotation_rows(tasks)
        .where(~flag(F.col("ann.was_cancelled")))
        .withColumn("labels", collected)
        .where(F.size("labels") > 0)
    )
    kept = F.col("labels") if multi else F.slice("labels", 1, 1)
    empty = F.lit("")
    return rows.select(
        strip(F.col("data.text")).alias("text"),
        F.get("labels", F.lit(0)).alias("label"),
        kept.alias("labels"),
        F.col("id").alias("task_id"),
        "ann_pos",
        F.col("ann.id").alias("annotation_id"),
        *[
            F.coalesce(F.col(f"data.{c}"), empty).alias(c)
            for c in ("story_id", "title", "url", "language", "publish_date")
        ],
        F.coalesce("ann.completed_by", empty).alias("annotated_by"),
        F.coalesce("ann.created_at", empty).alias("annotated_at"),
    )


def label_distribution(records: DataFrame) -> DataFrame:
    """Number of occurrences of every label, all labels of multi-label records included."""
    return (
        records.select(F.explode_outer("labels").alias("label"))
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count("*").alias("n"))
    )


def skipped_tasks(tasks: DataFrame) -> DataFrame:
    """One row: tasks in total, and tasks without annotations or text."""
    empty = F.coalesce(F.size("annotations") <= 0, F.lit(True))
    return tasks.agg(
        F.count("*").alias("n_tasks"),
        F.count_if(empty | is_blank(F.col("data.text"))).alias("n_skipped"),
    )


def analysis_records(tasks: DataFrame) -> DataFrame:
    """Analysis view in long form: one row per annotation, control and distinct label.

    ``label_pos`` is the position of the label inside its control, first
    occurrence first. Only results whose ``choices`` is a list count.
    """

    def control_labels(result: Column) -> Column:
        control = first_truthy(result["from_name"], F.lit(DEFAULT_CONTROL))
        return F.transform(
            _string_list(result["value"], "$.choices"),
            lambda label: F.struct(control.alias("control"), label.alias("label")),
        )

    choices = F.filter(
        F.col("ann.result"),
        lambda r: (r["type"] == "choices")
        & _kind(F.try_variant_get(r["value"], "$.choices", "variant")).startswith("ARRAY"),
    )
    pairs = F.array_distinct(F.flatten(F.transform(choices, control_labels)))
    numbered = let(
        pairs,
        lambda all_pairs: F.transform(
            all_pairs,
            lambda p, i: F.struct(
                p["control"].alias("control"),
                F.size(
                    F.filter(F.slice(all_pairs, 1, i), lambda q: q["control"] == p["control"])
                ).alias("label_pos"),
                p["label"].alias("label"),
            ),
        ),
    )
    ann = F.col("ann")
    stopped = flag(ann["was_cancelled"]) | flag(ann["cancelled"]) | flag(ann["skipped"])
    return (
        _annotation_rows(tasks)
        .where(~stopped)
        .select(
            F.col("id").alias("task_id"),
            "ann_pos",
            F.coalesce("ann.completed_by", "ann.created_by", F.lit("")).alias("annotator"),
            F.coalesce("ann.lead_time", F.lit(0.0)).alias("lead_time"),
            F.inline_outer(numbered),
        )
        .where(F.col("label").isNotNull())
        .select("task_id", "ann_pos", "annotator", "control", "label_pos", "label", "lead_time")
    )


def require_labels(long: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Keep the listed labels only; emptied controls and records disappear by themselves."""
    return long.where(F.col("label").isin(list(labels)))
