"""Annotation analysis and inter-annotator agreement.

Input is the long form ``(task_id, ann_pos, annotator, control, label_pos,
label, lead_time)`` after the required-label filter. Ratings stay long all the
way; a subject or rater with very many ratings is folded by map-side partial
aggregation before anything is grouped by subject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.columns import agreement_band, report_round
from ..session import materialise
from .selection import value_at_ranks


def records_of(long: DataFrame) -> DataFrame:
    """One row per annotation."""
    return long.groupBy("task_id", "ann_pos", "annotator").agg(F.max("lead_time").alias("lead_time"))


def first_labels(long: DataFrame) -> DataFrame:
    """First remaining label of every annotation and control."""
    return long.groupBy("task_id", "ann_pos", "annotator", "control").agg(
        F.min_by("label", "label_pos").alias("label")
    )


def _records_per_task(long: DataFrame) -> DataFrame:
    return (
        long.select("task_id", "ann_pos")
        .distinct()
        .groupBy("task_id")
        .agg(F.count("*").alias("n_records"))
    )


def project_summary(long: DataFrame) -> DataFrame:
    """One row of task, annotation and annotator counts."""
    annotators = long.select("annotator").distinct().agg(F.count("*")).scalar()
    return (
        _records_per_task(long)
        .agg(
            F.count("*").alias("total_tasks"),
            F.coalesce(F.sum("n_records"), F.lit(0)).alias("total_annotations"),
            F.count_if(F.col("n_records") > 1).alias("tasks_with_multiple_annotations"),
        )
        .withColumn("unique_annotators", annotators)
        .withColumn(
            "average_annotations_per_task",
            report_round(F.try_divide("total_annotations", "total_tasks"), 2),
        )
    )


def tasks_with_several_raters(long: DataFrame) -> DataFrame:
    """One row: tasks rated by more than one person, as opposed to more than once."""
    return (
        long.select("task_id", "annotator")
        .distinct()
        .groupBy("task_id")
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("n_tasks"))
    )


def annotator_counts(long: DataFrame) -> DataFrame:
    """Annotations per annotator with the position at which the annotator first appears."""
    return (
        long.select("task_id", "ann_pos", "annotator")
        .distinct()
        .groupBy("annotator")
        .agg(
            F.count("*").alias("n_annotations"),
            F.min(F.struct("task_id", "ann_pos")).alias("first_seen"),
        )
    )


def annotator_extremes(counts: DataFrame) -> DataFrame:
    """One row: most active (ties: first seen) and least active (ties: last seen) annotator."""
    seen = [-F.col("first_seen.task_id"), -F.col("first_seen.ann_pos")]
    most = F.struct("n_annotations", *seen)
    return counts.agg(
        F.max_by("annotator", most).alias("most_active"),
        F.max("n_annotations").alias("most_n"),
        F.min_by("annotator", most).alias("least_active"),
        F.min("n_annotations").alias("least_n"),
    )


def label_grouping_sets(long: DataFrame) -> DataFrame:
    """Label counts overall, per control and per annotator and control, in one pass."""
    label, control, annotator = F.col("label"), F.col("control"), F.col("annotator")
    return long.groupingSets(
        [[label], [control, label], [annotator, control, label]], annotator, control, label
    ).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def label_schema(long: DataFrame) -> DataFrame:
    """Sorted labels of every control."""
    return (
        long.select("control", "label")
        .distinct()
        .groupBy("control")
        .agg(F.sort_array(F.collect_list("label")).alias("labels"))
    )


def label_shares(long: DataFrame) -> DataFrame:
    """Count and percentage of every label, most frequent first."""
    counts = long.groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(F.desc("n"), "label")


def lead_time_stats(long: DataFrame) -> DataFrame:
    """Mean, interpolated median, minimum and maximum of the positive lead times."""
    times = records_of(long).where(F.col("lead_time") > 0)
    # One scan: everything follows from the number of records of each time.
    counts = materialise(times.groupBy("lead_time").agg(F.count("*").alias("_m")), "lead-times")
    ranks = [F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1]
    middle = value_at_ranks(counts, "lead_time", ranks, weight="_m")
    return counts.agg(
        (F.sum(F.col("lead_time") * F.col("_m")) / F.sum("_m")).alias("average_lead_time"),
        F.min("lead_time").alias("min_lead_time"),
        F.max("lead_time").alias("max_lead_time"),
    ).withColumn("median_lead_time", middle.agg(F.avg("lead_time")).scalar())


def simple_agreement(long: DataFrame) -> DataFrame:
    """Majority agreement of every multi-annotated task and every known control.

    A control nobody used on a task appears with a null ratio and with
    ``num_annotators`` equal to the number of annotations of the task.
    """
    per_label = (
        first_labels(long)
        .groupBy("task_id", "control", "label")
        .agg(F.count("*").alias("n"), F.min("ann_pos").alias("first_pos"))
    )
    per_control = per_label.groupBy("task_id", "control").agg(
        F.sum("n").alias("n_valid"),
        F.max("n").alias("n_top"),
        F.count("*").alias("n_labels"),
        F.max_by("label", F.struct("n", -F.col("first_pos"))).alias("most_common_label"),
        F.sort_array(F.collect_list(F.struct("label", "n"))).alias("label_distribution"),
    )
    controls = long.select("control").distinct().agg(F.collect_list("control")).scalar()
    grid = (
        _records_per_task(long)
        .where(F.col("n_records") > 1)
        .select("task_id", "n_records", F.explode_outer(controls).alias("control"))
    )
    return grid.join(per_control, ["task_id", "control"], "left").select(
        "task_id",
        "control",
        "n_records",
        F.coalesce("n_valid", "n_records").alias("num_annotators"),
        (F.col("n_top") / F.col("n_valid")).alias("agreement_ratio"),
        F.coalesce(F.col("n_labels") == 1, F.lit(False)).alias("all_agree"),
        "most_common_label",
        "label_distribution",
    )


def task_agreement(simple: DataFrame, strict: bool = False) -> DataFrame:
    """Mean rounded control ratio and disagreement flag per task.

    By default a control nobody used on the task counts as disagreement;
    ``strict`` ignores such controls.
    """
    differs = (F.col("num_annotators") > 1) & ~F.col("all_agree")
    if strict:
        differs = differs & F.col("agreement_ratio").isNotNull()
    return simple.groupBy("task_id").agg(
        F.max("n_records").alias("num_annotators"),
        report_round(F.avg(report_round(F.col("agreement_ratio"), 3)), 3).alias(
            "overall_simple_agreement"
        ),
        F.bool_or(differs).alias("has_disagreement"),
    )


def agreement_summary(per_task: DataFrame) -> DataFrame:
    overall = F.col("overall_simple_agreement")
    return per_task.agg(
        F.count("*").alias("n_tasks"),
        F.avg(overall).alias("mean_agreement"),
        F.min(overall).alias("min_agreement"),
        F.max(overall).alias("max_agreement"),
        F.count_if("has_disagreement").alias("n_disagreement"),
    )


def ratings(long: DataFrame) -> DataFrame:
    """Ratings ``(control, subject, rater, ann_pos, label)`` of multi-annotated tasks."""
    several = _records_per_task(long).where(F.col("n_records") > 1).select("task_id")
    return (
        first_labels(long)
        .join(several, "task_id", "left_semi")
        .select(
            "control",
            F.col("task_id").alias("subject"),
            F.col("annotator").alias("rater"),
            "ann_pos",
            "label",
        )
    )


def _last_ratings(rated: DataFrame) -> DataFrame:
    """Last rating of each rater on a subject, with the number of ratings it replaces.

    The coefficients need to know which labels are equal, not what they say. Labels are numbered, one
    row each of a written table, so the aggregation buffers have a fixed width and Spark aggregates by hash instead of by sort.
    """
    numbered = W.partitionBy(F.lit(1)).orderBy("label")
    labels = materialise(rated.select("label").distinct().withColumn("label_id", F.row_number().over(numbered).cast("long")), "labels")
    return (
        rated.join(labels.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
        .select("control", "subject", "rater", F.col("label_id").alias("label"), "ann_pos")
        .groupBy("control", "subject", "rater")
        .agg(F.max_by("label", "ann_pos").alias("label"), F.count("*").alias("n_ann"))
    )


def _label_counts(rated: DataFrame) -> DataFrame:
    """Raters per subject and label (``n_uk``) and per subject (``m_u``).

    Only subjects with at least two annotations stay. The window sees one row
    per label of a subject, however many raters there are.
    """
    per_label = (
        _last_ratings(rated)
        .groupBy("control", "subject", "label")
        .agg(F.count("*").alias("n_uk"), F.sum("n_ann").alias("_ann"))
    )
    subject = W.partitionBy("control", "subject")
    return (
        per_label.select(
            "control",
            "subject",
            "label",
            "n_uk",
            F.sum("n_uk").over(subject).alias("m_u"),
            F.sum("_ann").over(subject).alias("_ann"),
            (F.min("label").over(subject) == F.col("label")).alias("is_head"),
        )
        .where(F.col("_ann") >= 2)
        .drop("_ann")
    )


def chance_corrected(rated: DataFrame) -> DataFrame:
    """Krippendorff's alpha (nominal) and Gwet's AC1 per control, from one pass.

    Null when fewer than two distinct labels were used.
    """
    n, m = F.col("n_uk"), F.col("m_u")
    paired = m >= 2
    per_label = (
        _label_counts(rated)
        .groupBy("control", "label")
        .agg(
            F.sum(F.when(paired, n).otherwise(0)).alias("n_k"),
            F.sum(F.when(paired, n * (m - n) / (m - 1)).otherwise(0.0)).alias("observed"),
            F.sum(F.when(paired, n * (n - 1) / (m * (m - 1))).otherwise(0.0)).alias("pairs"),
            F.sum(n / m).alias("share"),
            F.count_if("is_head").alias("subjects"),
            F.count_if(F.col("is_head") & paired).alias("paired_subjects"),
        )
    )
    control = W.partitionBy("control")
    totals = per_label.withColumn("n_all", F.sum("n_k").over(control)).withColumn(
        "pi", F.col("share") / F.sum("subjects").over(control)
    )
    sums = totals.groupBy("control").agg(
        F.count("*").alias("q"),
        F.sum("n_k").alias("n"),
        F.sum("observed").alias("observed"),
        F.sum(F.col("n_k").cast("double") * (F.col("n_all") - F.col("n_k"))).alias("expected"),
        F.sum("pairs").alias("pairs"),
        F.sum("paired_subjects").alias("paired_subjects"),
        F.sum(F.col("pi") * (1 - F.col("pi"))).alias("spread"),
    )
    pa = F.try_divide(F.col("pairs"), F.col("paired_subjects"))
    pe = F.try_divide(F.col("spread"), F.col("q") - 1)
    enough = F.col("q") >= 2
    return sums.select(
        "control",
        F.when(
            enough, 1 - F.try_divide((F.col("n") - 1) * F.col("observed"), F.col("expected"))
        ).alias("krippendorff_alpha"),
        F.when(enough, F.try_divide(pa - pe, 1 - pe)).alias("gwet_ac1"),
    )


def cohen_kappa(rated: DataFrame) -> DataFrame:
    """Cohen's kappa per control; null unless the control has exactly two raters."""
    last = _last_ratings(rated)
    raters = (
        last.select("control", "rater").distinct().groupBy("control").agg(F.count("*").alias("n_raters"))
    )
    both = (
        last.groupBy("control", "subject")
        .agg(
            F.count("*").alias("n"),
            F.min_by("label", "rater").alias("a"),
            F.max_by("label", "rater").alias("b"),
        )
        .where(F.col("n") == 2)
    )
    cells = both.groupBy("control", "a", "b").agg(F.count("*").alias("n"))
    agreed = cells.groupBy("control").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"),
    )
    marginals = (
        cells.select(
            "control",
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("label"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb")),
                    F.struct(F.col("b").alias("label"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb")),
                )
            ),
        )
        .groupBy("control", "label")
        .agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
        .groupBy("control")
        .agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("cross"), F.count("*").alias("q"))
    )
    # One partial row per control from each side, put together by grouping.
    parts = raters.unionByName(agreed, allowMissingColumns=True).unionByName(
        marginals, allowMissingColumns=True
    )
    names = [c for c in parts.columns if c != "control"]
    merged = parts.groupBy("control").agg(*[F.max(c).alias(c) for c in names])
    po = F.col("same") / F.col("total")
    pe = F.col("cross") / F.col("total") / F.col("total")
    usable = (F.col("n_raters") == 2) & (F.col("q") >= 2)
    return merged.select(
        "control", F.when(usable, F.try_divide(po - pe, 1 - pe)).alias("cohen_kappa")
    )


def agreement_metrics(long: DataFrame) -> DataFrame:
    """Alpha, AC1 and kappa per control; controls without any value are left out."""
    rated = ratings(long)
    joined = chance_corrected(rated).join(cohen_kappa(rated), "control", "left")
    return joined.where(
        F.coalesce("krippendorff_alpha", "gwet_ac1", "cohen_kappa").isNotNull()
    )


def with_bands(metrics: DataFrame) -> DataFrame:
    """Long form ``(control, metric, value, band)`` of the agreement coefficients."""
    return metrics.unpivot(
        ["control"],
        ["krippendorff_alpha", "gwet_ac1", "cohen_kappa"],
        "metric",
        "value",
    ).where(F.col("value").isNotNull()).withColumn("band", agreement_band(F.col("value")))


def agreement_report(simple: DataFrame, per_task: DataFrame) -> DataFrame:
    """Flat task-by-control table with the task columns repeated and ``control_`` prefixes."""
    details = simple.select(
        "task_id",
        "control",
        *[
            F.col(c).alias(f"control_{c}")
            for c in (
                "num_annotators",
                "agreement_ratio",
                "all_agree",
                "most_common_label",
                "label_distribution",
            )
        ],
    )
    return per_task.join(details, "task_id")
