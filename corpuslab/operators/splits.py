"""Exact, seeded, stratified train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import materialise
from .selection import at_or_before, boundary_buckets, hash_bucket

# Default seed and share of training rows.
DEFAULT_SEED = 42
DEFAULT_RATIO = 0.8


def split_key(record_id: Column, seed: int = DEFAULT_SEED) -> Column:
    """Position of a record in the seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(record_id.cast("string"), F.lit(""))))


def class_quotas(counts: DataFrame, ratio: float) -> DataFrame:
    """Training rows per stratum: ``(label, stratum, quota)``.

    ``counts`` has one row per class ``(label, n)``. Quotas are proportional,
    and what rounding leaves over goes to the largest remainders, ties by
    label. If the rarest class has a single row, all classes share one stratum.
    The windows run over the class list only.
    """
    everything = W.partitionBy(F.lit(1))
    n, total = F.col("n"), F.col("_total")
    sized = (
        counts.withColumn("_total", F.sum("n").over(everything))
        .withColumn("_plain", F.min("n").over(everything) < 2)
        .withColumn("_train", F.floor(F.lit(ratio) * total))
        .withColumn("_exact", F.col("_train") * n / total)
        .withColumn("_base", F.floor(F.col("_train") * n / total))
        .withColumn("_rest", F.round(F.col("_exact") - F.col("_base"), 9))
    )
    by_rest = W.partitionBy(F.lit(1)).orderBy(F.desc("_rest"), "label")
    spread = sized.withColumn(
        "_left", F.col("_train") - F.sum("_base").over(everything)
    ).withColumn("_order", F.row_number().over(by_rest))
    stratified = F.col("_base") + (F.col("_order") <= F.col("_left")).cast("long")
    return spread.select(
        "label",
        F.when(F.col("_plain"), F.lit("all")).otherwise(F.concat(F.lit("class:"), "label")).alias(
            "stratum"
        ),
        F.when(F.col("_plain"), F.col("_train")).otherwise(stratified).alias("quota"),
    )


def _cut_keys(keyed: DataFrame, ratio: float) -> DataFrame:
    """Last training key per class ``(_label, cut__key, cut__unit)``, nulls for an empty quota.

    ``keyed`` is ``(label, _unit, _key, bucket)``. The histogram by class and
    bucket is written, so the input is read once for it and once more for the
    rows of the boundary buckets.
    """
    histogram = materialise(
        keyed.groupBy("label", "bucket").agg(F.count("*").alias("n")), "split-histogram"
    )
    strata = class_quotas(histogram.groupBy("label").agg(F.sum("n").alias("n")), ratio)
    by_stratum = (
        histogram.join(strata.select("label", "stratum"), "label")
        .groupBy("stratum", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    quotas = strata.groupBy("stratum").agg(F.max("quota").alias("quota"))
    # Written, so that Spark knows its size before it joins the rows of all classes with it.
    bounds = materialise(
        strata.select("label", "stratum").join(
            boundary_buckets(by_stratum, "stratum", quotas), "stratum", "left"
        ),
        "split-bounds",
    )
    within = W.partitionBy("stratum").orderBy("_key", "_unit")
    cuts = (
        keyed.join(bounds, ["label", "bucket"])
        .select("stratum", "rank", "_key", "_unit", F.row_number().over(within).alias("_rn"))
        .where(F.col("_rn") == F.col("rank"))
        .select("stratum", F.col("_key").alias("cut__key"), F.col("_unit").alias("cut__unit"))
    )
    return strata.join(cuts, "stratum", "left").select(
        F.col("label").alias("_label"), "cut__key", "cut__unit"
    )


def stratified_split(
    records: DataFrame,
    ratio: float = DEFAULT_RATIO,
    seed: int = DEFAULT_SEED,
    id_column: str = "record_id",
    label_column: str = "label",
    group_by: str | None = None,
) -> DataFrame:
    """Add ``split`` = train/test with exact class quotas. Runs two narrow jobs.

    The full rows are never shuffled: two passes over id and label find the
    last training key of every class, that class-sized table is written, and
    the rows are then compared with it in their scan. Rows without a label get
    a null split. With ``group_by`` rows of one group stay together; whole groups are
    split and a group counts under its smallest label. Rows without a group form one
    group; rows of a group without any label get a null split. No row is lost.
    """
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"the train ratio must lie between 0 and 1, got {ratio}")
    if group_by is not None:
        units = records.groupBy(F.col(group_by).alias("_unit")).agg(
            F.min(label_column).alias("label")
        )
        unit_id = F.col(group_by)
    else:
        units = records.select(
            F.col(id_column).alias("_unit"), F.col(label_column).alias("label")
        )
        unit_id = F.col(id_column)
    keyed = units.where(F.col("label").isNotNull()).withColumn(
        "_key", split_key(F.col("_unit"), seed)
    ).withColumn("bucket", hash_bucket(F.col("_key")))
    # A written class-sized table: Spark knows its size and broadcasts it by itself.
    per_label = materialise(_cut_keys(keyed, ratio), "split-cuts")
    in_train = F.coalesce(at_or_before(["_key", "_unit"], ["cut__key", "cut__unit"]), F.lit(False))
    split = F.when(in_train, F.lit("train")).when(F.col("_label").isNotNull(), F.lit("test"))
    if group_by is not None:
        # The label of a group is known only after grouping, so its split is looked up by group.
        placed = (
            keyed.join(per_label, keyed["label"] == per_label["_label"])
            .select(F.col("_unit").alias("_group"), split.alias("split"))
        )
        return records.join(placed, records[group_by].eqNullSafe(placed["_group"]), "left").drop("_group")
    return (
        records.withColumn("_key", split_key(unit_id, seed))
        .withColumn("_unit", unit_id)
        .join(per_label, F.col(label_column) == F.col("_label"), "left")
        .withColumn("split", split)
        .drop("_key", "_unit", "_label", "cut__key", "cut__unit")
    )


def split_summary(split: DataFrame, label_column: str = "label") -> DataFrame:
    """Rows per split and label with their share of the split."""
    counts = split.groupBy("split", F.col(label_column).alias("label")).agg(F.count("*").alias("n"))
    # One row per split and class reaches the window.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("split")))


def split_sizes(split: DataFrame, label_column: str = "label") -> DataFrame:
    """Rows and distinct labels per split with the share of all rows."""
    counts = split.groupBy("split", label_column).agg(F.count("*").alias("n"))
    per_split = counts.groupBy("split").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_labels")
    )
    return per_split.withColumn(
        "ratio", F.col("n_rows") / F.sum("n_rows").over(W.partitionBy(F.lit(1)))
    )


def unique_labels(split: DataFrame, label_column: str = "label") -> DataFrame:
    return split.select(F.col(label_column).alias("label")).distinct()


def task_id_range(records: DataFrame) -> DataFrame:
    """One row with the smallest and largest task id; nulls without tasks."""
    return records.agg(
        F.min("task_id").alias("min_task_id"), F.max("task_id").alias("max_task_id")
    )


def check_split(split: DataFrame, label_column: str = "label") -> None:
    """Raise if a side has fewer rows than there are classes. Runs one small job."""
    sizes = {r["split"]: r["n_rows"] for r in split_sizes(split, label_column).collect()}
    classes = unique_labels(split, label_column).count()
    for side in ("train", "test"):
        if sizes.get(side, 0) < classes:
            raise ValueError(f"{side} split has {sizes.get(side, 0)} rows for {classes} classes")
