"""Line-level difference of two snapshots of the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import let
from ..functions.text import term_counts


def _signed_counts(text: Column, sign: int) -> Column:
    lines = F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    return F.transform(
        term_counts(lines),
        lambda e: F.struct(e["term"].alias("line"), (e["tf"] * sign).alias("delta")),
    )


def _merge(entries: Column) -> Column:
    """Add up the at most two neighbouring entries of every line; drop zero sums."""

    def merged(s: Column) -> Column:
        totals = F.transform(
            s,
            lambda e, i: F.struct(
                e["line"].alias("line"),
                F.when((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["line"] == e["line"]), F.lit(0))
                .otherwise(
                    e["delta"]
                    + F.when(F.get(s, i + 1)["line"] == e["line"], F.get(s, i + 1)["delta"]).otherwise(0)
                )
                .cast("long")
                .alias("delta"),
            ),
        )
        return F.filter(totals, lambda e: e["delta"] != 0)

    return let(F.sort_array(entries), merged)


def line_diff(
    snapshots: DataFrame,
    key: str = "doc_id",
    old: str = "old_text",
    new: str = "new_text",
) -> DataFrame:
    """``(key, line, delta)``: how often each line was added (+) or removed (-).

    Both texts are in one row, so lines are counted and matched inside it and
    nothing is shuffled.
    """
    entries = F.concat(_signed_counts(F.col(new), 1), _signed_counts(F.col(old), -1))
    return snapshots.select(key, F.inline_outer(_merge(entries))).where(F.col("line").isNotNull())


def snapshot_pairs(
    old: DataFrame, new: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pair two snapshot tables by document; one-sided documents get a null text."""
    a = old.select(key, F.col(text).alias("old_text"))
    b = new.select(key, F.col(text).alias("new_text"))
    return a.join(b, key, "full_outer")


def diff_summary(diff: DataFrame) -> DataFrame:
    """One row: documents that changed, lines added and lines removed."""
    up = F.when(F.col("delta") > 0, F.col("delta")).otherwise(0)
    down = F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0)
    per_doc = diff.groupBy("doc_id").agg(F.sum(up).alias("added"), F.sum(down).alias("removed"))
    return per_doc.agg(
        F.count("*").alias("n_changed"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("lines_added"),
        F.coalesce(F.sum("removed"), F.lit(0)).alias("lines_removed"),
    )
