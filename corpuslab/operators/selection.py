"""Exact selection of the first rows of an ordering without a global sort.

A row_number over a whole table, or over a class that holds a third of it, sorts
that class in one task. These helpers find the *cut-off key* instead: a
histogram over a coarse bucket of the key tells in which bucket the cut falls,
only that one bucket is ranked, and the selection is then a plain comparison.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..session import materialise


def boundary_buckets(histogram: DataFrame, group: str, quotas: DataFrame) -> DataFrame:
    """Bucket that holds the ``quota``-th row of every group: ``(group, bucket, rank)``.

    ``histogram`` is ``(group, bucket, n)`` with buckets in key order and
    ``quotas`` is ``(group, quota)``. ``rank`` is the position inside the bucket.
    A group whose quota is below 1 or above its size gives no row. The window
    sees at most one row per bucket of a group.
    """
    ordered = W.partitionBy(group).orderBy("bucket")
    upto, n, quota = F.col("_upto"), F.col("n"), F.col("quota")
    return (
        histogram.withColumn("_upto", F.sum("n").over(ordered))
        .join(quotas.select(group, "quota"), group)
        .where((upto >= quota) & (upto - n < quota))
        .select(group, "bucket", (quota - upto + n).alias("rank"))
    )


def at_or_before(key: list[str], cut: list[str]) -> Column:
    """Lexicographic ``key <= cut``."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)]) <= F.struct(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(cut)]
    )


def hash_bucket(md5_hex: Column, digits: int = 4) -> Column:
    """Leading hexadecimal digits of an md5 as a number; monotone in the md5 text."""
    return F.conv(F.substring(md5_hex, 1, digits), 16, 10).cast("int")


def value_at_ranks(
    values: DataFrame, value: str, ranks: list[Column], buckets: int = 4096, weight: str | None = None
) -> DataFrame:
    """The values at the given 1-based ranks: rows ``(which, value)``, ``which`` from 0. Runs jobs.

    ``values`` has one non-null numeric column; the rank expressions may use the
    total count ``n``. Equal values are counted once and written, unless ``weight`` names
    a column with counts of values, which may then repeat. Each round cuts the interval that
    holds a rank into ``buckets`` parts and goes on with the one that holds it, until it holds one value; the
    driver sees one small row for each part. Nothing is sorted, and how many rounds it takes depends on the
    range of the values, not on their number. A rank beyond the end gives no row.
    """
    spark = values.sparkSession
    kind = values.schema[value].dataType
    if weight:
        counts = values.withColumnRenamed(weight, "_n")
    else:
        counts = materialise(values.groupBy(value).agg(F.count("*").alias("_n")), "ranks")
    whole = counts.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.sum("_n").alias("n"))
    head = whole.select("lo", "hi", "n", *[r.cast("long").alias(f"_r{k}") for k, r in enumerate(ranks)]).first()
    out = []
    exact = not isinstance(kind, (T.DoubleType, T.FloatType))

    def part_of(lo, hi) -> Column:
        """Part of the interval that holds a value; whole numbers and decimals are cut in units of their last digit."""
        if exact:
            scale = kind.scale if isinstance(kind, T.DecimalType) else 0
            units = lambda v: int(Decimal(v).scaleb(scale))
            width = -(-(units(hi) - units(lo) + 1) // buckets)
            step = F.lit(Decimal(width).scaleb(-scale)).cast(f"decimal(38,{scale})")
            return F.floor((F.col(value).cast(f"decimal(38,{scale})") - F.lit(lo).cast(f"decimal(38,{scale})")) / step)
        low, high = float(lo), float(hi)
        return F.least(F.floor((F.col(value).cast("double") - low) / ((high - low) / buckets)), F.lit(buckets - 1))

    for which in range(len(ranks)):
        lo, hi, rank = head["lo"], head["hi"], head[f"_r{which}"]
        if rank is None or head["n"] is None or not 1 <= rank <= head["n"]:
            continue
        while lo < hi:
            part = part_of(lo, hi)
            inside = counts.where(F.col(value).between(F.lit(lo), F.lit(hi)))
            found = inside.groupBy(part.alias("_part")).agg(
                F.sum("_n").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
            )
            for row in sorted(found.collect(), key=lambda r: r["lo"]):
                if rank <= row["n"]:
                    break
                rank -= row["n"]
            lo, hi = row["lo"], row["hi"]
        out.append((which, lo))
    return spark.createDataFrame(out, T.StructType([T.StructField("which", T.IntegerType()), T.StructField(value, kind)]))
