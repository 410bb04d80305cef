"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _nearest(edges: DataFrame) -> DataFrame:
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "star")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``node``, ``root``: every node that has an edge with the smallest node it reaches.

    ``edges`` has one row per link in any direction; loops and null ends are left out, repeats are harmless. Large-star and
    small-star steps alternate until nothing changes, which takes a logarithmic number of rounds in the longest
    path. Every round is written to the shared folder; minima are folded before a join, and both sides of a join are
    written tables, so that the join may split a hub that holds a large share of the edges.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null")
    e = materialise(e.where("u != v").distinct(), "edges")
    mark = _mark(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = materialise(large.distinct(), "edges")
        small = large.join(_nearest(large), "u")
        step = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(step.union(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, mark = mark, _mark(e)
        if was == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
