"""Bucketed table of stored story ids: tells what a store holds without reading the store.

A row is an id with the run and micro-batch that stored it. The table is narrow, bucketed and sorted by id, and lies in a folder of
its own; the session's catalogue only points there. Asking it for the ids of a batch shuffles the batch, never the table, and a batch
of few ids reads the buckets of these ids only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS = 16
#: Up to so many distinct ids are looked up as literals, which prunes buckets; the driver holds them. More are joined by bucket.
LOOKUP = 200


@dataclass(frozen=True)
class KeyTable:
    """Key table in a folder; its number of buckets is fixed when it is first written."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    @property
    def name(self) -> str:
        return "keys_" + hashlib.md5(self.path.encode()).hexdigest()[:16]

    def table(self) -> DataFrame:
        """All rows: ``story_id``, ``run``, ``batch_id``."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (story_id STRING, run STRING, batch_id BIGINT) USING parquet "
            f"CLUSTERED BY (story_id) SORTED BY (story_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, ids: DataFrame, run: str = "", batch_id: int = 0) -> None:
        """Append the distinct ids of a batch; each bucket gets one file. Repeats of a batch do no harm."""
        self.table()
        rows = ids.select("story_id").where("story_id is not null").distinct()
        rows = rows.select("story_id", F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        rows.repartition(self.buckets, "story_id").write.insertInto(self.name)

    def known(self, ids: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """Distinct ids of ``ids`` that the table holds, but for what the given micro-batch itself has stored. Runs a small job."""
        stored = self.table()
        if run is not None:
            stored = stored.where(~((F.col("run") == run) & (F.col("batch_id") == batch_id)))
        asked = ids.select("story_id").where("story_id is not null").distinct()
        few = [r["story_id"] for r in asked.limit(LOOKUP + 1).collect()]
        if len(few) <= LOOKUP:
            return stored.where(F.col("story_id").isin(few)).select("story_id").distinct()
        return stored.join(asked, "story_id", "left_semi").select("story_id").distinct()
