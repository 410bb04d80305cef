"""Article table laid out by URL: exact and prefix search read only the files whose bounds match."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.search import url_search


def _upper(prefix: str) -> str | None:
    """Least string above all that begin with ``prefix``, by code points; None where there is none."""
    kept = prefix.rstrip(chr(0x10FFFF))
    return kept[:-1] + chr(0xE000 if ord(kept[-1]) == 0xD7FF else ord(kept[-1]) + 1) if kept else None


@dataclass(frozen=True)
class UrlTable:
    """Articles in a folder, range-partitioned and sorted by URL, with the bounds of every file in a small table."""

    spark: SparkSession
    path: str

    @classmethod
    def write(cls, articles: DataFrame, path: str, files: int | None = None) -> UrlTable:
        """Write the layout; ``files`` defaults to the shuffle partitions. Ranges include the story id, so that a URL with very many copies is split. Runs jobs."""
        spark = articles.sparkSession
        count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = articles.repartitionByRange(count, "url", "story_id").sortWithinPartitions("url", "story_id")
        dealt.write.parquet(f"{path}/articles")
        written = spark.read.parquet(f"{path}/articles").select("url", F.col("_metadata.file_path").alias("file"))
        written.groupBy("file").agg(F.min("url").alias("least"), F.max("url").alias("greatest")).coalesce(1).write.parquet(f"{path}/bounds")
        return cls(spark, path)

    def _files(self, condition: Column) -> list[str]:
        return [r["file"] for r in self.spark.read.parquet(f"{self.path}/bounds").where(condition).select("file").collect()]

    def rows(self, url: str) -> DataFrame:
        """Rows of the files that may hold a URL or, with a trailing ``*``, a prefix."""
        whole = self.spark.read.parquet(f"{self.path}/articles")
        if url.endswith("*"):
            first, after = url[:-1], _upper(url[:-1])
            inside = (F.col("greatest") >= first) & (F.lit(True) if after is None else F.col("least") < after)
        else:
            inside = F.lit(url).between(F.col("least"), F.col("greatest"))
        files = self._files(inside)
        return self.spark.read.schema(whole.schema).parquet(*files) if files else whole.where(F.lit(False))

    def search(self, url: str, start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
        """``search.url_search`` over the matching files."""
        return url_search(self.rows(url), url, start, end)
