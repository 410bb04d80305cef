"""Versions of a store that many small writes make: which folders are live, and merging them.

A version is a written list of folders below ``<store>/_manifest``. Writers publish a new version that adds or replaces folders; readers
take the newest complete one and see only its folders, also while others are written or merged. Old folders stay
for readers of older versions. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: A live folder, relative to the store, and for each run the last micro-batch that it holds.
ENTRY = "folder string, through map<string, bigint>"
MANIFEST = "_manifest"


def _versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{store}/{MANIFEST}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    numbers = [int(n[2:]) for n in names if re.fullmatch(r"v=\d+", n)]
    done = lambda n: files.exists(jvm.org.apache.hadoop.fs.Path(folder, f"v={n:08d}/_SUCCESS"))
    return sorted(n for n in numbers if done(n))


def live(spark: SparkSession, store: str) -> dict[str, dict[str, int]]:
    """Live folders with the last batch of each run they hold; empty before the first publication."""
    found = _versions(spark, store)
    if not found:
        return {}
    rows = spark.read.schema(ENTRY).json(f"{store}/{MANIFEST}/v={found[-1]:08d}").collect()
    return {r["folder"]: dict(r["through"] or {}) for r in rows}


def publish(spark: SparkSession, store: str, add: Mapping[str, Mapping[str, int]], drop: Iterable[str] = ()) -> None:
    """Write the next version: the newest one without ``drop`` and with ``add``. Nothing changes if it fails."""
    gone = set(drop)
    entries = {**{f: t for f, t in live(spark, store).items() if f not in gone}, **add}
    number = max(_versions(spark, store), default=0) + 1
    rows = spark.createDataFrame([(f, dict(t)) for f, t in sorted(entries.items())], ENTRY)
    rows.coalesce(1).write.mode("overwrite").json(f"{store}/{MANIFEST}/v={number:08d}")


def holds(spark: SparkSession, store: str, run: str, batch_id: int) -> str | None:
    """The live folder that a micro-batch has been published in, if any."""
    return next((f for f, through in live(spark, store).items() if through.get(run, -1) >= batch_id and not f.startswith("run=") or f == f"run={run}/batch_id={batch_id}"), None)


def read(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """Rows of the newest version; empty before the first one."""
    folders = sorted(live(spark, store))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{store}/{f}" for f in folders])


def compact(spark: SparkSession, store: str, schema: str, files: int | None = None) -> str | None:
    """Merge the live folders into one and publish it in their place; the new folder's name, None of an empty store.

    ``files`` is the number of files to write; by default the files are as Spark splits the folders. Folders that are published in the meantime stay live.
    """
    entries = live(spark, store)
    if not entries:
        return None
    name = f"merged={uuid.uuid4().hex[:12]}"
    rows = spark.read.schema(schema).parquet(*[f"{store}/{f}" for f in sorted(entries)])
    (rows.repartition(files) if files else rows).write.parquet(f"{store}/{name}")
    through: dict[str, int] = {}
    for last in entries.values():
        for run, batch in last.items():
            through[run] = max(batch, through.get(run, -1))
    publish(spark, store, {name: through}, entries)
    return name
