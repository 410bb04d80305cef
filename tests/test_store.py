"""Key table, versions and compaction of a store."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from corpuslab.schemas import ARTICLE
from corpuslab.sources import keys as key_files, snapshots
from corpuslab.sources.keys import KeyTable
from corpuslab.streaming import jobs, runs
from helpers import rows
from test_plans import plan

DAY = dt.datetime(2025, 1, 20)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "story_id string")


def stories(spark, found):
    return spark.createDataFrame(
        [(f"u/{i}", "t", t, "s", DAY, "success" if t else "failed_no_text", i, DAY.date(), "m", "en", "q") for i, t in found], ARTICLE
    )


def test_known_ids(spark, out):
    keys = KeyTable(spark, out, buckets=4)
    assert rows(keys.known(ids(spark, "a", None))) == []
    keys.add(ids(spark, "a", "b", "b", None), "r", 0)
    keys.add(ids(spark, "c"), "r", 1)
    assert rows(keys.known(ids(spark, "a", "a", "c", "x", None))) == [("a",), ("c",)]
    # what the repeated micro-batch has stored itself does not count
    assert rows(keys.known(ids(spark, "a", "c"), "r", 1)) == [("a",)]
    assert rows(keys.known(ids(spark, "a", "c"), "other", 1)) == [("a",), ("c",)]
    many = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("story_id"))
    keys.add(many, "r", 2)
    assert keys.known(many.union(ids(spark, "c"))).count() == 1001
    again = KeyTable(spark.newSession(), out, buckets=4)  # found by its folder
    assert again.known(ids(spark, "c")).count() == 1


def test_the_key_table_is_not_shuffled_and_few_ids_prune_buckets(spark, out):
    keys = KeyTable(spark, out, buckets=8)
    keys.add(spark.range(5000).select(F.col("id").cast("string").alias("story_id")))
    few = plan(keys.known(ids(spark, "7")))
    assert re.search(r"SelectedBucketsCount: 1 out of 8", few) and "In(story_id" in few or "EqualTo(story_id" in few
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(keys.known(spark.range(key_files.LOOKUP + 50).select(F.col("id").cast("string").alias("story_id"))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    join = text[text.index("SortMergeJoin") :]
    left, right = join.split("\n")[1:], None
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    children = [k for k, line in enumerate(left) if depth(line) == depth(left[0])]
    store_side = "\n".join(left[: children[1]])
    assert "FileScan parquet" in store_side and "Exchange" not in store_side and "Bucketed: true" in store_side
    assert right is None


def test_readers_see_one_version(spark, out):
    schema = "story_id string"
    assert snapshots.read(spark, out, schema).count() == 0 and snapshots.compact(spark, out, schema) is None
    for k in range(5):
        ids(spark, f"s{k}").write.parquet(f"{out}/run=r/batch_id={k}")
        snapshots.publish(spark, out, {f"run=r/batch_id={k}": {"r": k}})
    before = snapshots.read(spark, out, schema)
    name = snapshots.compact(spark, out, schema, files=1)
    after = snapshots.read(spark, out, schema)
    want = [(f"s{k}",) for k in range(5)]
    assert rows(before) == want and rows(after) == want  # a reader that opened the old version finds its folders
    assert len(after.inputFiles()) == 1 and len(before.inputFiles()) >= 5
    assert snapshots.live(spark, out) == {name: {"r": 4}}
    assert snapshots.holds(spark, out, "r", 3) == name and snapshots.holds(spark, out, "r", 5) is None
    # a version that was not completed is not seen
    ids(spark, "x").write.parquet(f"{out}/half")
    spark.createDataFrame([("half", {})], snapshots.ENTRY).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").json(f"{out}/_manifest/v=00000099")
    assert rows(snapshots.read(spark, out, schema)) == want


def test_a_batch_that_is_repeated_after_compaction_adds_nothing(spark, out):
    source, store = out + "/in", out + "/store"
    stories(spark, [("1", "one"), ("2", "")]).write.parquet(source)
    stream = lambda: spark.readStream.schema(ARTICLE).parquet(source)
    runs.finish(jobs.start_ingest(stream(), store, f"{out}/cp"))
    snapshots.compact(spark, store, ARTICLE)
    # the first batch once more, as after a crash between publication and the stream's own commit
    import pathlib

    [p.unlink() for p in pathlib.Path(f"{out}/cp/commits").iterdir()]
    runs.finish(jobs.start_ingest(stream(), store, f"{out}/cp"))
    assert rows(snapshots.read(spark, store, ARTICLE), "story_id", "status") == [("1", "success"), ("2", "failed_no_text")]
    stories(spark, [("1", "again"), ("2", "two")]).write.mode("append").parquet(source)
    runs.finish(jobs.start_ingest(stream(), store, f"{out}/cp"))
    assert rows(snapshots.read(spark, store, ARTICLE), "story_id", "status") == [("1", "success"), ("2", "failed_no_text"), ("2", "success")]
