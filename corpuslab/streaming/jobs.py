"""Streaming ingest, task push and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bayes import NaiveBayesModel
from ..operators.ingest import derive_status, storable
from ..operators.tasks import label_tasks, new_tasks
from ..schemas import ARTICLE, STATUS_SUCCESS, TASK, column_names
from ..sources import snapshots
from ..sources.keys import KeyTable
from .runs import batch_path, run_id


def keys_of(spark: SparkSession, store: str) -> KeyTable:
    """Ids of a store; hidden from readers of the store's folders."""
    return KeyTable(spark, f"{store}/_keys")


def start_ingest(
    articles: DataFrame, store: str, checkpoint: str
) -> StreamingQuery:
    """Append articles that are not stored yet. Runs until its input is used up.

    No watermark: an article counts however late it comes. Every micro-batch folds
    its copies to one per story and leaves out the stories that the store
    already has with text, which the bucketed key table tells; the store itself is not read and no
    stream state is kept. A failed story stays
    retryable; of a story that both failed and succeeded in one batch the success is kept.

    A batch owns one folder, overwrites it if it is repeated, and publishes it (``sources.snapshots``), so that readers see whole
    batches. A repeated batch whose folder was merged since is left as it was published.
    """
    columns = column_names(ARTICLE)
    run = run_id(checkpoint)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"run={run}/batch_id={batch_id}"
        if snapshots.holds(spark, store, run, batch_id) not in (None, folder):
            return
        keys = keys_of(spark, store)
        candidates = storable(batch)
        fresh = candidates.join(keys.known(candidates, run, batch_id), "story_id", "left_anti")
        best = fresh.groupBy("story_id").agg(
            F.max_by(F.struct(*columns), F.struct("status", "retrieved_at")).alias("a")
        )
        best.select("a.*").write.mode("overwrite").parquet(f"{store}/{folder}")
        stored = spark.read.schema(ARTICLE).parquet(f"{store}/{folder}")
        keys.add(stored.where(F.col("status") == STATUS_SUCCESS), run, batch_id)
        snapshots.publish(spark, store, {folder: {run: batch_id}})

    marked = articles.withColumn("status", derive_status(F.col("text"))).select(*columns)
    return (
        marked.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_task_push(articles: DataFrame, project: str, checkpoint: str) -> StreamingQuery:
    """Append tasks of stories that are not in the project yet, which its key table tells; published batch by batch."""
    run = run_id(checkpoint)

    def push(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"run={run}/batch_id={batch_id}"
        if snapshots.holds(spark, project, run, batch_id) not in (None, folder):
            return
        keys = keys_of(spark, project)
        tasks = label_tasks(batch).withColumn("story_id", F.col("data.story_id"))
        new_tasks(tasks, keys.known(tasks, run, batch_id)).drop("story_id").write.mode("overwrite").parquet(f"{project}/{folder}")
        stored = spark.read.schema(TASK).parquet(f"{project}/{folder}")
        keys.add(stored.select(F.col("data.story_id").alias("story_id")), run, batch_id)
        snapshots.publish(spark, project, {folder: {run: batch_id}})

    return (
        articles.writeStream.foreachBatch(push)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


PREDICTION = "record_id bigint, y_pred string"


def start_scoring(
    documents: DataFrame, model: NaiveBayesModel, sink: str, checkpoint: str
) -> StreamingQuery:
    """Score arriving documents ``(record_id, text)`` with a fitted model."""
    run = run_id(checkpoint)

    def score(batch: DataFrame, batch_id: int) -> None:
        model.predict(batch.select("record_id", "text")).write.mode("overwrite").parquet(
            batch_path(sink, run, batch_id)
        )

    return (
        documents.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
