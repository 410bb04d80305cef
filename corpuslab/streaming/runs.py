"""Output layout shared by the streaming jobs.

Every micro-batch owns the folder ``run=<id>/batch_id=<n>`` and overwrites it,
so a batch that is repeated after a failure replaces what it wrote before. The
run id is tied to the checkpoint: a restart continues the run, a new checkpoint
starts another one.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def run_id(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def batch_path(store: str, run: str, batch_id: int) -> str:
    return f"{store}/run={run}/batch_id={batch_id}"


def read_store(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """All batches of all runs; empty before the first one."""
    layout = f"{schema}, run string, batch_id bigint"
    try:
        return spark.read.schema(layout).parquet(store)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], layout)
        raise


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query and surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
