"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """Session for tests and the local benchmark; clusters bring their own.

    ``shared`` becomes ``spark.checkpoint.dir``; one machine may take a temporary folder.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpuslab")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="corpuslab-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A session without the setting (as a driver's local smoke run) may use the folder
    given to ``SparkContext.setCheckpointDir``; only a local master may have neither and
    gets a folder of its own, which is then the session's checkpoint folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslab-"))
    return context.getCheckpointDir().rstrip("/")


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """Fresh sub-folder name of the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialise(table: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back. Runs a job.

    Cuts the lineage in a way that survives lost executors, and gives later
    joins the real size of the table.
    """
    spark = table.sparkSession
    path = path or new_run_dir(spark, purpose)
    table.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def materialise_buckets(table: DataFrame, purpose: str, key: str) -> DataFrame:
    """Write a table to the shared folder, bucketed by ``key``, and read it back. Runs a job.

    Joins and sums by the key then need no exchange of its rows. There are as many buckets as an exchange has parts, so rows that come from
    an exchange by the key are written by bucket as they lie.
    """
    spark = table.sparkSession
    path = new_run_dir(spark, purpose)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(name)
    return spark.table(name)


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors' Python workers, once a session; installed packages need it not."""
    context = spark.sparkContext
    if getattr(context, "_corpuslab_sent", False):
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpuslab-")) / f"{top.name}_sources.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(target))
    context._corpuslab_sent = True
