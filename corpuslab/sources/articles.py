"""Article store, index, exports and small inputs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip
from ..operators.ingest import failed_urls, merge_index
from ..operators.tasks import task_json
from ..schemas import ARTICLE, ARTICLE_INDEX, LEXICON, PAGE, SOURCE_CATALOGUE, TASK, column_names


def _read_or_empty(
    spark: SparkSession, path: str, schema: str, source: str = "parquet"
) -> DataFrame:
    """Rows below ``path``; a path that does not exist yet reads as empty."""
    try:
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_articles(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Article store as Parquet, or ``source="json"`` for JSON lines."""
    return _read_or_empty(spark, path, ARTICLE, source)


def append_articles(articles: DataFrame, path: str) -> None:
    """Append to the store, partitioned by day of retrieval."""
    columns = column_names(ARTICLE)
    (
        articles.select(*columns, F.to_date("retrieved_at").alias("retrieved_day"))
        .write.mode("append")
        .partitionBy("retrieved_day")
        .parquet(path)
    )


def append_index(entries: DataFrame, path: str) -> None:
    """Append index entries; older entries of a story stay until compaction."""
    entries.select(*column_names(ARTICLE_INDEX)).write.mode("append").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Latest index entry per story; empty when the index does not exist."""
    log = _read_or_empty(spark, path, ARTICLE_INDEX)
    return merge_index(log, log.where(F.lit(False)))


def compact_index(spark: SparkSession, path: str, target: str) -> None:
    """Write the latest entries only, to a new path."""
    read_index(spark, path).write.mode("overwrite").parquet(target)


_AS_IT_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(table: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled, so line breaks in texts survive, and so does white space at the ends.

    Empty texts read back as null.
    """
    table.write.mode("overwrite").options(header=True, escape='"', **_AS_IT_IS).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .options(**_AS_IT_IS)
        .csv(path)
    )


def export_tasks(tasks: DataFrame, path: str) -> None:
    """One JSON task per line."""
    task_json(tasks).write.mode("overwrite").text(path)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK).json(path)


def write_failed_urls(articles: DataFrame, path: str) -> None:
    """URLs of failed articles as text; each run replaces the list."""
    failed_urls(articles).write.mode("overwrite").text(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, url)`` of a text file; lines are stripped and blank ones dropped.

    ``line_no`` grows with the file but is not dense.
    """
    lines = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return lines.where(F.length("url") > 0).select(
        F.monotonically_increasing_id().alias("line_no"), "url"
    )


def read_source_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Source catalogue with quoted, possibly multi-line cells, columns by position."""
    return read_csv_export(spark, path, SOURCE_CATALOGUE)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Sentiment lexicon ``(term, valence, polarity, subjectivity)`` from CSV with header."""
    return read_csv_export(spark, path, LEXICON)
