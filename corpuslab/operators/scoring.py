"""Scoring: URL lookup, pluggable batch models and prediction summaries."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import strip
from .search import date_between

# Fixed value: default number of rows handed to a model at once.
DEFAULT_BATCH = 32


def lookup_urls(
    urls: DataFrame,
    articles: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """Every input row ``(line_no, url)`` with its first story in the date window.

    Rows whose URL is null or blank are left out. Repeated URLs stay repeated and misses keep a null ``story_id``. Stories
    are cut to the requested URLs and folded to one per URL before the join, so
    a URL with very many copies on either side is not joined pair by pair.
    """
    inside = articles.where(date_between(F.col("publish_date"), start, end))
    urls = urls.where(F.length(strip(F.col("url"))) > 0)
    wanted = urls.select("url").distinct()
    first = (
        inside.join(wanted, "url", "left_semi")
        .groupBy("url")
        .agg(F.min_by(F.struct("story_id", "text"), F.col("seq")).alias("hit"))
    )
    return urls.join(first, "url", "left").select(
        "line_no", "url", F.col("hit.story_id").alias("story_id"), F.col("hit.text").alias("text")
    )


def lookup_counts(looked_up: DataFrame) -> DataFrame:
    """One row: requested URLs, found and missed ones."""
    return looked_up.agg(
        F.count("*").alias("n_urls"),
        F.count("story_id").alias("n_found"),
        F.count_if(F.col("story_id").isNull()).alias("n_missing"),
    )


def with_lineage(predictions: DataFrame, model_name: str) -> DataFrame:
    """Add the model and the time of prediction."""
    return predictions.withColumn("model_used", F.lit(model_name)).withColumn(
        "prediction_timestamp", F.current_timestamp()
    )


def prediction_distribution(predictions: DataFrame, column: str = "y_pred") -> DataFrame:
    return (
        predictions.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    )


def score_batches(
    rows: DataFrame,
    load: Callable[[], object],
    features: str,
    keep: Sequence[str],
    batch_size: int = DEFAULT_BATCH,
    probabilities: bool = False,
) -> DataFrame:
    """Apply a Python model to Arrow batches: ``(*keep, y_pred[, probabilities])``.

    ``load()`` runs once per task and returns an object with ``classes`` and
    ``scores(values) -> array[n, n_classes]``. Rows reach the model
    ``batch_size`` at a time. Ties go to the lowest class.
    """
    fields = [rows.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("y_pred", T.StringType())])
    if probabilities:
        schema.add("probabilities", T.ArrayType(T.DoubleType()))
    kept = list(keep)

    def run(batches):
        import numpy as np

        model = load()
        names = [str(c) for c in model.classes]
        for frame in batches:
            out = frame[kept].copy()
            labels, probs = [], []
            for begin in range(0, len(frame), batch_size):
                scores = np.asarray(
                    model.scores(frame[features].iloc[begin : begin + batch_size]), dtype="float64"
                )
                labels.extend(names[i] for i in scores.argmax(axis=1))
                if probabilities:
                    e = np.exp(scores - scores.max(axis=1, keepdims=True))
                    probs.extend((e / e.sum(axis=1, keepdims=True)).tolist())
            out["y_pred"] = labels
            if probabilities:
                out["probabilities"] = probs
            yield out

    return rows.select(*kept, features).mapInPandas(run, schema)


def score_folder(
    rows: DataFrame, folder: str, features: str, keep: Sequence[str], batch_size: int = DEFAULT_BATCH, probabilities: bool = False
) -> DataFrame:
    """Apply a linear model that lies in a folder: ``(*keep, y_pred[, probabilities])``.

    The folder holds Parquet rows ``(label, weights array<double>, bias double)``, one a class, as ``linear.write_centroids`` writes
    them; every Python worker reads it once, nothing passes through the driver. Spark makes the batches. Probabilities are in the order of the
    sorted labels; ties go to the lowest label. A row without features gets nulls.
    """
    size = rows.sparkSession.read.parquet(folder).select(F.size("weights").alias("n")).first()
    if size is None:
        raise ValueError(f"the model at {folder} has no classes")
    dims = size["n"]
    folder = folder if "://" in folder or folder.startswith(("file:", "/")) else os.path.abspath(folder)
    kind = T.StructType([T.StructField("best", T.IntegerType()), T.StructField("p", T.ArrayType(T.DoubleType()))])

    def load():
        # Only installed packages: the workers need not have this one.
        import numpy as np
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        local = folder.startswith("file:") or "://" not in folder
        files, root = (pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if local else pafs.FileSystem.from_uri(folder)
        model = sorted(pq.read_table(root, filesystem=files).to_pylist(), key=lambda r: str(r["label"]))
        weights = np.array([r["weights"] for r in model], dtype="float64")
        bias = np.array([r["bias"] for r in model], dtype="float64")

        def predict(values):
            scores = np.asarray(values, dtype="float64") @ weights.T + bias
            powers = np.exp(scores - scores.max(axis=1, keepdims=True))
            return {"best": scores.argmax(axis=1).astype("int32"), "p": powers / powers.sum(axis=1, keepdims=True)}

        return predict

    model = predict_batch_udf(load, return_type=kind, batch_size=batch_size, input_tensor_shapes=[[dims]])
    labels = rows.sparkSession.read.parquet(folder).agg(F.sort_array(F.collect_list(F.col("label").cast("string")))).scalar()
    usable = F.size(features) == dims
    full = F.coalesce(F.when(usable, F.col(features).cast("array<double>")), F.array_repeat(F.lit(0.0), dims))
    scored = rows.select(*keep, usable.alias("_usable"), model(full).alias("_m")).withColumn("_labels", labels)
    found = F.when(F.col("_usable"), F.get("_labels", F.col("_m.best")))
    out = [*keep, found.alias("y_pred")]
    return scored.select(*out, F.when(F.col("_usable"), F.col("_m.p")).alias("probabilities")) if probabilities else scored.select(*out)
