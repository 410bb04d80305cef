"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import agreement as ag
from ..operators import annotations as an
from ..operators import bayes
from ..operators.features import TfidfParams
from ..operators.ingest import ingest
from ..operators.leaderboard import leaderboard
from ..operators.metrics import weighted_metrics
from ..operators.scoring import lookup_urls, with_lineage
from ..operators.search import story_search
from ..operators.splits import stratified_split
from ..operators.tasks import label_tasks, new_tasks
from ..session import materialise


@dataclass(frozen=True)
class Collected:
    """Result of a collection run."""

    articles: DataFrame
    tasks: DataFrame
    new_tasks: DataFrame


def collect(
    archive: DataFrame,
    index: DataFrame,
    store: DataFrame,
    project: DataFrame,
    limit: int | None = 100,
    **search,
) -> Collected:
    """Search, skip what is stored, build tasks, leave out those already pushed."""
    found = story_search(archive, **search)
    articles = ingest(found, index, store, limit)
    tasks = label_tasks(articles)
    keyed = tasks.withColumn("story_id", F.col("data.story_id"))
    return Collected(articles, tasks, new_tasks(keyed, project).drop("story_id"))


def train_and_evaluate(
    records: DataFrame,
    features: TfidfParams = TfidfParams(),
    params: bayes.NaiveBayesParams = bayes.NaiveBayesParams(),
    ratio: float = 0.8,
    seed: int = 42,
    model_name: str = "naive_bayes",
    path: str | None = None,
) -> tuple[bayes.NaiveBayesModel, DataFrame]:
    """Split, fit, predict the test side and measure. Fitting runs jobs."""
    split = stratified_split(records, ratio, seed)
    model = bayes.fit(split.where(F.col("split") == "train"), features, params, path)
    return model, evaluate(model, split.where(F.col("split") == "test"), model_name)


def evaluate(model: bayes.NaiveBayesModel, test: DataFrame, model_name: str) -> DataFrame:
    """Weighted metrics of one model on labelled records."""
    predicted = model.predict(test, keep=("record_id", "label")).select(
        F.lit(model_name).alias("model_name"), F.col("label").alias("y_true"), "y_pred"
    )
    return weighted_metrics(predicted)


def evaluate_models(
    models: dict[str, bayes.NaiveBayesModel], test: DataFrame, metric: str = "f1"
) -> DataFrame:
    """Leaderboard of several models. Runs a job for each; one that fails becomes an error row.

    Every model's confusion counts, a small table, are written in an action of their own, so a model
    that breaks while it runs hides no other. The error is the first line of what it raised.
    """
    spark = test.sparkSession
    measured, failures = None, []
    for name, model in models.items():
        try:
            part = materialise(evaluate(model, test, name), "evaluation")
        except Exception as error:  # one broken model must not hide the others
            failures.append((name, str(error).splitlines()[0][:500] if str(error) else type(error).__name__))
            continue
        measured = part if measured is None else measured.unionByName(part)
    failed = spark.createDataFrame(failures, "model_name string, error string")
    if measured is None:
        empty = spark.createDataFrame([], "model_name string, y_true string, y_pred string")
        measured = weighted_metrics(empty)
    return leaderboard(measured, metric, failed)


def infer_urls(
    urls: DataFrame,
    articles: DataFrame,
    model: bayes.NaiveBayesModel,
    model_name: str,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Predictions ``(line_no, story_id, url, text, model_used, prediction_timestamp, y_pred)``.

    Missing URLs are left out. Every distinct story is scored once, however
    often its URL was asked for.
    """
    hits = lookup_urls(urls, articles, start, end).where(F.col("story_id").isNotNull())
    hits = materialise(hits, "url-hits")
    # One row of each story: a fold, not a sort of all its copies.
    stories = hits.groupBy("story_id").agg(F.first("text").alias("text"))
    scored = materialise(model.predict(stories, keep=("story_id",)), "story-labels")
    return with_lineage(hits.join(scored, "story_id"), model_name)


def analyse_annotations(tasks: DataFrame, required: Sequence[str]) -> dict[str, DataFrame]:
    """All sections of the annotation analysis by name. Writes the long ratings once."""
    long = materialise(an.require_labels(an.analysis_records(tasks), required), "ratings")
    simple = ag.simple_agreement(long)
    per_task = ag.task_agreement(simple)
    counts = ag.annotator_counts(long)
    return {
        "project_summary": ag.project_summary(long),
        "annotator_counts": counts,
        "annotator_extremes": ag.annotator_extremes(counts),
        "label_distributions": ag.label_grouping_sets(long),
        "label_shares": ag.label_shares(long),
        "schema": ag.label_schema(long),
        "agreement": ag.agreement_report(simple, per_task),
        "agreement_summary": ag.agreement_summary(per_task),
        "overall_agreement_metrics": ag.with_bands(ag.agreement_metrics(long)),
        "timing_stats": ag.lead_time_stats(long),
    }
