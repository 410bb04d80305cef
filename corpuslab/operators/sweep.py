"""Many Naive Bayes configurations in one plan, and smoothing sweeps."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from contextvars import ContextVar
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import materialise
from .bayes import TIE_DIGITS, TOTAL_CLASS, NaiveBayesModel, NaiveBayesParams, fit, score_sums
from .features import TfidfParams
from .metrics import METRICS, weighted_metrics
from .termblocks import Bounds, Numbered, class_sums, number_terms


@dataclass(frozen=True)
class NaiveBayesConfig:
    """One named configuration of a multi-model run."""

    config_id: str
    alpha: float = 1.0
    ngram_lo: int = 1
    ngram_hi: int = 1
    min_df: int | float = 1
    max_df: int | float = 1.0
    features: TfidfParams = TfidfParams()  # of its fields all but the three above
    fit_prior: bool = True
    class_prior: tuple[float, ...] | None = None

    def shared(self) -> tuple:
        """What configurations must have in common to be fitted in one plan."""
        rest = {k: tuple(v) if isinstance(v, list) else v for k, v in self.features.as_dict().items()}
        return (*sorted(rest.items()), self.fit_prior, self.class_prior)

    def token_rule(self) -> tuple:
        """What decides the tokens of a text."""
        return self.features.token_rule()

    def bounds(self, n_docs: int) -> Bounds:
        """Sizes of the n-grams and numbers of documents of the terms it uses, of so many documents."""
        share = [x * n_docs if isinstance(x, float) else x for x in (self.min_df, self.max_df)]
        return self.ngram_lo, self.ngram_hi, *share

    def whole(self) -> tuple[TfidfParams, NaiveBayesParams]:
        """The parameters of a single fit."""
        own = {"ngram_range": (self.ngram_lo, self.ngram_hi), "min_df": self.min_df, "max_df": self.max_df}
        return replace(self.features, **own), NaiveBayesParams(self.alpha, self.fit_prior, self.class_prior)


def configs_from_mappings(models: Sequence[Mapping]) -> list[NaiveBayesConfig]:
    """Configurations from ``{name, model_params}`` entries; unknown parameters are an error."""
    own = {"alpha", "min_df", "max_df", "fit_prior"}
    out = []
    for model in models:
        params = dict(model.get("model_params", {}))
        low, high = params.pop("ngram_range", (1, 1))
        prior = params.pop("class_prior", None)
        mine = {k: params.pop(k) for k in own & set(params)}
        try:
            features = TfidfParams.from_mapping(params)
        except ValueError as error:
            raise ValueError(f"{model.get('name')}: {error}") from None
        prior = None if prior is None else tuple(prior)
        out.append(
            NaiveBayesConfig(model["name"], ngram_lo=low, ngram_hi=high, features=features, class_prior=prior, **mine)
        )
    return out


def fit_and_predict_many(
    train: DataFrame,
    test: DataFrame,
    configs: Sequence[NaiveBayesConfig],
) -> DataFrame:
    """Predictions ``(config_id, record_id, y_true, y_pred)`` of all configurations.

    Texts are tokenised and their terms numbered once for each token rule (case, pattern, stop words); all configurations of the
    rule read the numbered blocks. Configurations that differ in smoothing, n-grams and document-frequency bounds only share their class sums; the
    others form sums for each set of further parameters. One that bounds the vocabulary by
    ``max_features`` is fitted by itself. Runs jobs.
    """
    out, groups = None, {}
    tables = _TABLES.get()
    tables = _Tables(configs, {}) if tables is None else tables
    for c in configs:
        if c.alpha <= 0:
            raise ValueError("alpha must be positive in every configuration")
        groups.setdefault((c.config_id,) if c.features.max_features else c.shared(), []).append(c)
    for group in groups.values():
        if group[0].features.max_features:
            model = fit(train, *group[0].whole())
            part = model.predict(test, keep=("record_id", "label")).select(
                F.lit(group[0].config_id).alias("config_id"), "record_id", F.col("label").alias("y_true"), "y_pred"
            )
        else:
            part = _predict_group(tables.numbered(train, test, group[0]), group)
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class _Tables:
    """Numbered terms of two sides for each token rule of some configurations, made when they are asked for."""

    configs: Sequence[NaiveBayesConfig]
    made: dict

    def numbered(self, train: DataFrame, test: DataFrame, config: NaiveBayesConfig) -> Numbered:
        rule = config.token_rule()
        if rule not in self.made:
            alike = [c for c in self.configs if c.token_rule() == rule and not c.features.max_features]
            low, high = min(c.ngram_lo for c in alike), max(c.ngram_hi for c in alike)
            labelled = train.where(F.col("label").isNotNull() & F.col("text").isNotNull())
            self.made[rule] = number_terms(labelled, test, config.features, low, high, lambda n_docs: [c.bounds(n_docs) for c in alike])
        return self.made[rule]


#: Tables that the trials of a running sweep share.
_TABLES: ContextVar[_Tables | None] = ContextVar("_TABLES", default=None)


def _predict_group(known: Numbered, configs: Sequence[NaiveBayesConfig]) -> DataFrame:
    """Predictions of configurations that share all but smoothing, n-grams and document-frequency bounds.

    A term's document frequency decides which configurations use it, and the number of the configuration is one more group key from there on.
    A configuration left without vocabulary yields no rows. Runs the jobs of ``termblocks.class_sums``.
    """
    params = configs[0].features
    spark = known.table.sparkSession
    found, hits = class_sums(known, params, [c.bounds(known.n_docs) for c in configs], [float(c.alpha) for c in configs])
    found = materialise(found, "sweep-totals")
    named = spark.createDataFrame([(i, c.config_id, float(c.alpha)) for i, c in enumerate(configs)], "config int, config_id string, alpha double")
    kind = known.table.schema["labels"].dataType.elementType.simpleString()
    ids = spark.createDataFrame(list(enumerate(known.labels)), f"label_id int, label {kind}")
    vocab_sizes = found.where("label_id is null and v > 0").select("config", "v").join(named, "config")
    totals = found.where("label_id is not null").select("config", "label_id", "n_c")
    docs = known.table.where("train").select(F.explode("labels").alias("label")).groupBy("label").agg(F.count("*").alias("n_docs"))
    everything = W.partitionBy(F.lit(1))
    if configs[0].class_prior is not None:
        given = F.array(*[F.lit(float(p)) for p in configs[0].class_prior])
        log_prior = F.log(F.element_at(given, F.row_number().over(everything.orderBy("label"))))
    elif configs[0].fit_prior:
        log_prior = F.log(F.col("n_docs") / F.sum("n_docs").over(everything))
    else:
        log_prior = -F.log(F.count("*").over(everything).cast("double"))
    priors = docs.select("label", log_prior.alias("log_prior")).join(ids, "label")
    # Every used configuration meets every training class, also one without terms.
    all_priors = priors.agg(F.collect_list(F.struct("label_id", "label", "log_prior"))).scalar()
    classes = (
        vocab_sizes.select("config", "config_id", "alpha", "v", F.inline_outer(all_priors))
        .join(totals, ["config", "label_id"], "left")
        .select(
            "config",
            "config_id",
            "label_id",
            "label",
            "log_prior",
            (
                F.log("alpha")
                - F.log(F.coalesce("n_c", F.lit(0.0)) + F.col("alpha") * F.col("v"))
            ).alias("base"),
        )
        .groupBy("config", "config_id")
        .agg(F.sort_array(F.collect_list(F.struct("label_id", "label", "log_prior", "base"))).alias("classes"))
    )

    is_total = F.col("label_id").isNull()
    hits = (
        hits.groupBy("record_id", "config", "label_id")
        .agg(F.sum("s").alias("s"), F.sum("sq").alias("sq"))
        .groupBy("record_id", "config")
        .agg(
            F.map_from_entries(F.collect_list(F.when(~is_total, F.struct("label_id", "s")))).alias("s"),
            F.max(F.when(is_total, F.col("s"))).alias("w"),
            F.max(F.when(is_total, F.col("sq"))).alias("sq"),
        )
    )
    rows = known.table.where("not train").select(F.inline(F.arrays_zip(F.col("ids").alias("record_id"), F.col("labels").alias("y_true"))))
    wanted = rows.select("record_id", "y_true", F.explode(F.array(*[F.lit(i) for i in range(len(configs))])).alias("config"))
    # A row for each configuration of the caller's list; written, so that Spark knows its size.
    met = wanted.join(hits, ["record_id", "config"], "left").join(materialise(classes, "sweep-classes"), "config")
    norm = {"l2": F.sqrt("sq"), "l1": F.col("w"), None: F.lit(1.0)}[params.norm]

    def scored(c: Column, i: Column) -> Column:
        seen = F.coalesce(F.try_element_at("s", c["label_id"]), F.lit(0.0))
        gain = F.coalesce((c["base"] * F.col("w") + seen) / norm, F.lit(0.0))
        return F.struct(
            F.round(c["log_prior"] + gain, TIE_DIGITS).alias("score"), -i, c["label"].alias("label")
        )

    best = F.array_max(F.transform("classes", scored))
    return met.select("config_id", "record_id", "y_true", best["label"].alias("y_pred"))


def evaluate_many(
    train: DataFrame,
    test: DataFrame,
    configs: Sequence[NaiveBayesConfig],
) -> DataFrame:
    """Metrics per configuration; one that finds no vocabulary gets a row of nulls."""
    metrics = weighted_metrics(fit_and_predict_many(train, test, configs), ["config_id"])
    spark = train.sparkSession
    names = spark.createDataFrame([(c.config_id,) for c in configs], "config_id string")
    return names.join(metrics, "config_id", "left")


def alpha_sweep(
    model: NaiveBayesModel, test: DataFrame, alphas: Sequence[tuple[int, float]]
) -> DataFrame:
    """Metrics of other smoothing values on a fitted model: ``(trial, alpha, ...)``.

    The term sums do not depend on alpha, so all trials share one join and are
    separate sums of one aggregate. A trial with alpha <= 0 scores 0.0.
    """
    usable = [(t, float(a)) for t, a in alphas if a > 0]
    spark = test.sparkSession
    trials = spark.createDataFrame(
        [(int(t), float(a)) for t, a in alphas], "trial int, alpha double"
    )
    if not usable:
        zeros = [F.lit(0.0).alias(m) for m in METRICS]
        return trials.select("trial", "alpha", *zeros)

    features = model.features
    keep = ("record_id", "label")
    ids = model.classes.select("label", "class_id")
    gains = model.sums.join(ids, "label").select("term", "idf", "class_id", "n_ct")
    w, is_total = F.col("w"), F.col("class_id") == TOTAL_CLASS
    per_trial = {
        f"g{i}": F.sum(w * (F.log(F.col("n_ct") + a) - F.log(F.lit(a))))
        for i, (_, a) in enumerate(usable)
    }
    sums = (
        score_sums(
            test,
            model.vocab,
            gains,
            features,
            keep,
            {"w": F.sum(w), "sq": F.sum(w * w), **per_trial},
        )
        .withColumn("g", F.array(*per_trial))
        .groupBy(*keep)
        .agg(
            F.map_from_entries(
                F.collect_list(F.when(F.col("class_id").isNotNull(), F.struct("class_id", "g")))
            ).alias("g"),
            F.max(F.when(is_total, w)).alias("w"),
            F.max(F.when(is_total, F.col("sq"))).alias("sq"),
        )
    )
    size = {"l2": F.sqrt("sq"), "l1": F.col("w"), None: F.lit(1.0)}[features.norm]
    classes = model.classes.agg(
        F.sort_array(F.collect_list(F.struct("class_id", "label", "log_prior", "n_c")))
    ).scalar()
    known = (
        sums.withColumn("_size", size).withColumn("_classes", classes).withColumn("_v", F.lit(model.n_terms))
    )
    def choice(i: int, trial: int, a: float) -> Column:
        def scored(c: Column) -> Column:
            seen = F.coalesce(F.get(F.try_element_at("g", c["class_id"]), F.lit(i)), F.lit(0.0))
            base = F.log(F.lit(a)) - F.log(c["n_c"] + a * F.col("_v"))
            gain = F.coalesce((base * F.col("w") + seen) / F.col("_size"), F.lit(0.0))
            return F.struct(
                F.round(c["log_prior"] + gain, TIE_DIGITS).alias("score"),
                -c["class_id"],
                c["label"].alias("label"),
            )

        best = F.array_max(F.transform("_classes", scored))
        return F.struct(F.lit(trial).alias("trial"), best["label"].alias("y_pred"))

    choices = [choice(i, trial, a) for i, (trial, a) in enumerate(usable)]
    predictions = known.select(
        "record_id", F.col("label").alias("y_true"), F.inline(F.array(*choices))
    )
    metrics = weighted_metrics(predictions, ["trial"])
    failed = F.col("alpha") <= 0
    return trials.join(metrics, "trial", "left").select(
        "trial",
        "alpha",
        *[F.when(failed, F.lit(0.0)).otherwise(F.col(m)).alias(m) for m in METRICS],
    )


def remaining_trials(trials: DataFrame, history: DataFrame) -> DataFrame:
    """Trials of a resumed sweep that have no saved result yet."""
    return trials.join(history.select("trial"), "trial", "left_anti")


def best_trial(history: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: the trial with the highest metric, ties to the lowest trial number."""
    order = F.struct(F.coalesce(F.col(metric), F.lit(-1.0)), -F.col("trial"))
    return history.agg(
        F.max_by("trial", order).alias("trial"),
        F.max_by("alpha", order).alias("alpha"),
        F.max_by(metric, order).alias("value"),
    )


def draw_configs(n_trials: int, seed: int = 42) -> list[NaiveBayesConfig]:
    """Seeded draws from the parameter space of the Naive Bayes recipe."""
    rng = random.Random(seed)
    return [
        NaiveBayesConfig(
            config_id=f"trial_{i}",
            alpha=10 ** rng.uniform(-3, 1),
            ngram_hi=rng.choice((1, 2)),
            min_df=rng.choice((1, 2, 5)),
            max_df=rng.choice((0.8, 0.9, 1.0)),
        )
        for i in range(n_trials)
    ]


TRIAL = "trial int, alpha double, ngram_hi int, min_df double, max_df double, norm string, accuracy double, precision double, recall double, f1 double, error string"


def draw_trials(n_trials: int, seed: int = 42) -> list[NaiveBayesConfig]:
    """Seeded draws over smoothing, n-grams, document-frequency bounds and norms; the first k of n draws are those of k."""
    rng = random.Random(seed)
    return [
        NaiveBayesConfig(
            config_id=str(i), alpha=10 ** rng.uniform(-3, 1), ngram_hi=rng.choice((1, 2)), min_df=rng.choice((1, 2, 5)),
            max_df=rng.choice((0.8, 0.9, 1.0)), features=TfidfParams(norm=rng.choice(("l1", "l2", None))),
        )
        for i in range(n_trials)
    ]


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """Finished trials of a sweep; empty before the first one."""
    try:
        return spark.read.schema(TRIAL).option("recursiveFileLookup", True).parquet(history)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], TRIAL)
        raise


def run_trials(train: DataFrame, test: DataFrame, trials: Sequence[NaiveBayesConfig], history: str) -> DataFrame:
    """Run the trials that ``history`` lacks, each one committed as a folder of its own; all finished trials. Runs jobs.

    A sweep that was stopped anywhere goes on where it was: a trial counts once its folder is written whole, and a left-anti join of the plan with the
    history names the rest. A trial that fails, or finds no vocabulary, scores 0.0 and keeps its message; the sweep goes on. The trials that are left
    share the numbered terms of their texts, which are made once for each token rule.
    """
    spark = train.sparkSession
    plan = spark.createDataFrame([(int(c.config_id),) for c in trials], "trial int")
    left = {r["trial"] for r in remaining_trials(plan, read_history(spark, history)).collect()}
    asked = [c for c in trials if int(c.config_id) in left]
    shared = _Tables([c for c in asked if c.alpha > 0], {})
    for config in asked:
        number = int(config.config_id)
        values, message = dict.fromkeys(METRICS, 0.0), None
        token = _TABLES.set(shared)
        try:
            found = evaluate_many(train, test, [config]).first()
            if found["f1"] is None:
                message = "no vocabulary is left"
            else:
                values = {m: float(found[m]) for m in METRICS}
        except Exception as error:  # one trial must not end the sweep
            message = str(error)[:500]
        finally:
            _TABLES.reset(token)
        row = (number, float(config.alpha), config.ngram_hi, float(config.min_df), float(config.max_df), config.features.norm, *values.values(), message)
        spark.createDataFrame([row], TRIAL).coalesce(1).write.mode("overwrite").parquet(f"{history}/trial={number}")
    return read_history(spark, history)
