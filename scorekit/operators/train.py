"""Classifier training, scoring, evaluation and search on Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import finite, unpivot_structs
from scorekit.operators.clean import MISSING_NUMBER
from scorekit.operators.metrics import auc_and_ks
from scorekit.session import stage

VECTOR = "_features"
ALL_VECTOR, WEIGHT = "_all_features", "_weight"
SAMPLES = ("train", "test", "val", "oot")
FIT_ROWS = 500_000  # most rows that a task of a fit holds, about

# Spark ML estimators standing in for the usual gradient-boosting libraries; "logit" is a regression.
KINDS = ("lgbm", "xgboost", "catboost", "forest", "logit")


def assemble(df: DataFrame, features: Sequence[str], missing: float | None = MISSING_NUMBER) -> DataFrame:
    """Add the feature vector; missing values take a constant outside the usual range."""
    fill = F.lit(float(missing)) if missing is not None else F.lit(0.0)
    staged = df.select("*", *[F.coalesce(finite(c), fill).alias(f"_v_{i}") for i, c in enumerate(features)])
    names = [f"_v_{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=names, outputCol=VECTOR).transform(staged).drop(*names)


@dataclass(frozen=True)
class VectorTable:
    """A stored table with one assembled vector of many features, for loops that fit and score some of them at a time. Views
    slice the stored vector, so no fit assembles anything. With ``dealt`` the rows are those of ``fit_rows``."""

    rows: DataFrame
    features: Sequence[str]
    dealt: bool = False

    def where(self, condition) -> VectorTable:
        return VectorTable(self.rows.where(condition), self.features)

    def view(self, features: Sequence[str]) -> DataFrame:
        """The rows with the vector of some features, in their order."""
        if list(features) == list(self.features):
            return self.rows
        place = {f: i for i, f in enumerate(self.features)}
        slicer = VectorSlicer(inputCol=ALL_VECTOR, outputCol=VECTOR, indices=[place[f] for f in features])
        return slicer.transform(self.rows.withColumnRenamed(VECTOR, ALL_VECTOR)).drop(ALL_VECTOR)


def vector_table(df: DataFrame | VectorTable, features: Sequence[str], keep: Sequence[str]) -> VectorTable:
    """Assemble ``features`` once and store them with the columns ``keep``, rows dealt evenly. A vector table stays as it is."""
    if isinstance(df, VectorTable):
        return df
    return VectorTable(stage(assemble(df, features).select(*dict.fromkeys(keep), VECTOR), "vectors", even=True), list(features))


def _vectors(df: DataFrame | VectorTable, features: Sequence[str]) -> DataFrame:
    return df.view(features) if isinstance(df, VectorTable) else assemble(df, features)


def make_classifier(kind: str, target: str, params: dict | None = None, seed: int = 42):
    params = {k: v for k, v in (params or {}).items() if k != "n_features"}
    balanced = params.pop("class_weight", None)
    if balanced not in (None, "balanced"):
        raise ValueError(f"class_weight is None or 'balanced', not {balanced!r}")
    common = dict(featuresCol=VECTOR, labelCol=target, predictionCol="PRED")
    estimators = {"lgbm": GBTClassifier, "xgboost": GBTClassifier, "catboost": GBTClassifier,
                  "forest": RandomForestClassifier, "logit": LogisticRegression}
    if kind in estimators:
        if kind != "logit":
            common["seed"] = seed
        estimator = estimators[kind](**common, **params, **({"weightCol": WEIGHT} if balanced else {}))
        return estimator.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    raise ValueError(f"unknown classifier {kind!r}; known: {KINDS}")


@dataclass(frozen=True)
class Classifier:
    """A fitted model together with its feature order."""

    kind: str
    features: Sequence[str]
    target: str
    model: object

    def score(self, df: DataFrame | VectorTable) -> DataFrame:
        """Add PROBA (probability of class 1) and PRED."""
        scored = self.model.transform(_vectors(df, self.features))
        return (scored.withColumn("PROBA", vector_to_array("_probability")[1])
                .withColumn("PRED", F.col("PRED").cast("int")).drop(VECTOR, "_probability", "_raw"))

    def importance(self, signed: bool = False) -> list[tuple[str, float]]:
        """Model importance per feature, largest first: impurity gain, or the coefficients."""
        if self.kind == "logit":
            values = [float(v) for v in self.model.coefficients]
            values = values if signed else [abs(v) for v in values]
        else:
            values = [float(v) for v in self.model.featureImportances.toArray()]
        return sorted(zip(self.features, values), key=lambda fv: (-fv[1], fv[0]))


def class_weights(data: DataFrame, target: str) -> DataFrame:
    """Add WEIGHT, rows / (2 * rows of the class), from one count: both classes weigh the same in all."""
    counts = {int(r[0]): r["count"] for r in data.groupBy(F.col(target).cast("int")).count().collect()}
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for label, n in counts.items():
        weight = F.when(F.col(target) == label, F.lit(total / (len(counts) * n))).otherwise(weight)
    return data.withColumn(WEIGHT, weight)


def is_large(spark, rows: int) -> bool:
    """Whether a table dealt evenly over the cores has more than FIT_ROWS rows a task."""
    return rows > FIT_ROWS * spark.sparkContext.defaultParallelism


def spread_rows(data: DataFrame) -> DataFrame:
    """Deal rows over as many tasks as their number asks for, where one would hold more than FIT_ROWS: a fit keeps its rows in memory
    and reads them in every pass. A task's rows are put in an order of their own, as fits draw split candidates by position.
    Tables whose tasks hold less stay as they are."""
    held = data.groupBy(F.spark_partition_id().alias("_task")).agg(F.count("*").alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("all")).first()
    if (held["top"] or 0) <= FIT_ROWS:
        return data
    return data.repartition(math.ceil(held["all"] / FIT_ROWS)).sortWithinPartitions(F.xxhash64(*data.columns))


@contextmanager
def on_disk(data: DataFrame) -> Iterator[DataFrame]:
    """``data`` evaluated once and kept on the executors' disks, task by task as it comes, until the block ends. What an executor
    takes with it is made again. The memory stays with the fits, which keep several copies of their rows there."""
    kept = data.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def fit_rows(table: VectorTable, target: str) -> Iterator[VectorTable]:
    """The rows whose target is 0 or 1, with all features of the table, for one fit or all fits of a loop. They are dealt once, and kept
    where they were dealt: a fit reads them several times, and would shuffle and order them each time."""
    if table.dealt:
        yield table
        return
    rows = table.rows.where(F.col(target).isin(0, 1)).select(VECTOR, F.col(target).cast("double").alias(target))
    spread = spread_rows(rows)
    if spread is rows:
        yield VectorTable(rows, table.features, dealt=True)
        return
    with on_disk(spread) as kept:
        yield VectorTable(kept, table.features, dealt=True)


def fit_classifier(train: DataFrame | VectorTable, features: Sequence[str], target: str, kind: str = "lgbm",
                   params: dict | None = None, seed: int = 42) -> Classifier:
    """Fit on the rows whose target is 0 or 1. The parameter ``class_weight`` is None or "balanced"; the others are the
    estimator's. Rows of a vector table are dealt with all of its features, so fits on some of them find each row in the same
    place."""
    estimator = make_classifier(kind, target, params, seed)
    table = train if isinstance(train, VectorTable) else VectorTable(assemble(train, features), features)
    with fit_rows(table, target) as dealt:
        data = dealt.view(features).select(VECTOR, target)
        if (params or {}).get("class_weight"):
            data = class_weights(data, target)
        return Classifier(kind, list(features), target, estimator.fit(data))


def importance_table(spark, classifier: Classifier, signed: bool = False) -> DataFrame:
    return spark.createDataFrame(classifier.importance(signed), "feature string, importance double")


def sample_metrics(scored: DataFrame, target: str, sample: str = "sample") -> dict[str, tuple]:
    """{sample: (AUC, KS)} for all samples from one job."""
    rows = auc_and_ks(scored, "PROBA", target, [sample]).collect()
    return {r[sample]: (r["auc"], r["ks"]) for r in rows}


def penalise(train: float, test: float, weight: float) -> float:
    return (train + test) / 2 - weight * abs(train - test) / 2


@dataclass(frozen=True)
class Trial:
    """One leaderboard entry."""

    model_name: str
    trial: str
    metrics: dict[str, tuple]
    penalised: float
    params: dict
    features: Sequence[str]

    def row(self) -> tuple:
        auc = [self.metrics.get(s, (None, None))[0] for s in ("train", "test")]
        rest = [self.metrics.get(s, (None, None))[0] for s in ("val", "oot")]
        return (self.model_name, self.trial, *auc, self.penalised, *rest,
                {k: str(v) for k, v in self.params.items()}, list(self.features))


LEADERBOARD_SCHEMA = ("MODEL_NAME string, TRIAL_NUMBER string, AUC_TRAINING double, AUC_TEST double, "
                      "AUC_PENALIZED double, AUC_VAL double, AUC_OOT double, "
                      "PARAMS map<string,string>, FEATURES array<string>")


def leaderboard(spark, trials: Sequence[Trial]) -> DataFrame:
    return spark.createDataFrame([t.row() for t in trials], LEADERBOARD_SCHEMA)


def baseline(df: DataFrame | VectorTable, features: Sequence[str], target: str, kind: str = "logit",
             params: dict | None = None, weight: float = 2.0) -> tuple[Trial, Classifier]:
    """Fit on the train rows of a frame with a ``sample`` column and judge all samples at once."""
    table = vector_table(df, features, [target, "sample"])
    fitted = fit_classifier(table.where(F.col("sample") == "train"), features, target, kind, params)
    metrics = sample_metrics(fitted.score(table), target)
    score = penalise(metrics["train"][0], metrics["test"][0], weight)
    return Trial(kind, "baseline", metrics, score, params or {}, features), fitted


# search ------------------------------------------------------------------------------------------

def _log_uniform(rng, low, high):
    return math.exp(rng.uniform(math.log(low), math.log(high)))


def search_space(kind: str) -> Callable[[random.Random], dict]:
    """Random parameter sets per kind, over the ranges that Spark ML has a counterpart for."""
    # Ranges as (low, high) or (low, high, step).
    def boosting(depth_low, depth_high):
        return lambda rng: {
            "stepSize": _log_uniform(rng, 0.01, 0.2), "maxIter": rng.randrange(100, 1001, 100),
            "maxDepth": rng.randint(depth_low, depth_high), "minInstancesPerNode": rng.randrange(50, 501, 5),
            "subsamplingRate": rng.uniform(0.5, 1.0), "minInfoGain": rng.uniform(0.0, 0.01),
            "featureSubsetStrategy": f"{rng.uniform(0.4, 0.999):.3f}"}
    spaces = {
        "lgbm": boosting(5, 10), "xgboost": boosting(3, 10), "catboost": boosting(2, 10),
        "forest": lambda rng: {"numTrees": rng.randrange(20, 201, 10), "maxDepth": rng.randint(4, 12),
                               "subsamplingRate": rng.uniform(0.5, 1.0)},
        "logit": lambda rng: {"regParam": 1.0 / _log_uniform(rng, 1e-2, 1e3),
                              "elasticNetParam": rng.uniform(0.0, 1.0),
                              "maxIter": rng.randint(100, 800), "tol": rng.uniform(1e-5, 1e-2),
                              "fitIntercept": rng.random() < 0.5,
                              "class_weight": rng.choice([None, "balanced"])}}
    return spaces[kind]


def random_search(df: DataFrame | VectorTable, features: Sequence[str], target: str, kind: str = "lgbm",
                  n_trials: int = 10, seed: int = 42, weight: float = 5.0,
                  space: Callable[[random.Random], dict] | None = None) -> list[Trial]:
    """Seeded random search. A trial fits once on all features, ranks them, keeps a random number of
    the best, refits, and is judged by the penalised train / test AUC. All fits and scores read one
    vector table, assembled once."""
    rng = random.Random(seed)
    space = space or search_space(kind)
    table = vector_table(df, features, [target, "sample"])
    train = table.where(F.col("sample") == "train")
    trials = []
    with fit_rows(train, target) as rows:
        for number in range(n_trials):
            params = space(rng)
            first = fit_classifier(rows, features, target, kind, params)
            chosen = [f for f, _ in first.importance()][:rng.randint(1, len(features))]
            fitted = fit_classifier(rows, chosen, target, kind, params)
            metrics = sample_metrics(fitted.score(table), target)
            trials.append(Trial(kind, str(number), metrics,
                                penalise(metrics["train"][0], metrics["test"][0], weight), params, chosen))
    return trials


def best_trial(trials: Sequence[Trial]) -> Trial:
    return max((t for t in trials if t.trial != "baseline"), key=lambda t: t.penalised)


# importance --------------------------------------------------------------------------------------

def linear_importance(df: DataFrame, coefficients: dict[str, float], signed: bool = False) -> DataFrame:
    """Mean |coef * (x - mean x)| per feature - the mean absolute Shapley value of a linear model with
    independent features - or the signed coefficients themselves."""
    names = list(coefficients)
    if signed:
        return df.sparkSession.createDataFrame([(n, float(coefficients[n])) for n in names],
                                               "feature string, importance double")
    means = df.agg(*[F.avg(finite(n)).alias(n) for n in names]).first()
    row = df.agg(*[F.avg(F.abs(F.lit(float(coefficients[n])) * (finite(n) - F.lit(means[n])))).alias(n)
                   for n in names])
    return unpivot_structs(row, [], [F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance"))
                                     for n in names])


def permutation_importance(df: DataFrame, classifier: Classifier, key: Sequence[str],
                           seed: int = 7) -> DataFrame:
    """Loss of AUC when one feature is exchanged between rows.

    The exchange reuses the shadow columns of ``shuffled_copies``: one extra shuffle for all features. Every row is then
    scored once as it is and once per feature with that slot of its vector exchanged, in one pass whose plan does
    not grow with the features, and one AUC job judges all of them.
    """
    from scorekit.operators.select import shuffled_copies
    features, missing = list(classifier.features), F.lit(float(MISSING_NUMBER))
    mixed = stage(shuffled_copies(df, features, key, seed), "swapped")
    own, shadow = (F.array(*[F.coalesce(finite(prefix + f), missing) for f in features]) for prefix in ("", "shadow_"))
    slots = F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1)))  # -1: the row as it is
    rows = mixed.select(classifier.target, own.alias("_own"), shadow.alias("_shadow"), slots.alias("_slot"))
    exchanged = F.transform("_own", lambda x, i: F.when(i == F.col("_slot"), F.get("_shadow", i)).otherwise(x))
    scored = classifier.model.transform(rows.select(classifier.target, "_slot", array_to_vector(exchanged).alias(VECTOR)))
    judged = scored.select("_slot", vector_to_array("_probability")[1].alias("PROBA"), classifier.target)
    found = {r["_slot"]: r["auc"] for r in auc_and_ks(judged, "PROBA", classifier.target, ["_slot"]).collect()}
    losses = [(f, float(found[-1] - found[i])) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(losses, "feature string, importance double")
