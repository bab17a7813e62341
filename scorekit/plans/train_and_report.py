"""Job 3: baselines, search, leaderboard, refit of the best model and its evaluation tables."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.operators import calibrate, metrics, profile, reports, train as training
from scorekit.operators.encode import fit_preprocessor
from scorekit.session import stage


def run_leaderboard(df: DataFrame, features: Sequence[str], target: str,
                    kinds: Sequence[str] = ("lgbm", "logit"), n_trials: int = 10,
                    categorical: Sequence[str] = (), seed: int = 42,
                    spaces: dict[str, Callable[[random.Random], dict]] | None = None,
                    baseline_params: dict[str, dict] | None = None,
                    tables: dict[str, DataFrame] | None = None) -> list[training.Trial]:
    """Per kind: preparation fitted on train, a baseline and a seeded random search. The prepared table of each kind is left
    in ``tables``."""
    trials: list[training.Trial] = []
    tables = {} if tables is None else tables
    for kind in kinds:
        prepared = tables[kind] = prepare(df, features, categorical, kind)
        columns = [*features, *categorical]
        table = training.vector_table(prepared, columns, [target, "sample"])
        first, _ = training.baseline(table, columns, target, kind, (baseline_params or {}).get(kind))
        trials.append(first)
        trials += training.random_search(table, columns, target, kind, n_trials, seed,
                                         space=(spaces or {}).get(kind))
    return trials


def prepare(df: DataFrame, features: Sequence[str], categorical: Sequence[str], kind: str) -> DataFrame:
    """The kind's preprocessing, staged so that the fitting loops re-read a table."""
    recipe = kind if kind in ("lgbm", "xgboost", "logit") else "lgbm"
    fitted = fit_preprocessor(recipe, df.where(F.col("sample") == "train"), list(features), list(categorical))
    return stage(fitted.transform(df), f"prepared-{kind}", even=True)


def evaluate(scored: DataFrame, target: str, month: str, features: Sequence[str],
             quantiles: int = 10, n_correlated: int | None = None,
             samples: Sequence[str] = ("test", "val", "oot")) -> dict[str, DataFrame]:
    """Every evaluation table of a frame with ``sample``, PROBA and PRED. Correlations are those of all
    features, or of the first ``n_correlated``.

    Each report is built once for all samples and stored (key ``report``, ``ratings``, ...); ``report_test`` and the
    like are its rows of one sample. The number of jobs does not depend on the samples.
    """
    points = scored.withColumn("score", reports.score_points("PROBA"))
    train = scored.where(F.col("sample") == "train")
    tables = {
        "metrics_by_sample": metrics.metrics_by_sample(scored, "sample", target, "PROBA"),
        "metrics_over_time": metrics.metrics_over_time(scored, "sample", month, target, "PROBA"),
        "confusion": metrics.confusion_matrix(scored, target, "PRED", ["sample"]),
        "brier": metrics.brier_score(scored, "PROBA", target, ["sample"]),
        "histogram": reports.score_histogram(points, "score", target),
    }
    later = points.where(F.col("sample").isin(*samples))
    by_sample = {
        "report": metrics.classification_report(later, target, "PRED", ["sample"]),
        "ratings": reports.rating_tables(later, ["sample"], "PROBA", target, quantiles),
        "summary": reports.score_summaries(later, ["sample"], "score", target),
        "cohorts": reports.cohort_monitor(later, month, target, "score", keys=["sample"]),
        "correlation": profile.correlation_matrices(later, list(features)[:n_correlated], "sample"),
    }
    calibrators = {"isotonic": calibrate.fit_isotonic(train, "PROBA", target),
                   "sigmoid": calibrate.fit_sigmoid(train, "PROBA", target),
                   "quantile": calibrate.fit_quantile_transform(train, "PROBA")}
    for kind, curve in calibrators.items():
        by_sample[kind] = metrics.auc_and_ks(curve.transform(later, "PROBA"), "calibrated_prob", target, ["sample"])
    for kind, table in by_sample.items():
        tables[kind] = stage(table, f"report-{kind}")
        for name in samples:
            tables[f"{kind}_{name}"] = tables[kind].where(F.col("sample") == name).drop("sample")
    return tables


def train_and_report(df: DataFrame, features: Sequence[str], target: str, month: str,
                     metric: str = "AUC_PENALIZED", **search) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Leaderboard plus the evaluation tables of the refitted best model. The metric that picks the
    winner defaults to one that never looks at the out-of-time sample."""
    spark, prepared_tables = df.sparkSession, {}
    trials = run_leaderboard(df, features, target, tables=prepared_tables, **search)
    board = training.leaderboard(spark, trials)
    winner = reports.best_model(board, metric).first()
    chosen = next(t for t in trials if (t.model_name, t.trial) == (winner["MODEL_NAME"], winner["TRIAL_NUMBER"]))
    prepared = prepared_tables[chosen.model_name]
    fitted = training.fit_classifier(prepared.where(F.col("sample") == "train"), chosen.features, target,
                                     chosen.model_name, chosen.params)
    scored = stage(fitted.score(prepared), "scored")
    tables = evaluate(scored, target, month, chosen.features)
    tables["importance"] = reports.normalised_importance(training.importance_table(spark, fitted))
    return board, tables
