"""Job 2: the four-step feature filter, its removal report, and the model-driven refinement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import categorical_columns, numeric_columns
from scorekit.operators import clean, profile, reports, sample, select, target as targets, train as training
from scorekit.operators.encode import RankCountEncoder
from scorekit.session import stage
from scorekit.sources import writers

# Reasons written to the removal report; limits are filled in.
REASON_NULL = "High Percentage of Null Values (threshold: above {:.0%})"
REASON_IV = "Low Information Value (threshold: Less than {:g})"
REASON_CORRELATION = "High Correlation (threshold: above {:g})"
REASON_DRIFT = "Drift Treatment"
REASON_FORWARD = "Progressive Feature Elimination process"
REASON_PREFIX = ("Features with prefix NEW__ have been intentionally removed to align with project "
                 "requirements")


@dataclass(frozen=True)
class FilterLimits:
    null_ratio: float = 0.9
    information_value: float = 0.02
    correlation: float = 0.9
    keep_by: str = "var"
    bins: int = 10


@dataclass(frozen=True)
class FilterResult:
    features: list[str]
    report: DataFrame
    removed: list[tuple[list[str], str]]


def filter_static(train: DataFrame, target: str, ignore: Sequence[str] = (),
                  limits: FilterLimits = FilterLimits(), drop_derived: bool = False) -> FilterResult:
    """Null ratio, information value and correlation, in this order. Each step profiles only what the
    previous one left."""
    removed: list[tuple[list[str], str]] = []
    features = [c for c in train.columns if c not in set(ignore) and c != target]
    if drop_derived:
        _, derived = clean.drop_prefixed(train)
        features = [f for f in features if f not in set(derived)]
        removed.append((derived, REASON_PREFIX))

    def remove(names, reason):
        gone = set(names)
        removed.append(([f for f in features if f in gone], reason))
        return [f for f in features if f not in gone]

    features = remove(profile.high_missing(train.select(*features), target, limits.null_ratio),
                      REASON_NULL.format(limits.null_ratio))
    slim = train.select(*features, target)
    iv = profile.information_value(slim, target, bins=limits.bins)
    weak = iv.where(F.col("iv") < limits.information_value).collect()
    features = remove([r["variable"] for r in weak], REASON_IV.format(limits.information_value))
    numeric = numeric_columns(train.select(*features))
    if len(numeric) > 1:
        pairs = profile.correlated_pairs(train, limits.correlation, numeric)
        judged = (profile.drop_by_auc(train, pairs, numeric, target) if limits.keep_by == "auc"
                  else profile.drop_by_variance(train, pairs, numeric))
        drops = judged.select("drop_feature").distinct().collect()
        features = remove([r["drop_feature"] for r in drops], REASON_CORRELATION.format(limits.correlation))
    return FilterResult(features, reports.removal_report(train.sparkSession, removed), removed)


def select_by_filters(train: DataFrame, test: DataFrame, target: str, month: str,
                      ignore: Sequence[str] = (), limits: FilterLimits = FilterLimits(),
                      n_recent: int = 3, params: dict | None = None, max_rounds: int | None = None,
                      drop_derived: bool = False, done: DataFrame | None = None) -> FilterResult:
    """All four steps: the static filters, then encoding and adversarial drift. The distinct train rows and
    the encoded tables are staged, as every step reads them again. With the stored report of an earlier
    run (``done``) its features are out from the start and stay in the report."""
    train, _ = targets.coerce_target(clean.distinct_rows(train), target)
    train = stage(train, "select-train")
    test, _ = targets.coerce_target(test, target)
    before = [] if done is None else _reasons(done)
    static = filter_static(train, target, [*ignore, month, *[f for names, _ in before for f in names]], limits,
                           drop_derived)
    kept = [*static.features, target, month]
    slim_train, slim_test = train.select(*kept), clean.align_columns(test, train.select(*kept))
    texts = categorical_columns(slim_train, [target, month])
    if texts:
        encoder = RankCountEncoder(texts).fit(slim_train)
        slim_train, slim_test = encoder.transform(slim_train), encoder.transform(slim_test)
    slim_train, slim_test = stage(slim_train, "select-encoded"), stage(slim_test, "select-encoded")
    features = [f for f in static.features if f in numeric_columns(slim_train)]
    older, recent = sample.split_by_recency(slim_train, month, n_recent)
    drift = select.drift_elimination(older, recent, slim_test, features, target, params=params,
                                     max_rounds=max_rounds)
    drops = [r["feature"] for r in drift.collect()]
    removed = [*before, *static.removed, (drops, REASON_DRIFT)]
    return FilterResult([f for f in static.features if f not in set(drops)],
                        reports.removal_report(train.sparkSession, removed), removed)


def _reasons(report: DataFrame) -> list[tuple[list[str], str]]:
    """A stored removal report as (features, reason) in the form that filters return."""
    found: dict[str, list[str]] = {}
    for r in report.select("FEATURE_NAME", "REASON_FOR_REMOVAL").orderBy("FEATURE_NAME").collect():
        found.setdefault(r["REASON_FOR_REMOVAL"], []).append(r["FEATURE_NAME"])
    return [(names, reason) for reason, names in found.items()]


@dataclass(frozen=True)
class Refinement:
    """Outcome of the model-driven steps."""

    importance: DataFrame
    curve: DataFrame
    history: DataFrame
    features: list[str]
    report: DataFrame
    status: DataFrame
    selections: dict[str, list[str]]


def remaining_features(columns: Sequence[str], report: DataFrame, ignore: Sequence[str] = ()) -> list[str]:
    """Resume from a stored removal report: the columns it did not remove."""
    gone = {r["FEATURE_NAME"] for r in report.select("FEATURE_NAME").collect()} | set(ignore)
    return [c for c in columns if c not in gone]


def refine_features(df: DataFrame, features: Sequence[str], target: str, key: Sequence[str],
                    removed: Sequence[tuple[list[str], str]] = (), n_curve: int | None = None,
                    n_forward: int | None = None, step: int = 1, methods: Sequence[str] = (),
                    max_correlation: float = 0.8, kind: str = "lgbm", params: dict | None = None,
                    **method_options) -> Refinement:
    """Importance of a baseline, AUC and KS against the number of features, forward selection, and
    optionally several selection methods with Spearman pruning. ``n_curve`` and ``n_forward`` limit the
    features that are tried, most important first; a feature that was not tried is never dropped. ``df`` has a ``sample`` column; the
    encoder is fitted on train and the encoded table is staged for the fitting loops."""
    spark = df.sparkSession
    train = df.where(F.col("sample") == "train")
    texts = [c for c in categorical_columns(df) if c in set(features)]
    encoded = RankCountEncoder(texts).fit(train).transform(df) if texts else df
    table = stage(encoded.select(*dict.fromkeys([*key, target, "sample", *features])), "refine")
    train = table.where(F.col("sample") == "train")
    fitted = training.fit_classifier(train, features, target, kind, params)
    ranked = [f for f, _ in fitted.importance()]
    curve = select.progressive_curve(table, ranked[:n_curve], target, kind, params, step)
    history = select.forward_selection(table, ranked[:n_forward], target, kind, params)
    gone = {r["feature"] for r in history.where("NOT kept").collect()}
    dropped = [f for f in features if f in gone]
    reasons = [*removed, (dropped, REASON_FORWARD)]
    report = reports.removal_report(spark, reasons)
    everything = [f for names, _ in removed for f in names] + list(features)
    selections = {}
    if methods:
        selections = select.prune_correlated(
            train, select.select_features(train, features, target, key, methods, **method_options),
            target, max_correlation)
    return Refinement(training.importance_table(spark, fitted), curve, history,
                      [f for f in features if f not in gone], report,
                      reports.feature_status(spark, everything, report), selections)


def write_refined(spark, sources: dict[str, str], folder: str, refined: Refinement) -> None:
    """Rewrite every dataset without the removed features and store report, importance and lists."""
    gone = [r["FEATURE_NAME"] for r in refined.report.select("FEATURE_NAME").distinct().collect()]
    for name, path in sources.items():
        writers.rewrite_without(spark, path, f"{folder}/{name}", gone)
    writers.save_report(refined.report, f"{folder}/removal_report")
    writers.save_report(refined.importance, f"{folder}/feature_importance")
    writers.save_feature_list(spark, {"forward": refined.features, **refined.selections}, f"{folder}/features")
