"""Model-driven feature selection: drift, curves, forward, recursive, all-relevant, coordinator."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from scorekit.functions.columns import finite, hash32
from scorekit.operators import profile
from scorekit.operators.metrics import auc_and_ks
from scorekit.operators.sample import label_and_union
from scorekit.operators.train import (FIT_ROWS, VECTOR, VectorTable, assemble, fit_classifier, fit_rows, is_large, on_disk,
                                      sample_metrics, vector_table)

GROUP_ROWS = 4000  # rows among which values are exchanged
SWAP_STEPS = 8  # numbers of places between the rows that swap
PERIOD = 2 * math.lcm(*range(1, SWAP_STEPS + 1))
AT_ONCE = 3  # rounds of the shadow test that run beside each other
GROUP_SPREAD = 1.5  # tasks of a large table's groups for each FIT_ROWS rows, as they do not come evenly

# Drift AUC limit and tolerated relative loss of KS per round.
DRIFT_AUC = 0.55
KS_TOLERANCE = 0.03


def drift_elimination(older: DataFrame, recent: DataFrame, test: DataFrame, features: Sequence[str],
                      target: str, kind: str = "lgbm", params: dict | None = None,
                      max_auc: float = DRIFT_AUC, tolerance: float = KS_TOLERANCE,
                      max_rounds: int | None = None) -> DataFrame:
    """Adversarial drift removal, one row per round (round, feature, drift_auc, risk_ks).

    While a classifier tells recent from older rows (AUC above ``max_auc``), its most important
    feature is recorded; the loop goes on as long as the risk model's KS on ``test`` stays above
    (1 - tolerance) of the previous round's. The feature recorded last stays in the list.
    """
    spark = older.sparkSession
    both = vector_table(label_and_union(older.select(*features, target), recent.select(*features, target)), features, ["target_drift"])
    older, test = (vector_table(df, features, [target]) for df in (older, test))
    left, rows, previous = list(features), [], 0.0
    with fit_rows(both, "target_drift") as times, fit_rows(older, target) as risks:
        for number in range(1, (max_rounds or len(features)) + 1):
            if not left:
                break
            drift = fit_classifier(times, left, "target_drift", kind, params, seed=86)
            auc = auc_and_ks(drift.score(both), "PROBA", "target_drift").first()["auc"]
            if auc is None or auc <= max_auc:
                break
            risk = fit_classifier(risks, left, target, kind, params, seed=88)
            ks = auc_and_ks(risk.score(test), "PROBA", target).first()["ks"] or 0.0
            worst = drift.importance()[0][0]
            rows.append((number, worst, float(auc), float(ks)))
            left.remove(worst)
            if ks <= previous * (1 - tolerance):
                break
            previous = ks
    return spark.createDataFrame(rows, "round int, feature string, drift_auc double, risk_ks double")


def progressive_curve(df: DataFrame, ranked: Sequence[str], target: str, kind: str = "lgbm",
                      params: dict | None = None, step: int = 1) -> DataFrame:
    """AUC and KS on test and val against the number of features, most important first. All features
    are always the last point."""
    table = vector_table(df, ranked, [target, "sample"])
    train, judged = table.where(F.col("sample") == "train"), table.where(F.col("sample").isin("test", "val"))
    sizes = sorted({*range(step, len(ranked) + 1, step), len(ranked)} - {0})
    rows = []
    with fit_rows(train, target) as fitting:
        for n in sizes:
            m = sample_metrics(fit_classifier(fitting, ranked[:n], target, kind, params).score(judged), target)
            rows.append((n, *[m.get(s, (None, None))[i] for i in (0, 1) for s in ("test", "val")]))
    return df.sparkSession.createDataFrame(
        rows, "N_features int, test_auc double, val_auc double, test_ks double, val_ks double")


def forward_selection(df: DataFrame, ranked: Sequence[str], target: str, kind: str = "lgbm",
                      params: dict | None = None) -> DataFrame:
    """In importance order keep a feature when the test AUC does not fall below the best so far."""
    table = vector_table(df, ranked, [target, "sample"])
    train, test = table.where(F.col("sample") == "train"), table.where(F.col("sample") == "test")
    chosen, best, rows = [], 0.0, []
    with fit_rows(train, target) as fitting:
        for position, feature in enumerate(ranked, 1):
            fitted = fit_classifier(fitting, [*chosen, feature], target, kind, params)
            auc = auc_and_ks(fitted.score(test), "PROBA", target).first()["auc"]
            kept = auc is not None and auc >= best
            if kept:
                chosen, best = [*chosen, feature], auc
            rows.append((position, feature, float(auc or 0.0), kept, float(best)))
    return df.sparkSession.createDataFrame(
        rows, "position int, feature string, auc double, kept boolean, best_auc double")


def recursive_elimination(train: DataFrame, features: Sequence[str], target: str,
                          sizes: Sequence[int], steps: int = 50, kind: str = "catboost",
                          params: dict | None = None) -> dict[str, list[str]]:
    """Fit, drop the least important features, repeat; the lists at the wanted sizes are recorded."""
    left, found = list(features), {}
    with fit_rows(vector_table(train, features, [target]), target) as rows:
        for size in sorted({min(s, len(features)) for s in sizes}, reverse=True):
            per_step = max(1, math.ceil((len(left) - size) / steps))
            while len(left) > size:
                ranking = [f for f, _ in fit_classifier(rows, left, target, kind, params, seed=0).importance()]
                left = ranking[:max(size, len(left) - per_step)]
            found[f"catboost_top{size}"] = list(left)
    return found


# all-relevant selection --------------------------------------------------------------------------

def shuffled_copies(df: DataFrame, features: Sequence[str], key: Sequence[str], seed: int) -> DataFrame:
    """Add ``shadow_<feature>`` columns: each feature's values exchanged between rows.

    Rows are dealt into groups of about GROUP_ROWS by a hash of their key and ordered by another. Every
    feature swaps the values of rows that stand a few places apart, each feature another few. This depends
    on the rows alone, not on batches or partitions, so a retried task gives the same copies.
    """
    groups = max(1, df.count() // GROUP_ROWS)
    order = Window.partitionBy("_group").orderBy("_place", *key)
    dealt = df.withColumns({"_group": hash32(*key, seed=seed) % groups, "_place": hash32(*key, seed=-seed - 1)})

    def shadow(step, f):
        own = F.struct(finite(f).alias("v"))
        forward = F.floor((F.row_number().over(order) - 1) / step) % 2 == 0
        swapped = F.when(forward, F.coalesce(F.lead(own, step).over(order), own)).otherwise(F.lag(own, step).over(order))
        return swapped["v"].alias(f"shadow_{f}")
    return dealt.select(*df.columns, *[shadow(1 + i % SWAP_STEPS, f) for i, f in enumerate(features)])


def spread_copies(df: DataFrame, features: Sequence[str], key: Sequence[str], seed: int, keep: Sequence[str], rows: int) -> DataFrame:
    """The columns ``keep``, the finite values of the features and their shadows, as ``shuffled_copies`` makes them, for large
    tables: groups are dealt over as many tasks as ``rows``, the number of rows, asks for, and values swap in Arrow
    batches of the sorted groups instead of by two window frames for each feature."""
    groups = max(1, rows // GROUP_ROWS)
    place = (hash32(*key, seed=seed) % groups) * F.lit(1 << 32) + hash32(*key, seed=-seed - 1)
    names = [*keep, *features, *[f"shadow_{f}" for f in features]]
    schema = StructType([*df.select(*keep).schema, *[StructField(n, DoubleType()) for n in names[len(keep):]]])
    dealt = (df.select(*dict.fromkeys([*key, *keep]), place.alias("_place"), *[finite(f).alias(f"_own_{i}") for i, f in enumerate(features)])
             .withColumn("_group", F.shiftright("_place", 32)).repartition(math.ceil(GROUP_SPREAD * rows / FIT_ROWS), "_group")
             .sortWithinPartitions("_place", *key).select(*keep, "_place", *[f"_own_{i}" for i in range(len(features))]))

    def swapped(batch: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        n, own = len(group), batch.columns[len(keep) + 1:]
        at = np.arange(n)
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        place = at - np.repeat(cuts, np.diff(np.append(cuts, n)))
        shadows = []
        for i in range(len(features)):
            step = 1 + i % SWAP_STEPS
            other = np.where(place // step % 2 == 0, at + step, at - step)
            there = np.minimum(other, n - 1)
            shadows.append(own[i].take(pa.array(np.where((other < n) & (group[there] == group), there, at))))
        return pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *own, *shadows], names=names)

    def swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group. Every PERIOD rows of a group are a whole number of swaps for every step, so what a
        batch leaves to the next is less than that."""
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            group = batch.column(len(keep)).to_numpy(zero_copy_only=False) >> 32
            last = int(np.searchsorted(group, group[-1]))
            done = last + (len(group) - last) // PERIOD * PERIOD
            if done:
                yield swapped(batch.slice(0, done), group[:done])
            held = batch.slice(done)
        if held is not None and held.num_rows:
            yield swapped(held, held.column(len(keep)).to_numpy(zero_copy_only=False) >> 32)

    return dealt.mapInArrow(swap, schema)


def _binomial_tail(hits: int, trials: int) -> float:
    """P(X >= hits) for X ~ Binomial(trials, 1/2)."""
    return sum(math.comb(trials, i) for i in range(hits, trials + 1)) / 2 ** trials


def all_relevant(train: DataFrame, features: Sequence[str], target: str, key: Sequence[str],
                 percentiles: Sequence[int] = (100,), rounds: int = 20, alpha: float = 0.05,
                 params: dict | None = None, seed: int = 0) -> DataFrame:
    """Shadow-feature test: a feature is hit in a round when its forest importance exceeds the given
    percentile of the shadows'. Hits are judged by a Bonferroni-corrected binomial test.

    The vectors of a round are stored, dealt evenly. Those of a large table stay where the exchange of values put them, kept on
    disk for the round: it has dealt them already. Its rounds fill the cores, and run one by one: their fits would push
    each other's rows out of memory.

    Returns (percentile, feature, hits, decision).
    """
    features = list(features)
    hits = {p: dict.fromkeys(features, 0) for p in percentiles}
    forest = {"numTrees": 20, "maxDepth": 5, **(params or {})}
    base = train.select(*dict.fromkeys([*key, target, *features]))
    columns = features + [f"shadow_{f}" for f in features]
    count = base.count()
    large = is_large(train.sparkSession, count)

    def scores(number: int) -> dict[str, float]:
        if large:
            copies = spread_copies(base, features, key, seed + number, [target], count)
            with on_disk(assemble(copies, columns).select(target, VECTOR)) as rows:
                return dict(fit_classifier(VectorTable(rows, columns), columns, target, "forest", forest, seed + number).importance())
        mixed = vector_table(shuffled_copies(base, features, key, seed + number), columns, [target])
        return dict(fit_classifier(mixed, columns, target, "forest", forest, seed + number).importance())

    with ThreadPool(1 if large else AT_ONCE) as pool:  # rounds do not depend on each other
        found = pool.map(inheritable_thread_target(train.sparkSession)(scores), range(rounds), chunksize=1)
    for score in found:
        shadow = [score[f"shadow_{f}"] for f in features]
        for p in percentiles:
            bar = float(np.percentile(shadow, p))
            for f in features:
                hits[p][f] += score[f] > bar
    rows = []
    for p in percentiles:
        for f in features:
            h, tests = hits[p][f], len(features)
            if _binomial_tail(h, rounds) * tests <= alpha:
                decision = "confirmed"
            elif _binomial_tail(rounds - h, rounds) * tests <= alpha:
                decision = "rejected"
            else:
                decision = "tentative"
            rows.append((int(p), f, int(h), decision))
    return train.sparkSession.createDataFrame(
        rows, "percentile int, feature string, hits int, decision string")


# coordinator -------------------------------------------------------------------------------------

def select_features(train: DataFrame, features: Sequence[str], target: str, key: Sequence[str],
                    methods: Sequence[str] = ("catboost", "boruta", "mrmr"),
                    recursive_sizes: Sequence[int] = (25,), percentiles: Sequence[int] = (100,),
                    mrmr_sizes: Sequence[int] = (25,), drop: Sequence[str] = (),
                    model_params: dict | None = None, rounds: int = 20,
                    steps: int = 50) -> dict[str, list[str]]:
    """Run the chosen methods: {method and size: features}."""
    features = [f for f in features if f not in set(drop) and f != target]
    found: dict[str, list[str]] = {}
    if "catboost" in methods:
        found.update(recursive_elimination(train, features, target, recursive_sizes, steps,
                                           params=model_params))
    if "boruta" in methods:
        verdict = all_relevant(train, features, target, key, percentiles, rounds).collect()
        for p in percentiles:
            good = {r["feature"] for r in verdict if r["percentile"] == p and r["decision"] == "confirmed"}
            found[f"boruta_{p}perc"] = [f for f in features if f in good]
    if "mrmr" in methods:
        ranking = profile.mrmr_ranking(train, features, target, max(mrmr_sizes))
        found.update({f"mrmr_top{n}": ranking[:n] for n in mrmr_sizes})
    return found


def prune_correlated(train: DataFrame, selections: dict[str, list[str]], target: str,
                     threshold: float = 0.8) -> dict[str, list[str]]:
    """Spearman pruning of every selected list."""
    out = {}
    for method, names in selections.items():
        drops = set()
        if len(names) > 1:
            table = profile.smart_correlated_drops(train, names, target, threshold)
            drops = {r["feature"] for r in table.where("dropped").collect()}
        out[method] = [f for f in names if f not in drops]
    return out
