"""Tables behind the usual scorecard reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import bin_index, finite, unpivot_structs
from scorekit.functions.order_stats import exact_quantiles, grouped_quantiles
from scorekit.functions.skew import key_text
from scorekit.operators.metrics import auc_expression, ks_expression, running_class_counts
from scorekit.session import lookup_join

SCORE_SCALE = 1000
DECILES = [i / 10 for i in range(1, 10)]


def score_points(probability) -> Column:
    """(1 - p) * 1000: the higher the safer."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return (1 - p) * SCORE_SCALE


def rating_table(df: DataFrame, probability: str, target: str, quantiles: int = 10) -> DataFrame:
    """Bad rate and volume per rating R1..Rq in ascending score; equal quantile edges merge."""
    scored = df.select(score_points(probability).alias("_score"), F.col(target).cast("int").alias("_y")) \
        .where(F.col("_score").isNotNull())
    edges = exact_quantiles(scored, ["_score"], [i / quantiles for i in range(quantiles + 1)])["_score"]
    inner = sorted({e for e in edges if e is not None})[1:-1]
    bands = (scored.groupBy(bin_index(F.col("_score"), inner).alias("band"))
             .agg(F.avg("_y").alias("bad_rate"), F.count("*").alias("volume")))
    return bands.select(F.concat(F.lit("R"), (F.col("band") + 1).cast("string")).alias("rating"),
                        "bad_rate", "volume")


def rating_tables(df: DataFrame, keys: Sequence[str], probability: str, target: str, quantiles: int = 10) -> DataFrame:
    """``rating_table`` of every group of ``keys``, from one set of quantiles: keys, rating, bad_rate, volume."""
    scored = (df.select(*keys, score_points(probability).alias("_score"), F.col(target).cast("int").alias("_y"))
              .where(F.col("_score").isNotNull()))
    found = grouped_quantiles(scored, keys, ["_score"], [i / quantiles for i in range(quantiles + 1)])
    edges = (found.groupBy(key_text(keys).alias("_group")).agg(F.sort_array(F.collect_set("value")).alias("_edges"))
             .withColumn("_edges", F.slice("_edges", 2, F.greatest(F.size("_edges") - 2, F.lit(0)))))
    placed = lookup_join(scored.withColumn("_group", key_text(keys)), edges, "_group", "inner")
    band = F.size(F.filter("_edges", lambda e: e < F.col("_score")))
    bands = placed.groupBy(*keys, band.alias("band")).agg(F.avg("_y").alias("bad_rate"), F.count("*").alias("volume"))
    return bands.select(*keys, F.concat(F.lit("R"), (F.col("band") + 1).cast("string")).alias("rating"), "bad_rate", "volume")


def score_summaries(df: DataFrame, keys: Sequence[str], score: str, target: str) -> DataFrame:
    """``score_summary`` of every group of ``keys``, from one set of quantiles."""
    clean = (df.select(*keys, F.col(target).cast("int").alias("class"), finite(score).alias("_score"))
             .where(F.col("class").isin(0, 1) & F.col("_score").isNotNull()))
    by = [*keys, "class"]
    basic = clean.groupBy(*by).agg(F.count("_score").alias("count"), F.avg("_score").alias("mean"), F.stddev("_score").alias("std"),
                                   F.min("_score").alias("min"), F.max("_score").alias("max"))
    deciles = grouped_quantiles(clean, by, ["_score"], DECILES).groupBy(key_text(by).alias("_group")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{10 * (i + 1)}") for i, p in enumerate(DECILES)])
    joined = lookup_join(basic.withColumn("_group", key_text(by)), deciles, "_group", "inner")
    return joined.select(*by, "count", "mean", "std", "min", *[f"p{10 * (i + 1)}" for i in range(9)], "max")


def score_summary(df: DataFrame, score: str, target: str) -> DataFrame:
    """count, mean, std, min, p10..p90 and max of the score per class."""
    y = F.col(target).cast("int")
    by_class = df.select(*[F.when(y == k, finite(score)).alias(f"c{k}") for k in (0, 1)])
    deciles = exact_quantiles(by_class, ["c0", "c1"], DECILES)
    basic = by_class.agg(*[e.alias(f"{name}_{k}") for k in (0, 1) for name, e in (
        ("count", F.count(f"c{k}")), ("mean", F.avg(f"c{k}")), ("std", F.stddev(f"c{k}")),
        ("min", F.min(f"c{k}")), ("max", F.max(f"c{k}")))])
    entries = [F.struct(
        F.lit(k).alias("class"), *[F.col(f"{n}_{k}").alias(n) for n in ("count", "mean", "std", "min")],
        *[F.lit(q).cast("double").alias(f"p{10 * (i + 1)}") for i, q in enumerate(deciles[f"c{k}"])],
        F.col(f"max_{k}").alias("max")) for k in (0, 1)]
    return unpivot_structs(basic, [], entries)


def score_histogram(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """Volume per class and equal-width score band on [0, 1000]; the top edge belongs to the last."""
    band = F.least(F.width_bucket(F.col(score), F.lit(0.0), F.lit(float(SCORE_SCALE)), F.lit(bins)),
                   F.lit(bins))
    return (df.groupBy(F.col(target).cast("int").alias("class"), band.cast("int").alias("band"))
            .agg(F.count("*").alias("n")))


def cohort_monitor(df: DataFrame, month: str, target: str, score: str, label: str = "score",
                   keys: Sequence[str] = ()) -> DataFrame:
    """Volume, bad rate, AUC and KS per cohort month (of every group of ``keys``), for a score where high means safe."""
    by = [*keys, month]
    volume = df.groupBy(*by).agg(
        F.count("*").alias("qtd"), F.round(F.avg(F.col(target).cast("double")) * 100, 2).alias("inad"))
    quality = (running_class_counts(df, score, target, by).groupBy(*by)
               .agg((100 - auc_expression() * 100).alias("auc"), (ks_expression() * 100).alias("ks")))
    return volume.join(quality, by, "left").select(*keys, F.lit(label).alias("modelo"), month,
                                                   "qtd", "inad", "auc", "ks")


def volumetry(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def normalised_importance(importance: DataFrame, top: int | None = None) -> DataFrame:
    """Importance as a percentage of the total (input: one row per feature), largest first; the ``top`` of
    them if a number is given."""
    total = importance.agg(F.sum("importance")).scalar()
    ranked = (importance.select("feature", (F.col("importance") / total * 100).alias("importance"))
              .orderBy(F.desc("importance"), "feature"))
    return ranked if top is None else ranked.limit(top)


def top_features(importance: DataFrame, n: int) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def most_important(importance: DataFrame) -> DataFrame:
    """The single most important feature (first name on ties)."""
    order = F.struct((-F.col("importance")).alias("i"), F.col("feature"))
    return importance.agg(F.min_by("feature", order).alias("feature"),
                          F.max("importance").alias("importance"))


def first_columns(df: DataFrame, n: int = 500) -> DataFrame:
    return df.select(*df.columns[:n])


def best_model(leaderboard: DataFrame, metric: str = "AUC_PENALIZED") -> DataFrame:
    """The best tuned row; the baselines do not compete."""
    return (leaderboard.where(F.col("TRIAL_NUMBER") != "baseline")
            .orderBy(F.desc(metric), "MODEL_NAME", "TRIAL_NUMBER").limit(1))


# removal report ----------------------------------------------------------------------------------

REMOVAL_SCHEMA = "FEATURE_NAME string, REASON_FOR_REMOVAL string"


def removal_report(spark, removed: Sequence[tuple[Sequence[str], str]]) -> DataFrame:
    """(features, reason) groups as one table."""
    return spark.createDataFrame([(f, reason) for names, reason in removed for f in names], REMOVAL_SCHEMA)


def feature_status(spark, features: Sequence[str], report: DataFrame,
                   ignore: Sequence[str] = ()) -> DataFrame:
    """Every feature with its removal reason and a 0/1 drop flag."""
    kept = [(f,) for f in features if f not in set(ignore)]
    return (spark.createDataFrame(kept, "FEATURE_NAME string").join(report, "FEATURE_NAME", "left")
            .withColumn("DROP_COL", F.col("REASON_FOR_REMOVAL").isNotNull().cast("int")))


def status_counts(status: DataFrame) -> DataFrame:
    label = F.when(F.col("DROP_COL") == 1, "Dropped").otherwise("Not Dropped")
    return status.groupBy(label.alias("drop_status")).agg(F.count("*").alias("n"))
