"""Exact discrimination and error metrics of a score, overall or per group, in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import finite, ratio, unpivot_structs
from scorekit.functions.order_stats import BUCKET, ordered_buckets, running_sums


def class_counts(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: combined map-side, so ties cost one row.

    Unusable rows are left out of the counts rather than filtered, so that derived scores and targets
    are evaluated once.
    """
    usable = F.col("score").isNotNull()
    return (df.select(*keys, finite(score).alias("score"), F.col(target).cast("int").alias("_y"))
            .groupBy(*keys, "score")
            .agg(F.count_if(usable & (F.col("_y") == 1)).alias("pos"),
                 F.count_if(usable & (F.col("_y") == 0)).alias("neg"))
            .where(F.col("pos") + F.col("neg") > 0))


def running_class_counts(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: class counts, their inclusive running sums and the totals.

    Columns: keys, score, pos, neg, cum_pos, cum_neg, tot_pos, tot_neg.
    """
    bucket = "score" + BUCKET
    counted = ordered_buckets(class_counts(df, score, target, keys), keys, "score").withColumnRenamed(BUCKET, bucket)
    return running_sums(counted, keys, bucket, "score", ["pos", "neg"]).drop(bucket)


def auc_expression() -> Column:
    """Share of correctly ordered (positive, negative) pairs, ties at half weight."""
    below = F.col("cum_neg") - F.col("neg") / 2
    return ratio(F.sum(F.col("pos") * below),
                 F.max("tot_pos").cast("double") * F.max("tot_neg").cast("double"))


def _share_gap() -> Column:
    return ratio(F.col("cum_neg"), F.col("tot_neg")) - ratio(F.col("cum_pos"), F.col("tot_pos"))


def ks_expression() -> Column:
    """Largest absolute gap between the class distribution functions."""
    return F.max(F.abs(_share_gap()))


def signed_ks_expressions() -> list[Column]:
    """Largest (negative share - positive share) and the first score that attains it. When no gap is
    positive the curve's anchor at 0 comes first, unless a score of exactly 0 exists."""
    best = F.max(F.struct(_share_gap().alias("gap"), (-F.col("score")).alias("at")))
    at_anchor = (best["gap"] == 0) & (F.min("score") != 0)
    return [best["gap"].alias("ks"),
            F.when(best["gap"].isNotNull(), F.when(at_anchor, F.lit(0.0)).otherwise(-best["at"]))
            .alias("threshold")]


def roc_auc(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC per group; NULL where only one class occurs."""
    return running_class_counts(df, score, target, keys).groupBy(*keys).agg(auc_expression().alias("auc"))


def ks_two_sided(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return running_class_counts(df, score, target, keys).groupBy(*keys).agg(ks_expression().alias("ks"))


def ks_signed(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return running_class_counts(df, score, target, keys).groupBy(*keys).agg(*signed_ks_expressions())


def auc_and_ks(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return (running_class_counts(df, score, target, keys).groupBy(*keys)
            .agg(auc_expression().alias("auc"), ks_expression().alias("ks")))


def ks_over_time(df: DataFrame, month: str, target: str, score: str,
                 keys: Sequence[str] = ()) -> DataFrame:
    """MONTH, KS and THRESHOLD in points; months with one class have NULL metrics."""
    return (ks_signed(df, score, target, [*keys, month])
            .select(*keys, F.col(month).alias("MONTH"), F.col("ks").alias("KS"),
                    (F.col("threshold") * 1000).alias("THRESHOLD")))


def auc_over_time(df: DataFrame, month: str, target: str, score: str,
                  keys: Sequence[str] = ()) -> DataFrame:
    return (roc_auc(df, score, target, [*keys, month])
            .select(*keys, F.col(month).alias("MONTH"), F.col("auc").alias("AUC")))


def metrics_by_sample(df: DataFrame, sample: str, target: str, score: str) -> DataFrame:
    """AUC and KS in percent for every sample: one job for all samples."""
    return (auc_and_ks(df, score, target, [sample])
            .select(sample, (F.col("auc") * 100).alias("auc"), (F.col("ks") * 100).alias("ks")))


def metrics_over_time(df: DataFrame, sample: str, month: str, target: str, score: str) -> DataFrame:
    """Signed KS, its threshold and AUC per sample and month, from one set of running counts."""
    counts = running_class_counts(df, score, target, [sample, month])
    return (counts.groupBy(sample, month)
            .agg(*signed_ks_expressions(), auc_expression().alias("auc"))
            .select(sample, F.col(month).alias("MONTH"), F.col("ks").alias("KS"),
                    (F.col("threshold") * 1000).alias("THRESHOLD"), F.col("auc").alias("AUC")))


def feature_auc(df: DataFrame, features: Sequence[str], target: str, fill_mean: bool = True) -> DataFrame:
    """Univariate rank AUC of every feature, direction-free (``greatest(auc, 1 - auc)``), in one job.

    Missing and infinite values take the mean of the finite ones.
    """
    from scorekit.operators.clean import fill_mean as fill
    filled = fill(df, features) if fill_mean else df
    entries = [F.struct(F.lit(f).alias("feature"), finite(f).alias("score")) for f in features]
    long = (unpivot_structs(filled, [F.col(target).cast("int").alias("_y")], entries)
            .where(F.col("score").isNotNull() & F.col("_y").isin(0, 1)))
    counted = (long.groupBy("feature", "score")
               .agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg")))
    auc = (running_sums(ordered_buckets(counted, ["feature"], "score"), ["feature"], BUCKET, "score", ["pos", "neg"])
           .groupBy("feature").agg(auc_expression().alias("auc")))
    return auc.select("feature", F.greatest("auc", 1 - F.col("auc")).alias("auc"))


def brier_score(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    error = F.col(score).cast("double") - F.col(target).cast("double")
    return df.groupBy(*keys).agg(F.avg(error * error).alias("brier"))


def confusion_matrix(df: DataFrame, target: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return (df.groupBy(*keys, F.col(target).cast("int").alias("actual"),
                       F.col(predicted).cast("int").alias("predicted"))
            .agg(F.count("*").alias("n")))


def classification_report(df: DataFrame, target: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows 0, 1, accuracy, macro avg, weighted avg (of every group of ``keys``); columns precision, recall, f1_score, support.

    Undefined ratios are 0 and the accuracy row repeats the accuracy in every column.
    """
    y, p = F.col(target).cast("int"), F.col(predicted).cast("int")
    cells = df.groupBy(*keys).agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    c = {(a, b): F.col(f"c{a}{b}").cast("double") for a in (0, 1) for b in (0, 1)}

    def share(top, bottom):
        return F.coalesce(ratio(top, bottom), F.lit(0.0))

    per_class = {}
    for k in (0, 1):
        hit, other = c[k, k], 1 - k
        precision, recall = share(hit, hit + c[other, k]), share(hit, hit + c[k, other])
        per_class[k] = (precision, recall, share(2 * precision * recall, precision + recall),
                        hit + c[k, other])
    total = per_class[0][3] + per_class[1][3]
    accuracy = share(c[0, 0] + c[1, 1], total)
    macro = [(per_class[0][i] + per_class[1][i]) / 2 for i in range(3)]
    weighted = [share(per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3], total)
                for i in range(3)]
    rows = {"0": per_class[0], "1": per_class[1], "accuracy": (accuracy,) * 4,
            "macro avg": (*macro, total), "weighted avg": (*weighted, total)}
    fields = ("precision", "recall", "f1_score", "support")
    entries = [F.struct(F.lit(name).alias("label"), *[v.alias(f) for v, f in zip(values, fields)])
               for name, values in rows.items()]
    return unpivot_structs(cells, keys, entries)


def penalised_auc(train: Column, test: Column, weight: float = 2.0) -> Column:
    """Mean of train and test AUC minus ``weight`` population standard deviations."""
    return (train + test) / 2 - F.lit(weight) * F.abs(train - test) / 2
