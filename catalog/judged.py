"""Score metrics and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import auc_sql
from catalog.tables import (FEATURES, NUMERIC_FEATURES, ROW_KEY, SAMPLED, SCORED, Query, feature_frame,
                            load, r, rounded, rs, scored, stored, with_)
from scorekit.operators import metrics, reports


def _rank_auc(y="target", rk="rk"):
    return (f"(sum(CASE WHEN {y} = 1 THEN {rk} END) - sum({y}) * (sum({y}) + 1) / 2.0)"
            f" / nullif(CAST(sum({y}) AS DOUBLE) * sum(1 - {y}), 0)")


def _ranked(source, score, keys=()):
    part = ", ".join(keys)
    over = f"PARTITION BY {part} " if keys else ""
    ties = f"PARTITION BY {', '.join([*keys, score])}"
    return f"""ranked AS (SELECT *, rank() OVER ({over}ORDER BY {score})
  + (count(*) OVER ({ties}) - 1) / 2.0 AS rk FROM {source})"""


def _gaps(source, score, keys=()):
    """Class distribution functions at every distinct score."""
    cols = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""gaps AS (
  SELECT {cols}s, CAST(sum(neg) OVER ({part} ORDER BY s) AS DOUBLE) / nullif(sum(neg) OVER ({part}), 0)
    - CAST(sum(pos) OVER ({part} ORDER BY s) AS DOUBLE) / nullif(sum(pos) OVER ({part}), 0) AS gap
  FROM (SELECT {cols}{score} AS s, sum(target) AS pos, sum(1 - target) AS neg FROM {source} GROUP BY {cols}{score}))"""


_THRESHOLD = """CASE WHEN max(gap) IS NULL THEN NULL WHEN max(gap) = 0 AND min(s) <> 0 THEN 0.0
  ELSE arg_min(s, (-gap, s)) END"""


def auc_all(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf), "proba", "target"), "auc")


def auc_tied(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf), "proba_tied", "target"), "auc")


def ks_all(spark, sf):
    return rounded(metrics.ks_two_sided(scored(spark, sf), "proba", "target"), "ks")


def ks_signed(spark, sf):
    """The good direction and, on the inverted score, the direction without any positive gap."""
    s = scored(spark, sf).withColumn("inverted", F.round(1 - F.col("proba"), 6))
    one = metrics.ks_signed(s, "proba", "target").withColumn("direction", F.lit("score"))
    two = metrics.ks_signed(s, "inverted", "target").withColumn("direction", F.lit("inverted"))
    return rounded(one.unionByName(two), "ks", "threshold")


def ks_by_month(spark, sf):
    return rounded(metrics.ks_over_time(scored(spark, sf), "data_ref1", "target", "proba"), "KS", "THRESHOLD")


def auc_by_month(spark, sf):
    return rounded(metrics.auc_over_time(scored(spark, sf), "data_ref1", "target", "proba"), "AUC")


def by_sample(spark, sf):
    return rounded(metrics.metrics_by_sample(scored(spark, sf, True), "sample", "target", "proba"), "auc", "ks")


def over_time(spark, sf):
    df = metrics.metrics_over_time(scored(spark, sf, True), "sample", "data_ref1", "target", "proba")
    return rounded(df, "KS", "THRESHOLD", "AUC")


def running_counts(spark, sf):
    return metrics.running_class_counts(scored(spark, sf), "proba", "target")


def brier(spark, sf):
    return rounded(metrics.brier_score(scored(spark, sf, True), "proba", "target", ["sample"]), "brier", digits=8)


def ratings(spark, sf):
    return rounded(reports.rating_table(scored(spark, sf), "proba", "target"), "bad_rate")


def ratings_tied(spark, sf):
    return rounded(reports.rating_table(scored(spark, sf), "proba_tied", "target", 20), "bad_rate")


def _rating_sql(score, q):
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return with_(SCORED, f"""pts AS (SELECT (1 - {score}) * 1000 AS s, target FROM scored),
edges AS (SELECT list_sort(list_distinct(quantile_cont(s, [{probs}]))) AS e FROM pts),
banded AS (SELECT target, len(list_filter(e[2:len(e) - 1], lambda v: v < s)) AS b FROM pts, edges)""") + f"""
SELECT 'R' || CAST(b + 1 AS VARCHAR) AS rating, {rs('avg(target)')} AS bad_rate, CAST(count(*) AS BIGINT) AS volume
FROM banded GROUP BY b"""


def ratings_by_sample(spark, sf):
    return rounded(reports.rating_tables(scored(spark, sf, True), ["sample"], "proba_tied", "target", 20), "bad_rate")


def _ratings_by_sample_sql(score, q):
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return with_(SAMPLED, f"""pts AS (SELECT sample, (1 - {score}) * 1000 AS s, target FROM sampled),
edges AS (SELECT sample, list_sort(list_distinct(quantile_cont(s, [{probs}]))) AS e FROM pts GROUP BY sample),
banded AS (SELECT pts.sample, target, len(list_filter(e[2:len(e) - 1], lambda v: v < s)) AS b FROM pts JOIN edges ON pts.sample = edges.sample)""") + f"""
SELECT sample, 'R' || CAST(b + 1 AS VARCHAR) AS rating, {rs('avg(target)')} AS bad_rate, CAST(count(*) AS BIGINT) AS volume
FROM banded GROUP BY sample, b"""


def summary_by_sample(spark, sf):
    points = scored(spark, sf, True).withColumn("score", reports.score_points("proba"))
    return rounded(reports.score_summaries(points, ["sample"], "score", "target"), *SUMMARY_FLOATS)


SUMMARY_FLOATS = ["mean", "std", "min", *[f"p{10 * i}" for i in range(1, 10)], "max"]


def summary(spark, sf):
    points = scored(spark, sf).withColumn("score", reports.score_points("proba"))
    return rounded(reports.score_summary(points, "score", "target"), *SUMMARY_FLOATS)


def histogram(spark, sf):
    points = scored(spark, sf).withColumn("score", F.round(reports.score_points("proba"), 3))
    return reports.score_histogram(points, "score", "target")


def cohorts(spark, sf):
    points = scored(spark, sf).withColumn("score", F.round(reports.score_points("proba"), 3))
    return rounded(reports.cohort_monitor(points, "data_ref1", "target", "score"), "auc", "ks")


def confusion(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf, True), "target", "pred", ["sample"])


def report(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf), "target", "pred"),
                   "precision", "recall", "f1_score", "support")


def volumes(spark, sf):
    one = reports.volumetry(load(spark, sf, "lineitem")).withColumn("step", F.lit("before"))
    two = reports.volumetry(load(spark, sf, "lineitem").where("l_quantity > 10").drop("l_tax", "l_discount"))
    return one.unionByName(two.withColumn("step", F.lit("after")))


IMPORTANCE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price", "line_gap"]


def _importance(spark, sf):
    auc = metrics.feature_auc(stored(feature_frame(spark, sf), *IMPORTANCE_FEATURES, "target"),
                              IMPORTANCE_FEATURES, "target")
    return auc.select("feature", F.round(F.col("auc") - 0.4, 6).alias("importance"))


IMPORTANCE_SQL = [FEATURES, auc_sql(IMPORTANCE_FEATURES),
                  "imp AS (SELECT feature, round(auc - 0.4, 6) AS importance FROM aucs)"]


def importance_share(spark, sf):
    return rounded(reports.normalised_importance(_importance(spark, sf), 80), "importance", digits=4)


def points(spark, sf):
    return scored(spark, sf).select(*ROW_KEY, r(reports.score_points("proba")).alias("score"))


def penalised(spark, sf):
    """The baseline formula on the AUC of the train and test samples."""
    rows = metrics.roc_auc(scored(spark, sf, True), "proba", "target", ["sample"])
    wide = rows.agg(F.max(F.when(F.col("sample") == "train", F.col("auc"))).alias("a"),
                    F.max(F.when(F.col("sample") == "test", F.col("auc"))).alias("b"))
    return wide.select(r(metrics.penalised_auc(F.col("a"), F.col("b"), 2.0)).alias("weight_2"),
                       r(metrics.penalised_auc(F.col("a"), F.col("b"), 5.0)).alias("weight_5"))


_REPORT_SQL = with_(SCORED, """c AS (SELECT CAST(count(*) FILTER (target = 0 AND pred = 0) AS DOUBLE) AS c00,
  count(*) FILTER (target = 0 AND pred = 1) AS c01, count(*) FILTER (target = 1 AND pred = 0) AS c10,
  count(*) FILTER (target = 1 AND pred = 1) AS c11 FROM scored),
m AS (SELECT *, c00 / (c00 + c10) AS p0, c00 / (c00 + c01) AS r0, CAST(c11 AS DOUBLE) / (c11 + c01) AS p1,
  CAST(c11 AS DOUBLE) / (c11 + c10) AS r1, c00 + c01 AS s0, c10 + c11 AS s1, c00 + c01 + c10 + c11 AS n,
  (c00 + c11) / (c00 + c01 + c10 + c11) AS acc FROM c),
f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM m),
rep AS (SELECT '0' AS label, p0 AS p, r0 AS r, f0 AS f, CAST(s0 AS DOUBLE) AS s FROM f
 UNION ALL SELECT '1', p1, r1, f1, s1 FROM f UNION ALL SELECT 'accuracy', acc, acc, acc, acc FROM f
 UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
 UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f)""") + f"""
SELECT label, {rs('p')} AS precision, {rs('r')} AS recall, {rs('f')} AS f1_score, {rs('s')} AS support FROM rep"""

_BY_SAMPLE = ["sample"]
_BY_BOTH = ["sample", "data_ref1"]

QUERIES = [
    Query("ag11_ks_two_sided", ks_all, with_(SCORED, _gaps("scored", "proba")) + f"SELECT {rs('max(abs(gap))')} AS ks FROM gaps"),
    Query("ag12_roc_auc", auc_all, with_(SCORED, _ranked("scored", "proba")) + f"SELECT {rs(_rank_auc())} AS auc FROM ranked"),
    Query("ag12_roc_auc_with_ties", auc_tied,
          with_(SCORED, _ranked("scored", "proba_tied")) + f"SELECT {rs(_rank_auc())} AS auc FROM ranked"),
    Query("ag13_ks_signed_threshold", ks_signed, with_(
        SCORED, "inv AS (SELECT round(1 - proba, 6) AS inverted, target FROM scored)", _gaps("scored", "proba"),
        _gaps("inv", "inverted").replace("gaps AS", "gaps2 AS")) + f"""
SELECT 'score' AS direction, {rs('max(gap)')} AS ks, {rs(_THRESHOLD)} AS threshold FROM gaps UNION ALL
SELECT 'inverted' AS direction, {rs('max(gap)')} AS ks, {rs(_THRESHOLD)} AS threshold FROM gaps2"""),
    Query("ag14_ks_over_time", ks_by_month, with_(SCORED, _gaps("scored", "proba", ["data_ref1"])) + f"""
SELECT data_ref1 AS "MONTH", {rs('max(gap)')} AS "KS", {rs(f'({_THRESHOLD}) * 1000')} AS "THRESHOLD" FROM gaps GROUP BY 1"""),
    Query("ag15_auc_over_time", auc_by_month, with_(SCORED, _ranked("scored", "proba", ["data_ref1"])) + f"""
SELECT data_ref1 AS "MONTH", {rs(_rank_auc())} AS "AUC" FROM ranked GROUP BY 1"""),
    Query("ag16_metrics_by_sample", by_sample, with_(
        SAMPLED, _ranked("sampled", "proba", _BY_SAMPLE), _gaps("sampled", "proba", _BY_SAMPLE)) + f"""
SELECT a.sample, auc, ks FROM (SELECT sample, {rs('100 * ' + _rank_auc())} AS auc FROM ranked GROUP BY 1) a
JOIN (SELECT sample, {rs('100 * max(abs(gap))')} AS ks FROM gaps GROUP BY 1) k ON a.sample = k.sample"""),
    Query("ag16_metrics_over_time", over_time, with_(
        SAMPLED, _ranked("sampled", "proba", _BY_BOTH), _gaps("sampled", "proba", _BY_BOTH)) + f"""
SELECT a.sample, a.data_ref1 AS "MONTH", "KS", "THRESHOLD", "AUC" FROM
 (SELECT sample, data_ref1, {rs(_rank_auc())} AS "AUC" FROM ranked GROUP BY 1, 2) a JOIN
 (SELECT sample, data_ref1, {rs('max(gap)')} AS "KS", {rs(f'({_THRESHOLD}) * 1000')} AS "THRESHOLD" FROM gaps GROUP BY 1, 2) k
 ON a.sample = k.sample AND a.data_ref1 = k.data_ref1"""),
    Query("w3_running_class_counts", running_counts, with_(SCORED) + """
SELECT proba AS score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
  CAST(sum(pos) OVER (ORDER BY proba) AS BIGINT) AS cum_pos, CAST(sum(neg) OVER (ORDER BY proba) AS BIGINT) AS cum_neg,
  CAST(sum(pos) OVER () AS BIGINT) AS tot_pos, CAST(sum(neg) OVER () AS BIGINT) AS tot_neg
FROM (SELECT proba, sum(target) AS pos, sum(1 - target) AS neg FROM scored GROUP BY proba)"""),
    Query("ag17_brier_score", brier, with_(SAMPLED) +
          f"SELECT sample, {rs('avg((proba - target) * (proba - target))', 8)} AS brier FROM sampled GROUP BY 1"),
    Query("ag18_rating_table", ratings, _rating_sql("proba", 10)),
    Query("ag18_rating_table_tied_edges", ratings_tied, _rating_sql("proba_tied", 20)),
    Query("ag19_score_summary", summary, with_(SCORED, "pts AS (SELECT (1 - proba) * 1000 AS s, target FROM scored)") + f"""
SELECT target AS class, CAST(count(*) AS BIGINT) AS count, {rs('avg(s)')} AS mean, {rs('stddev_samp(s)')} AS std,
  {rs('min(s)')} AS min, """ + ", ".join(f"{rs(f'quantile_cont(s, {i / 10})')} AS p{10 * i}" for i in range(1, 10)) +
          f", {rs('max(s)')} AS max FROM pts GROUP BY target"),
    Query("ag18_rating_tables_by_sample", ratings_by_sample, _ratings_by_sample_sql("proba_tied", 20)),
    Query("ag19_score_summary_by_sample", summary_by_sample, with_(SAMPLED, "pts AS (SELECT sample, (1 - proba) * 1000 AS s, target FROM sampled)") + f"""
SELECT sample, target AS class, CAST(count(*) AS BIGINT) AS count, {rs('avg(s)')} AS mean, {rs('stddev_samp(s)')} AS std,
  {rs('min(s)')} AS min, """ + ", ".join(f"{rs(f'quantile_cont(s, {i / 10})')} AS p{10 * i}" for i in range(1, 10)) +
          f", {rs('max(s)')} AS max FROM pts GROUP BY sample, target"),
    Query("ag19_score_histogram", histogram, with_(SCORED, "pts AS (SELECT round((1 - proba) * 1000, 3) AS s, target FROM scored)") + """
SELECT target AS class, CAST(least(floor(s / 100) + 1, 10) AS INTEGER) AS band, CAST(count(*) AS BIGINT) AS n
FROM pts GROUP BY 1, 2"""),
    Query("ag20_cohort_monitor", cohorts, with_(
        SCORED, "pts AS (SELECT *, round((1 - proba) * 1000, 3) AS s1 FROM scored)",
        _ranked("pts", "s1", ["data_ref1"]), _gaps("pts", "s1", ["data_ref1"])) + f"""
SELECT 'score' AS modelo, v.data_ref1, qtd, inad, auc, ks FROM
 (SELECT data_ref1, CAST(count(*) AS BIGINT) AS qtd, round(avg(target) * 100, 2) AS inad,
    {rs('100 - 100 * ' + _rank_auc())} AS auc FROM ranked GROUP BY 1) v JOIN
 (SELECT data_ref1, {rs('100 * max(abs(gap))')} AS ks FROM gaps GROUP BY 1) k ON v.data_ref1 = k.data_ref1"""),
    Query("ag21_confusion_matrix", confusion, with_(SAMPLED) +
          "SELECT sample, target AS actual, pred AS predicted, CAST(count(*) AS BIGINT) AS n FROM sampled GROUP BY 1, 2, 3"),
    Query("ag22_classification_report", report, _REPORT_SQL),
    Query("ag23_volumetry", volumes, """
SELECT CAST(count(*) AS BIGINT) AS n_rows, 11 AS n_columns, 'before' AS step FROM lineitem UNION ALL
SELECT CAST(count(*) AS BIGINT), 9, 'after' FROM lineitem WHERE l_quantity > 10"""),
    Query("ag25_normalised_importance", importance_share, with_(*IMPORTANCE_SQL) +
          f"SELECT feature, {rs('importance / sum(importance) OVER () * 100', 4)} AS importance FROM imp"),
    Query("tk3_top_features", lambda spark, sf: reports.top_features(_importance(spark, sf), 3),
          with_(*IMPORTANCE_SQL) + "SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 3"),
    Query("tk5_most_important", lambda spark, sf: reports.most_important(_importance(spark, sf)),
          with_(*IMPORTANCE_SQL) + "SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 1"),
    Query("ca4_score_points", points, with_(SCORED) +
          f"SELECT {', '.join(ROW_KEY)}, {rs('(1 - proba) * 1000')} AS score FROM scored"),
    Query("ml2_penalised_auc", penalised, with_(SAMPLED, _ranked("sampled", "proba", _BY_SAMPLE),
          f"a AS (SELECT sample, {_rank_auc()} AS auc FROM ranked GROUP BY 1)",
          "v AS (SELECT avg(auc) AS m, stddev_pop(auc) AS s FROM a WHERE sample IN ('train', 'test'))") +
          f"SELECT {rs('m - 2 * s')} AS weight_2, {rs('m - 5 * s')} AS weight_5 FROM v"),
]
