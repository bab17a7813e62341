"""Sampling, splitting, duplicates, ranks, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (BASE, Query, ROW_KEY, SAMPLED, SCORED, load, md5_32, orders_base, r, rounded, rs, scored, stored, with_)
from scorekit.operators import clean, reports, sample, train
from scorekit.operators.metrics import roc_auc

_ORDER_HASH = md5_32("'10'", "CAST(o_orderkey AS VARCHAR)")


def random_rank(spark, sf):
    base = orders_base(spark, sf).withColumn("stratum", clean.stratum_key("data_ref1", "target"))
    return sample.random_rank(base, ["stratum"], ["o_orderkey"], 10).select("o_orderkey", "stratum", "row_num")


def latest_per_id(spark, sf):
    df = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return clean.dedup_by_key(df, ["o_custkey"], ["o_orderdate"])


def by_month_and_target(spark, sf):
    return sample.sample_by_month_and_target(orders_base(spark, sf), "data_ref1", "target", ["o_orderkey"],
                                             0.4, 10)


def by_target(spark, sf):
    return sample.stratified_sample(scored(spark, sf).select(*ROW_KEY, "target", "proba"), "target", ROW_KEY,
                                    0.3, 10)


def row_fraction(spark, sf):
    return sample.sample_rows(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 0.1, 10,
                              ["o_orderkey"])


def split(spark, sf):
    return sample.assign_sample(orders_base(spark, sf), "id", "data_ref1") \
        .select("id", "o_orderkey", "data_ref1", "sample")


def split_views(spark, sf):
    parts = sample.split_samples(orders_base(spark, sf), "id", "data_ref1", n_recent=6)
    counted = [p.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))
               .withColumn("sample", F.lit(name)) for name, p in parts.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


def recency_split(spark, sf):
    older, recent = sample.split_by_recency(orders_base(spark, sf), "data_ref1", 12)
    marked = sample.label_and_union(older, recent)
    return marked.groupBy("target_drift", "data_ref1").agg(F.count("*").alias("n"))


def labelled_union(spark, sf):
    older, recent = sample.split_by_recency(orders_base(spark, sf), "data_ref1", 3)
    return sample.label_and_union(older, recent).select("o_orderkey", "target_drift")


def distinct_rows(spark, sf):
    return clean.distinct_rows(load(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


def key_dedup(spark, sf):
    """Order by price decides the survivor, so both engines keep the same row."""
    return clean.dedup_by_key(orders_base(spark, sf), ["id", "o_orderdate"], ["o_totalprice"])


def key_dedup_any(spark, sf):
    kept = clean.dedup_by_key(orders_base(spark, sf), ["id", "data_ref1"])
    return kept.select("id", "data_ref1")


_COPIES = ["l_suppkey", "l_linenumber", "l_returnflag"]


def duplicate_rows(spark, sf):
    _, members = clean.split_duplicates(load(spark, sf, "lineitem").select(*_COPIES, "l_quantity"))
    return members


def without_duplicates(spark, sf):
    kept, _ = clean.split_duplicates(load(spark, sf, "lineitem").select(*_COPIES, "l_quantity"))
    return kept


def recent_cutoff(spark, sf):
    return sample.recent_months(orders_base(spark, sf), "data_ref1", 3).agg(F.min("data_ref1").alias("cutoff"))


def _supplier_board(spark, sf):
    """One leaderboard row per supplier: its line items judged by the score. Every fifth is a baseline."""
    auc = roc_auc(scored(spark, sf), "proba", "target", ["l_suppkey"])
    return auc.select(
        F.concat(F.lit("m"), F.col("l_suppkey") % 3).alias("MODEL_NAME"),
        F.when(F.col("l_suppkey") % 5 == 0, "baseline").otherwise(F.col("l_suppkey").cast("string"))
        .alias("TRIAL_NUMBER"),
        F.col("l_suppkey").alias("supplier"), r("auc").alias("AUC_PENALIZED"))


def best_model(spark, sf):
    return reports.best_model(_supplier_board(spark, sf))


BOARD_SCORES = ["proba", "proba_tied", "l_quantity", "l_tax"]


def leaderboard(spark, sf):
    """Trials whose scores are columns, judged per sample and put on one board."""
    df = stored(scored(spark, sf, True), "sample", "target", *BOARD_SCORES)
    trials = []
    for name in BOARD_SCORES:
        judged = train.sample_metrics(df.withColumn("PROBA", F.col(name)), "target")
        score = train.penalise(judged["train"][0], judged["test"][0], 2.0)
        trials.append(train.Trial(name, "baseline", judged, score, {}, [name]))
    auc = [c for c in train.leaderboard(spark, trials).columns if c.startswith("AUC")]
    return rounded(train.leaderboard(spark, trials).select("MODEL_NAME", "TRIAL_NUMBER", *auc), *auc)


LEADERBOARD_SQL = with_(SAMPLED, "scores AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS model, sample, target, CAST({c} AS DOUBLE) AS s FROM sampled" for c in BOARD_SCORES) + ")",
    """ranked AS (SELECT *, rank() OVER (PARTITION BY model, sample ORDER BY s)
  + (count(*) OVER (PARTITION BY model, sample, s) - 1) / 2.0 AS rk FROM scores)""",
    """aucs AS (SELECT model, sample, (sum(CASE WHEN target = 1 THEN rk END) - sum(target) * (sum(target) + 1) / 2.0)
  / (CAST(sum(target) AS DOUBLE) * sum(1 - target)) AS auc FROM ranked GROUP BY ALL)""",
    """wide AS (SELECT model, max(auc) FILTER (sample = 'train') AS a, max(auc) FILTER (sample = 'test') AS b,
  max(auc) FILTER (sample = 'val') AS c, max(auc) FILTER (sample = 'oot') AS d FROM aucs GROUP BY model)""") + f"""
SELECT model AS "MODEL_NAME", 'baseline' AS "TRIAL_NUMBER", {rs('a')} AS "AUC_TRAINING", {rs('b')} AS "AUC_TEST",
  {rs('(a + b) / 2 - 2.0 * abs(a - b) / 2')} AS "AUC_PENALIZED", {rs('c')} AS "AUC_VAL", {rs('d')} AS "AUC_OOT" FROM wide"""


BOARD = f"""ranked AS (
  SELECT l_suppkey, target, rank() OVER (PARTITION BY l_suppkey ORDER BY proba)
         + (count(*) OVER (PARTITION BY l_suppkey, proba) - 1) / 2.0 AS rk FROM scored),
board AS (
  SELECT 'm' || (l_suppkey % 3) AS "MODEL_NAME",
         CASE WHEN l_suppkey % 5 = 0 THEN 'baseline' ELSE CAST(l_suppkey AS VARCHAR) END AS "TRIAL_NUMBER",
         l_suppkey AS supplier,
         {rs("(sum(CASE WHEN target = 1 THEN rk END) - sum(target) * (sum(target) + 1) / 2.0) / (CAST(sum(target) AS DOUBLE) * sum(1 - target))")} AS "AUC_PENALIZED"
  FROM ranked GROUP BY l_suppkey)"""

_ROWHASH = md5_32("'10'", *[f"CAST({c} AS VARCHAR)" for c in ROW_KEY])
_SPLIT = f"""cutoff AS (SELECT min(m) AS m FROM (SELECT DISTINCT data_ref1 AS m FROM base ORDER BY m DESC LIMIT %d)),
split AS (SELECT *, CASE WHEN data_ref1 >= (SELECT m FROM cutoff) THEN 'oot'
  WHEN {md5_32("'42'", 'id')} %% 100 < 70 THEN 'train'
  WHEN {md5_32("'42'", 'id')} %% 100 < 85 THEN 'test' ELSE 'val' END AS sample FROM base)"""
_RECENT = "recent AS (SELECT DISTINCT data_ref1 AS m FROM base ORDER BY m DESC LIMIT {n})"

QUERIES = [
    Query("w1_random_rank_in_stratum", random_rank, with_(BASE) + f"""
SELECT o_orderkey, data_ref1 || '_' || target AS stratum, CAST(row_number() OVER (
  PARTITION BY data_ref1, target ORDER BY {_ORDER_HASH}, o_orderkey) AS BIGINT) AS row_num FROM base"""),
    Query("w2_latest_per_id", latest_per_id, """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1"""),
    Query("sm1_row_fraction", row_fraction,
          f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_ORDER_HASH} < {int(0.1 * 2 ** 32)}"),
    Query("sm2_sample_by_month_and_target", by_month_and_target, with_(BASE) + f"""
SELECT * EXCLUDE (rn, n) FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY data_ref1, target) AS n
  FROM base WINDOW w AS (PARTITION BY data_ref1, target ORDER BY {_ORDER_HASH}, o_orderkey))
WHERE rn <= floor(n * 0.4::DOUBLE)"""),
    Query("sm3_stratified_sample", by_target, with_(SCORED) + f"""
SELECT {', '.join(ROW_KEY)}, target, proba FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY {_ROWHASH}, {', '.join(ROW_KEY)}) AS rn,
         count(*) OVER (PARTITION BY target) AS n FROM scored) WHERE rn <= floor(n * 0.3::DOUBLE)"""),
    Query("sp1_entity_time_split", split, with_(BASE, _SPLIT % 3) +
          "SELECT id, o_orderkey, data_ref1, sample FROM split"),
    Query("sp1_split_views", split_views, with_(BASE, _SPLIT % 6) + """
SELECT sample, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS n_ids FROM split GROUP BY sample"""),
    Query("st1_recency_complement", recency_split, with_(BASE, _RECENT.format(n=12)) + """
SELECT CASE WHEN data_ref1 IN (SELECT m FROM recent) THEN 1 ELSE 0 END AS target_drift, data_ref1,
  CAST(count(*) AS BIGINT) AS n FROM base GROUP BY 1, 2"""),
    Query("st2_labelled_union", labelled_union, with_(BASE, _RECENT.format(n=3)) + """
SELECT o_orderkey, CASE WHEN data_ref1 IN (SELECT m FROM recent) THEN 1 ELSE 0 END AS target_drift FROM base"""),
    Query("st3_distinct_rows", distinct_rows, "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem"),
    Query("st4_key_dedup_latest", key_dedup, with_(BASE) + """
SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY id, o_orderdate
  ORDER BY o_totalprice DESC, o_orderkey DESC, data_ref1 DESC, target DESC) = 1"""),
    Query("st4_key_dedup_any", key_dedup_any, with_(BASE) + "SELECT DISTINCT id, data_ref1 FROM base"),
    Query("st5_duplicate_rows", duplicate_rows, """
SELECT l_suppkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag, l_quantity) > 1"""),
    Query("st5_without_duplicates", without_duplicates,
          "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_quantity FROM lineitem"),
    Query("tk1_best_model", best_model, with_(SCORED, BOARD) + """
SELECT * FROM board WHERE "TRIAL_NUMBER" <> 'baseline'
ORDER BY "AUC_PENALIZED" DESC, "MODEL_NAME", "TRIAL_NUMBER" LIMIT 1"""),
    Query("tk2_recent_cutoff", recent_cutoff, with_(BASE, _RECENT.format(n=3)) + "SELECT min(m) AS cutoff FROM recent"),
    Query("tk4_first_columns", lambda spark, sf: reports.first_columns(load(spark, sf, "orders"), 4),
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"),
    Query("ml4_leaderboard", leaderboard, LEADERBOARD_SQL),
]
