"""Feature profiling, encoders, scalers, calibration, selection and models."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.inputs import auc_sql
from catalog.tables import (FEATURES, NUMERIC_FEATURES, ROW_KEY, SAMPLED, SCORED, Query, feature_frame,
                            load, r, rounded, rs, scored, stored, with_)
from scorekit.operators import calibrate, encode, profile, reports, select, train
from scorekit.operators.metrics import auc_and_ks, feature_auc
from scorekit.operators.sample import split_by_recency
from scorekit.plans import select_features as filters
from scorekit.plans import train_and_report as reporting
from scorekit.session import stage

# profiling ---------------------------------------------------------------------------------------


def null_ratio(spark, sf):
    df = feature_frame(spark, sf).select(*NUMERIC_FEATURES, "mostly_null", "l_returnflag", "target")
    return rounded(profile.null_ratio(df, ["target"]), "null_ratio")


IV_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "line_gap", "mostly_null"]
IV_TEXT = ["l_returnflag", "l_linestatus"]


def woe_table(spark, sf):
    bins = profile.woe_bins(stored(feature_frame(spark, sf), *IV_NUMERIC, *IV_TEXT, "target"), "target",
                            IV_NUMERIC, IV_TEXT)
    return bins.select("variable", "n", "events", r("woe").alias("woe"), r("iv").alias("iv"))


def information_value(spark, sf):
    df = stored(feature_frame(spark, sf), *IV_NUMERIC, *IV_TEXT, "target")
    return rounded(profile.information_value(df, "target", IV_NUMERIC, IV_TEXT), "iv")


def _woe_sql():
    probs = ", ".join(repr(i / 10) for i in range(11))
    parts = []
    for c in IV_NUMERIC:
        parts.append(f"""SELECT '{c}' AS variable, CAST(len(list_filter(e[2:len(e) - 1], lambda q: q < x)) AS VARCHAR) AS bin, target FROM
  (SELECT coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM feats)) AS x, target FROM feats),
  (SELECT list_sort(list_distinct(quantile_cont(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM feats)), [{probs}]))) AS e FROM feats)""")
    parts += [f"SELECT '{c}' AS variable, {c} AS bin, target FROM feats" for c in IV_TEXT]
    return with_(FEATURES, "long AS (\n" + "\nUNION ALL ".join(parts) + ")", """
cells AS (SELECT variable, bin, count(*) AS n, sum(target) AS events FROM long GROUP BY 1, 2),
shares AS (SELECT *, greatest(events, 0.5::DOUBLE) / sum(events) OVER (PARTITION BY variable) AS s1,
  greatest(n - events, 0.5::DOUBLE) / sum(n - events) OVER (PARTITION BY variable) AS s0 FROM cells),
woes AS (SELECT *, ln(s0 / s1) AS woe, ln(s0 / s1) * (s0 - s1) AS iv FROM shares)""")


TWO_FEATURES = ["l_quantity", "line_gap"]  # one pair, one side with missing values
CORR_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price", "line_gap"]


def _corr_sql(features=CORR_FEATURES, source="feats"):
    rows = [f"SELECT '{b}' AS feature_1, '{a}' AS feature_2, corr({b}, {a}) AS r FROM {source}"
            for a, b in combinations(features, 2)]
    return "pairs AS (" + "\nUNION ALL ".join(rows) + ")"


def pearson(spark, sf):
    return rounded(profile.pearson_pairs(feature_frame(spark, sf), CORR_FEATURES), "r")


def pearson_blocks(spark, sf):
    return rounded(profile.pearson_pairs(feature_frame(spark, sf), TWO_FEATURES), "r")


def correlated(spark, sf):
    return rounded(profile.correlated_pairs(feature_frame(spark, sf), 0.8, CORR_FEATURES), "r")


def matrix(spark, sf):
    return rounded(profile.correlation_matrix(feature_frame(spark, sf), CORR_FEATURES), "r")


def keep_by_variance(spark, sf):
    df = stored(feature_frame(spark, sf), *CORR_FEATURES)
    out = profile.drop_by_variance(df, profile.correlated_pairs(df, 0.8, CORR_FEATURES), CORR_FEATURES)
    return out.select("feature_1", "feature_2", "drop_feature")


def keep_by_auc(spark, sf):
    df = stored(feature_frame(spark, sf), *CORR_FEATURES, "target")
    out = profile.drop_by_auc(df, profile.correlated_pairs(df, 0.8, CORR_FEATURES), CORR_FEATURES, "target")
    return rounded(out, "value_1", "value_2")


def univariate_auc(spark, sf):
    df = stored(feature_frame(spark, sf), *CORR_FEATURES, "target")
    return rounded(feature_auc(df, CORR_FEATURES, "target"), "auc")


def value_ranks(spark, sf):
    return profile.average_ranks(scored(spark, sf), ["l_extendedprice", "l_quantity"])


SPEARMAN_FEATURES = ["l_quantity", "l_extendedprice", "net_price", "l_discount"]
_SPEARMAN_RANKS = "rk AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
    for c in SPEARMAN_FEATURES) + " FROM feats)"


def spearman(spark, sf):
    return rounded(profile.spearman_pairs(stored(feature_frame(spark, sf), *SPEARMAN_FEATURES), SPEARMAN_FEATURES), "r")


def smart_correlated(spark, sf):
    df = stored(feature_frame(spark, sf), *SPEARMAN_FEATURES, "target")
    return rounded(profile.smart_correlated_drops(df, SPEARMAN_FEATURES, "target", 0.8), "auc")


def f_statistic(spark, sf):
    return rounded(profile.f_statistic(feature_frame(spark, sf), NUMERIC_FEATURES, "target"), "f", digits=4)


def _f_sql():
    parts = []
    for c in NUMERIC_FEATURES:
        parts.append(f"""SELECT '{c}' AS feature, sum(n * (m - g) * (m - g)) / (sum(n * v) / (sum(n) - 2)) AS f FROM
  (SELECT target, count(*) AS n, avg(x) AS m, var_pop(x) AS v, (SELECT avg(coalesce({c}, -99999)) FROM feats) AS g
   FROM (SELECT target, coalesce({c}, -99999) AS x FROM feats) GROUP BY target)""")
    return with_(FEATURES) + f"SELECT feature, {rs('f', 4)} AS f FROM (" + "\nUNION ALL ".join(parts) + ")"


def mrmr(spark, sf):
    df = stored(feature_frame(spark, sf), *NUMERIC_FEATURES, "target")
    names = profile.mrmr_ranking(df, NUMERIC_FEATURES, "target", 4)
    return spark.createDataFrame([(i, n) for i, n in enumerate(names, 1)], "rank int, feature string")


def _mrmr_sql(k=4):
    """The greedy order, one pick per table expression."""
    rel = "\nUNION ALL ".join(f"""SELECT '{c}' AS feature, {i} AS place, sum(n * (m - g) * (m - g)) / (sum(n * v) / (sum(n) - 2)) AS f FROM
  (SELECT target, count(*) AS n, avg(x) AS m, var_pop(x) AS v, (SELECT avg(coalesce({c}, -99999)) FROM feats) AS g
   FROM (SELECT target, coalesce({c}, -99999) AS x FROM feats) GROUP BY target)""" for i, c in enumerate(NUMERIC_FEATURES))
    red = "\nUNION ALL ".join(f"SELECT '{a}' AS feature, '{b}' AS other, abs(corr(coalesce({a}, -99999), coalesce({b}, -99999))) AS r FROM feats"
                              for a in NUMERIC_FEATURES for b in NUMERIC_FEATURES if a != b)
    parts = [FEATURES, f"rel AS ({rel})", f"red AS ({red})", "pick1 AS (SELECT 1 AS rank, feature FROM rel ORDER BY f DESC, place LIMIT 1)"]
    for i in range(2, k + 1):
        done = " UNION ALL ".join(f"SELECT feature FROM pick{j}" for j in range(1, i))
        parts.append(f"""pick{i} AS (SELECT {i} AS rank, rel.feature FROM rel JOIN red ON red.feature = rel.feature
  WHERE rel.feature NOT IN ({done}) AND other IN ({done})
  GROUP BY rel.feature, f, place ORDER BY f / greatest(avg(r), 0.001) DESC, place LIMIT 1)""")
    return with_(*parts) + " UNION ALL ".join(f"SELECT rank, feature FROM pick{i}" for i in range(1, k + 1))


def frequencies(spark, sf):
    return profile.frequency_table(load(spark, sf, "part"), "p_brand", 40)


# encoders and scalers ----------------------------------------------------------------------------

ENCODED = ["c_mktsegment", "c_nationkey"]


def _customers(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"))


def frequency_ranks(spark, sf):
    return encode.frequency_ranks(_customers(spark, sf), ENCODED, 40)


def rank_count(spark, sf):
    customers = _customers(spark, sf)
    fitted = encode.RankCountEncoder(ENCODED, min_count=40).fit(customers.where("c_custkey % 2 = 0"))
    return fitted.transform(customers)


_CUSTOMERS = """cust AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS c_mktsegment,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer)"""


def _codes(name, column, where=""):
    return f"""{name} AS (SELECT v, n, row_number() OVER (ORDER BY n, md5(v)) AS code FROM
  (SELECT {column} AS v, count(*) AS n FROM cust WHERE {column} IS NOT NULL {where} GROUP BY 1) WHERE n > 40)"""


SCALED = ["l_quantity", "l_extendedprice", "line_gap"]


def standard_scaled(spark, sf):
    df = stored(feature_frame(spark, sf, True), *ROW_KEY, "sample", *SCALED)
    fitted = encode.fit_standard(df.where("sample = 'train'"), SCALED)
    return rounded(fitted.transform(df), *SCALED)


def max_abs_scaled(spark, sf):
    df = stored(feature_frame(spark, sf, True), *ROW_KEY, "sample", *SCALED)
    filled = df.select(*ROW_KEY, "sample", *[F.coalesce(F.col(c), F.lit(-99999.0)).alias(c) for c in SCALED])
    fitted = encode.fit_max_abs(filled.where("sample = 'train'"), SCALED)
    return rounded(fitted.transform(filled), *SCALED)


_SAMPLED_FEATURES = SAMPLED + """,
sfeats AS (SELECT *, CASE WHEN l_linenumber > 1 THEN l_linenumber * l_quantity END AS line_gap FROM sampled)"""


def _recipe(kind):
    def run(spark, sf):
        df = stored(feature_frame(spark, sf, True).withColumn(
            "l_returnflag", F.when(F.col("l_linenumber") > 2, F.col("l_returnflag"))),
            *ROW_KEY, "sample", "data_ref1", "line_gap", "l_quantity", "l_returnflag")
        fitted = encode.fit_preprocessor(kind, df.where("sample = 'train'"), ["line_gap", "l_quantity"],
                                         ["l_returnflag"])
        out = fitted.transform(df)
        numeric = ["line_gap", "l_quantity"] + ([] if kind == "catboost" else ["l_returnflag"])
        return out.select([r(F.col(c).cast("double")).alias(c) if c in numeric else F.col(c) for c in out.columns])
    return run


def _recipe_sql(kind):
    base = with_(SAMPLED, """
src AS (SELECT *, CASE WHEN l_linenumber > 1 THEN l_linenumber * l_quantity END AS line_gap,
  CASE WHEN l_linenumber > 2 THEN l_returnflag END AS flag FROM sampled),
codes AS (SELECT v, row_number() OVER (ORDER BY n, md5(v)) AS code FROM (SELECT flag AS v, count(*) AS n FROM src
  WHERE sample = 'train' AND flag IS NOT NULL GROUP BY 1) WHERE n > 40),
enc AS (SELECT src.*, CAST(CASE WHEN flag IS NULL THEN -999 ELSE coalesce(code, 1) END AS DOUBLE) AS coded
  FROM src LEFT JOIN codes ON flag = v)""")
    keep = ", ".join([*ROW_KEY, "sample", "data_ref1"])
    columns = {"line_gap": "line_gap", "l_quantity": "l_quantity", "l_returnflag": "coded"}
    if kind == "lgbm":
        made = {c: e for c, e in columns.items()}
    elif kind == "xgboost":
        made = {c: f"({e} - (SELECT avg({e}) FROM enc WHERE sample = 'train')) / (SELECT stddev_pop({e}) FROM enc WHERE sample = 'train')"
                for c, e in columns.items()}
    elif kind == "logit":
        made = {c: f"coalesce({e}, -99999) / (SELECT max(abs(coalesce({e}, -99999))) FROM enc WHERE sample = 'train')"
                for c, e in columns.items()}
    else:
        return base + (f"SELECT {keep}, {rs('line_gap')} AS line_gap, {rs('l_quantity')} AS l_quantity, "
                       "coalesce(flag, 'NA') AS l_returnflag FROM enc")
    return base + f"SELECT {keep}, " + ", ".join(f"{rs(e)} AS {c}" for c, e in made.items()) + " FROM enc"


# calibration -------------------------------------------------------------------------------------

def _train_rest(spark, sf):
    df = stored(scored(spark, sf, True), *ROW_KEY, "sample", "proba", "proba_tied", "target")
    return df.where("sample = 'train'"), df


def isotonic(spark, sf):
    fit_on, df = _train_rest(spark, sf)
    curve = calibrate.fit_isotonic(fit_on, "proba", "target")
    return curve.transform(df, "proba").select(*ROW_KEY, r("calibrated_prob", 5).alias("calibrated_prob"))


def isotonic_tied(spark, sf):
    fit_on, df = _train_rest(spark, sf)
    curve = calibrate.fit_isotonic(fit_on, "proba_tied", "target")
    return curve.transform(df, "proba_tied").select(*ROW_KEY, r("calibrated_prob").alias("calibrated_prob"))


# the max-min characterisation of the isotonic fit over the distinct scores
ISOTONIC_SQL = with_(SAMPLED, """
pts AS (SELECT proba_tied AS p, sum(target) AS s, count(*) AS n FROM sampled WHERE sample = 'train' GROUP BY 1),
idx AS (SELECT *, row_number() OVER (ORDER BY p) AS i, sum(s) OVER (ORDER BY p) AS cs, sum(n) OVER (ORDER BY p) AS cn FROM pts),
seg AS (SELECT a.i AS lo, b.i AS hi, CAST(b.cs - a.cs + a.s AS DOUBLE) / (b.cn - a.cn + a.n) AS m
        FROM idx a JOIN idx b ON a.i <= b.i),
low AS (SELECT lo, x.i AS pos, min(m) AS m FROM seg JOIN idx x ON lo <= x.i AND hi >= x.i GROUP BY 1, 2),
iso AS (SELECT p, max(m) AS v FROM idx JOIN low ON pos = i GROUP BY p),
span AS (SELECT min(p) AS p_low, max(p) AS p_high FROM iso)""") + f"""
SELECT {', '.join(ROW_KEY)}, {rs('greatest(p_low, least(p_high, v))')} AS calibrated_prob
FROM sampled JOIN iso ON p = proba_tied, span"""


# the vertices of the greatest convex minorant of the cumulative sums: each next one is where the mean from here
# is least, the last of them on ties
ISOTONIC_HULL_SQL = with_(SAMPLED, """
pts AS (SELECT proba AS p, CAST(sum(target) AS BIGINT) AS s, count(*) AS n FROM sampled WHERE sample = 'train' GROUP BY 1),
idx AS (SELECT p, row_number() OVER (ORDER BY p) AS i, sum(s) OVER (ORDER BY p) AS cs, sum(n) OVER (ORDER BY p) AS cn FROM pts),
hull AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS HUGEINT) AS cs, CAST(0 AS HUGEINT) AS cn, CAST(NULL AS DOUBLE) AS v
  UNION ALL
  SELECT nxt.i, nxt.cs, nxt.cn, nxt.v FROM (
    SELECT arg_min({i: x.i, cs: x.cs, cn: x.cn, v: CAST(x.cs - h.cs AS DOUBLE) / CAST(x.cn - h.cn AS DOUBLE)},
                   {v: CAST(x.cs - h.cs AS DOUBLE) / CAST(x.cn - h.cn AS DOUBLE), i: -x.i}) AS nxt
    FROM hull h JOIN idx x ON x.i > h.i GROUP BY h.i) step),
iso AS (SELECT idx.p, hull.v FROM idx ASOF JOIN hull ON idx.i <= hull.i),
probes AS (SELECT DISTINCT proba AS p FROM sampled),
below AS (SELECT q.p, iso.p AS p0, iso.v AS v0 FROM probes q ASOF LEFT JOIN iso ON q.p >= iso.p),
around AS (SELECT b.p, p0, v0, iso.p AS p1, iso.v AS v1 FROM below b ASOF LEFT JOIN iso ON b.p <= iso.p),
span AS (SELECT min(p) AS p_low, max(p) AS p_high FROM pts),
calibrated AS (SELECT p, greatest(p_low, least(p_high, CASE WHEN p0 IS NULL THEN v1 WHEN p1 IS NULL OR p0 = p1 THEN v0
  ELSE v0 + (v1 - v0) * (p - p0) / (p1 - p0) END)) AS c FROM around, span)""") + f"""
SELECT {', '.join(ROW_KEY)}, {rs('c', 5)} AS calibrated_prob FROM sampled JOIN calibrated ON p = proba"""
ISOTONIC_HULL_SQL = ISOTONIC_HULL_SQL.replace("WITH ", "WITH RECURSIVE ", 1)


def sigmoid(spark, sf):
    fit_on, df = _train_rest(spark, sf)
    curve = calibrate.fit_sigmoid(fit_on, "proba", "target")
    return curve.transform(df, "proba").select(*ROW_KEY, r("calibrated_prob", 4).alias("calibrated_prob"))


def sigmoid_coefficients(spark, sf):
    fit_on, _ = _train_rest(spark, sf)
    curve = calibrate.fit_sigmoid(fit_on, "proba", "target")
    return rounded(spark.createDataFrame([(curve.slope, curve.intercept)], "slope double, intercept double"),
                   "slope", "intercept", digits=3)


def _newton_sql(steps=15):
    """Newton steps of the logistic fit on soft targets, one table expression each."""
    parts = [SAMPLED, """counted AS (SELECT proba AS f, target AS y, CAST(count(*) AS DOUBLE) AS n FROM sampled
  WHERE sample = 'train' GROUP BY 1, 2)""", """sizes AS (SELECT sum(n) FILTER (y = 1) AS n1, sum(n) FILTER (y = 0) AS n0 FROM counted)""",
             "soft AS (SELECT f, n, CASE WHEN y = 1 THEN (n1 + 1) / (n1 + 2) ELSE 1 / (n0 + 2) END AS t FROM counted, sizes)",
             "step0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(steps):
        parts.append(f"""sums{i} AS (SELECT any_value(a) AS a, any_value(b) AS b, sum(n * (t - p) * f) AS ga, sum(n * (t - p)) AS gb,
  sum(n * p * (1 - p) * f * f) AS haa, sum(n * p * (1 - p) * f) AS hab, sum(n * p * (1 - p)) AS hbb
  FROM (SELECT *, 1 / (1 + exp(-(a * f + b))) AS p FROM soft, step{i}))""")
        parts.append(f"""step{i + 1} AS (SELECT a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
  b + (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM sums{i})""")
    return with_(*parts) + f"SELECT {rs('a', 3)} AS slope, {rs('b', 3)} AS intercept FROM step{steps}"


def quantile_transform(spark, sf):
    fit_on, df = _train_rest(spark, sf)
    curve = calibrate.fit_quantile_transform(fit_on, "proba", 200)
    return curve.transform(df, "proba").select(*ROW_KEY, r("calibrated_prob").alias("calibrated_prob"))


def quantile_transform_tied(spark, sf):
    fit_on, df = _train_rest(spark, sf)
    curve = calibrate.fit_quantile_transform(fit_on, "proba_tied", 100)
    return curve.transform(df, "proba_tied").select(*ROW_KEY, r("calibrated_prob").alias("calibrated_prob"))


def _quantile_sql(score, landmarks):
    probs = ", ".join(repr(i / (landmarks - 1)) for i in range(landmarks))
    return with_(SAMPLED, f"""
q AS (SELECT quantile_cont({score}, [{probs}]) AS v, [{probs}] AS p FROM sampled WHERE sample = 'train'),
marks AS (SELECT v, min(p) AS lo, max(p) AS hi FROM (SELECT unnest(v) AS v, unnest(p) AS p FROM q) GROUP BY v),
steps AS (SELECT v, lo, hi, lead(v) OVER (ORDER BY v) AS v1, lead(lo) OVER (ORDER BY v) AS lo1 FROM marks),
ends AS (SELECT min(v) AS lowest, max(v) AS highest FROM marks),
placed AS (SELECT s.*, steps.*, ends.* FROM sampled s ASOF LEFT JOIN steps ON s.{score} >= steps.v, ends)""") + f"""
SELECT {', '.join(ROW_KEY)}, {rs(f'''CASE WHEN {score} <= lowest THEN 0 WHEN {score} >= highest THEN 1 WHEN {score} = v THEN (lo + hi) / 2
  ELSE hi + (lo1 - hi) * ({score} - v) / (v1 - v) END''')} AS calibrated_prob FROM placed"""


# models ------------------------------------------------------------------------------------------

MODEL_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "line_gap"]
FAST_TREES = {"maxIter": 5, "maxDepth": 3}


def _model_frame(spark, sf):
    return feature_frame(spark, sf, True).select(*ROW_KEY, "data_ref1", "sample", "target", *MODEL_FEATURES)


def _fit(kind, params):
    def run(spark, sf):
        df = stage(_model_frame(spark, sf), "model-frame", even=True)
        fitted = train.fit_classifier(df.where("sample = 'train'"), MODEL_FEATURES, "target", kind, params)
        return fitted.score(df).select(*ROW_KEY, "sample", "target", r("PROBA").alias("PROBA"), "PRED")
    return run


def baseline(spark, sf):
    trials = []
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    for kind, params in (("lgbm", FAST_TREES), ("logit", {"maxIter": 50})):
        trials.append(train.baseline(df, MODEL_FEATURES, "target", kind, params)[0])
    return train.leaderboard(spark, trials).drop("PARAMS", "FEATURES")


def _small_trees(rng):
    return {"stepSize": rng.uniform(0.05, 0.2), "maxIter": rng.randint(2, 5), "maxDepth": rng.randint(2, 4)}


def search(spark, sf):
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    trials = train.random_search(df, MODEL_FEATURES, "target", "lgbm", 3, space=_small_trees)
    return train.leaderboard(spark, trials).drop("PARAMS", "FEATURES")


def full_report(spark, sf):
    """Leaderboard, refit of the winner and all of its tables, each row as one JSON text."""
    df = _model_frame(spark, sf)
    board, tables = reporting.train_and_report(
        df, MODEL_FEATURES, "target", "data_ref1", kinds=("lgbm", "logit"), n_trials=1,
        spaces={"lgbm": _small_trees}, baseline_params={"lgbm": FAST_TREES})
    rows = [t.select(F.lit(name).alias("table"), F.to_json(F.struct("*")).alias("row"))
            for name, t in sorted({**tables, "leaderboard": board}.items())]
    return reduce(DataFrame.unionAll, rows)


COEFFICIENTS = {"l_quantity": 0.08, "l_extendedprice": 0.00002, "l_discount": -3.0, "l_tax": 1.5}


def linear_importance(spark, sf):
    return rounded(train.linear_importance(scored(spark, sf), COEFFICIENTS), "importance")


def tree_importance(spark, sf):
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    fitted = train.fit_classifier(df.where("sample = 'train'"), MODEL_FEATURES, "target", "lgbm", FAST_TREES)
    return train.importance_table(spark, fitted)


def exchange_importance(spark, sf):
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    fitted = train.fit_classifier(df.where("sample = 'train'"), MODEL_FEATURES, "target", "logit")
    return train.permutation_importance(df.where("sample = 'test'"), fitted, ROW_KEY)


def drift(spark, sf):
    df = stage(_model_frame(spark, sf).withColumn(
        "drifting", F.month("data_ref1") + F.year("data_ref1") * 12 + F.col("l_linenumber")), "model-frame", even=True)
    older, recent = split_by_recency(df.where("sample <> 'test'"), "data_ref1", 6)
    return select.drift_elimination(older, recent, df.where("sample = 'test'"), [*MODEL_FEATURES, "drifting"],
                                    "target", params=FAST_TREES)


def curve(spark, sf):
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    return select.progressive_curve(df, MODEL_FEATURES, "target", params=FAST_TREES)


def forward(spark, sf):
    df = stage(_model_frame(spark, sf), "model-frame", even=True)
    return select.forward_selection(df, MODEL_FEATURES, "target", params=FAST_TREES)


def recursive(spark, sf):
    df = stage(_model_frame(spark, sf).where("sample = 'train'"), "model-frame", even=True)
    found = select.recursive_elimination(df, MODEL_FEATURES, "target", [2, 4], params=FAST_TREES)
    return spark.createDataFrame([(m, i, f) for m, fs in found.items() for i, f in enumerate(fs, 1)],
                                 "method string, rank int, feature string")


def boruta(spark, sf):
    df = stage(_model_frame(spark, sf).where("sample = 'train'"), "model-frame", even=True)
    return select.all_relevant(df, MODEL_FEATURES, "target", ROW_KEY, (100, 80),
                               params={"numTrees": 8, "maxDepth": 4})


def coordinator(spark, sf):
    from scorekit.sources.writers import feature_list
    df = stage(_model_frame(spark, sf).where("sample = 'train'"), "model-frame", even=True)
    found = select.select_features(df, MODEL_FEATURES, "target", ROW_KEY, ("catboost", "boruta", "mrmr"), (3,), (100,), (3,),
                                   model_params=FAST_TREES)
    return feature_list(spark, select.prune_correlated(df, found, "target", 0.8))


STATIC_COLUMNS = [*NUMERIC_FEATURES, "mostly_null", "l_returnflag", "l_linestatus", "target"]


def static_filters(spark, sf):
    df = stored(feature_frame(spark, sf), *STATIC_COLUMNS)
    return filters.filter_static(df, "target", limits=filters.FilterLimits(correlation=0.8)).report


def _static_sql():
    woe = _woe_sql().replace("WITH " + FEATURES + ",\n", "")
    numeric = NUMERIC_FEATURES
    probs = ", ".join(repr(i / 10) for i in range(11))
    parts = []
    for c in numeric:
        filled = f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM feats))"
        parts.append(f"""SELECT '{c}' AS variable, CAST(len(list_filter(e[2:len(e) - 1], lambda q: q < x)) AS VARCHAR) AS bin, target FROM
  (SELECT {filled} AS x, target FROM feats), (SELECT list_sort(list_distinct(quantile_cont({filled}, [{probs}]))) AS e FROM feats)""")
    parts += [f"SELECT '{c}' AS variable, {c} AS bin, target FROM feats" for c in IV_TEXT]
    nulls = "\nUNION ALL ".join(f"SELECT '{c}' AS f, count(*) FILTER ({c} IS NULL) / count(*) AS s FROM feats"
                                for c in STATIC_COLUMNS if c != "target")
    var = "\nUNION ALL ".join(f"SELECT '{c}' AS f, var_samp({c}) AS v FROM feats" for c in numeric)
    return with_(FEATURES, f"nulls AS ({nulls})", "long AS (\n" + "\nUNION ALL ".join(parts) + ")", f"""
cells AS (SELECT variable, bin, count(*) AS n, sum(target) AS events FROM long GROUP BY 1, 2),
shares AS (SELECT *, greatest(events, 0.5::DOUBLE) / sum(events) OVER (PARTITION BY variable) AS s1,
  greatest(n - events, 0.5::DOUBLE) / sum(n - events) OVER (PARTITION BY variable) AS s0 FROM cells),
ivs AS (SELECT variable, sum(ln(s0 / s1) * (s0 - s1)) AS iv FROM shares GROUP BY 1),
gone1 AS (SELECT f FROM nulls WHERE s > 0.9),
gone2 AS (SELECT variable AS f FROM ivs WHERE iv < 0.02 AND variable NOT IN (SELECT f FROM gone1)),
vars AS ({var}),
{_corr_sql(numeric)},
gone3 AS (SELECT DISTINCT CASE WHEN a.v >= b.v THEN p.feature_2 ELSE p.feature_1 END AS f
  FROM pairs p JOIN vars a ON a.f = p.feature_1 JOIN vars b ON b.f = p.feature_2
  WHERE abs(r) > 0.8 AND p.feature_1 NOT IN (SELECT f FROM gone2) AND p.feature_2 NOT IN (SELECT f FROM gone2))""") + """
SELECT f AS "FEATURE_NAME", 'High Percentage of Null Values (threshold: above 90%)' AS "REASON_FOR_REMOVAL" FROM gone1
UNION ALL SELECT f, 'Low Information Value (threshold: Less than 0.02)' FROM gone2
UNION ALL SELECT f, 'High Correlation (threshold: above 0.8)' FROM gone3"""


def all_filters(spark, sf):
    df = stored(feature_frame(spark, sf, True), *STATIC_COLUMNS, "sample", "data_ref1")
    return filters.select_by_filters(df.where("sample = 'train'").drop("sample"),
                                     df.where("sample = 'test'").drop("sample"), "target", "data_ref1",
                                     params=FAST_TREES).report


QUERIES = [
    Query("ag6_null_ratio", null_ratio, with_(FEATURES) + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {rs(f'CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*)')} AS null_ratio FROM feats"
        for c in [*NUMERIC_FEATURES, "mostly_null", "l_returnflag"])),
    Query("ag7_woe_bins", woe_table, _woe_sql() + f"""
SELECT variable, CAST(n AS BIGINT) AS n, CAST(events AS BIGINT) AS events, {rs('woe')} AS woe, {rs('iv')} AS iv FROM woes"""),
    Query("ag7_information_value", information_value, _woe_sql() +
          f"SELECT variable, {rs('sum(iv)')} AS iv FROM woes GROUP BY variable"),
    Query("ag8_pearson_pairs", pearson, with_(FEATURES, _corr_sql()) + f"SELECT feature_1, feature_2, {rs('r')} AS r FROM pairs"),
    Query("ag8_pearson_blocks", pearson_blocks, with_(FEATURES, _corr_sql(TWO_FEATURES)) + f"SELECT feature_1, feature_2, {rs('r')} AS r FROM pairs"),
    Query("ag8_correlated_pairs", correlated, with_(FEATURES, _corr_sql()) +
          f"SELECT feature_1, feature_2, {rs('r')} AS r FROM pairs WHERE abs(r) > 0.8"),
    Query("ag8_correlation_matrix", matrix, with_(FEATURES, _corr_sql()) + f"""
SELECT feature_1, feature_2, {rs('r')} AS r FROM pairs UNION ALL SELECT feature_2, feature_1, {rs('r')} FROM pairs
UNION ALL SELECT f, f, 1.0 FROM (SELECT unnest({CORR_FEATURES}) AS f)"""),
    Query("ag9_keep_by_variance", keep_by_variance, with_(FEATURES, _corr_sql(), "vars AS (" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS f, var_samp({c}) AS v FROM feats" for c in CORR_FEATURES) + ")") + """
SELECT feature_1, feature_2, CASE WHEN a.v >= b.v THEN feature_2 ELSE feature_1 END AS drop_feature
FROM pairs JOIN vars a ON a.f = feature_1 JOIN vars b ON b.f = feature_2 WHERE abs(r) > 0.8"""),
    Query("ag10_univariate_auc", univariate_auc, with_(FEATURES, auc_sql(CORR_FEATURES)) +
          f"SELECT feature, {rs('auc')} AS auc FROM aucs"),
    Query("ag10_keep_by_auc", keep_by_auc, with_(FEATURES, _corr_sql(), auc_sql(CORR_FEATURES)) + f"""
SELECT feature_1, feature_2, {rs('a.auc')} AS value_1, {rs('b.auc')} AS value_2,
  CASE WHEN a.auc >= b.auc THEN feature_2 ELSE feature_1 END AS drop_feature
FROM pairs JOIN aucs a ON a.feature = feature_1 JOIN aucs b ON b.feature = feature_2 WHERE abs(r) > 0.8"""),
    Query("ag24_category_frequency", frequencies,
          "SELECT p_brand AS value, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1 HAVING count(*) > 40"),
    Query("w4_frequency_rank", frequency_ranks, with_(
        _CUSTOMERS, _codes("seg", "c_mktsegment"), _codes("nat", "c_nationkey")) + """
SELECT 'c_mktsegment' AS variable, v AS value, CAST(n AS BIGINT) AS n, CAST(code AS BIGINT) AS code FROM seg
UNION ALL SELECT 'c_nationkey', v, CAST(n AS BIGINT), CAST(code AS BIGINT) FROM nat"""),
    Query("w5_average_rank", value_ranks, with_(SCORED) + "\nUNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS feature, {c} AS value, CAST(rank() OVER (ORDER BY {c})
  + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS DOUBLE) AS avg_rank FROM scored""" for c in ("l_extendedprice", "l_quantity"))),
    Query("en1_rank_count_encoder", rank_count, with_(
        _CUSTOMERS, _codes("seg", "c_mktsegment", "AND c_custkey % 2 = 0"),
        _codes("nat", "c_nationkey", "AND c_custkey % 2 = 0")) + """
SELECT c_custkey, CAST(CASE WHEN c_mktsegment IS NULL THEN -999 ELSE coalesce(seg.code, 1) END AS INTEGER) AS c_mktsegment,
  CAST(CASE WHEN c_nationkey IS NULL THEN -999 ELSE coalesce(nat.code, 1) END AS INTEGER) AS c_nationkey
FROM cust LEFT JOIN seg ON seg.v = c_mktsegment LEFT JOIN nat ON nat.v = c_nationkey"""),
    Query("en2_standard_scaler", standard_scaled, with_(_SAMPLED_FEATURES) + f"SELECT {', '.join(ROW_KEY)}, sample, " + ", ".join(
        rs(f"({c} - (SELECT avg({c}) FROM sfeats WHERE sample = 'train')) / (SELECT stddev_pop({c}) FROM sfeats WHERE sample = 'train')")
        + f" AS {c}" for c in SCALED) + " FROM sfeats"),
    Query("en3_max_abs_scaler", max_abs_scaled, with_(_SAMPLED_FEATURES) + f"SELECT {', '.join(ROW_KEY)}, sample, " + ", ".join(
        rs(f"coalesce({c}, -99999) / (SELECT max(abs(coalesce({c}, -99999))) FROM sfeats WHERE sample = 'train')")
        + f" AS {c}" for c in SCALED) + " FROM sfeats"),
    *[Query(f"en4_prepare_{k}", _recipe(k), _recipe_sql(k)) for k in ("lgbm", "xgboost", "catboost", "logit")],
    Query("ca1_isotonic_calibration", isotonic, ISOTONIC_HULL_SQL),
    Query("ca1_isotonic_calibration_tied", isotonic_tied, ISOTONIC_SQL),
    Query("ca2_sigmoid_calibration", sigmoid),
    Query("ca2_sigmoid_coefficients", sigmoid_coefficients, _newton_sql()),
    Query("ca3_quantile_transform", quantile_transform, _quantile_sql("proba", 200)),
    Query("ca3_quantile_transform_tied", quantile_transform_tied, _quantile_sql("proba_tied", 100)),
    Query("ml1_score_boosted_trees", _fit("lgbm", FAST_TREES)),
    Query("ml1_score_forest", _fit("forest", {"numTrees": 8, "maxDepth": 4})),
    Query("ml1_score_logit", _fit("logit", {"maxIter": 50})),
    Query("ml2_baseline", baseline),
    Query("ml3_random_search", search),
    Query("ml5_train_and_report", full_report),
    Query("ml6_linear_importance", linear_importance, with_(SCORED) + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {rs(f'avg(abs({w} * ({c} - (SELECT avg({c}) FROM scored))))')} AS importance FROM scored"
        for c, w in COEFFICIENTS.items())),
    Query("ml6_tree_importance", tree_importance),
    Query("ml6_exchange_importance", exchange_importance),
    Query("ml7_drift_elimination", drift),
    Query("ml8_progressive_curve", curve),
    Query("ml9_forward_selection", forward),
    Query("ml10_recursive_elimination", recursive),
    Query("ml11_all_relevant", boruta),
    Query("ml12_f_statistic", f_statistic, _f_sql()),
    Query("ml12_mrmr_ranking", mrmr, _mrmr_sql()),
    Query("ml13_spearman_pairs", spearman, with_(FEATURES, _SPEARMAN_RANKS, _corr_sql(SPEARMAN_FEATURES, "rk")) +
          f"SELECT feature_1, feature_2, {rs('r')} AS r FROM pairs"),
    Query("ml13_smart_correlated", smart_correlated, with_(FEATURES, auc_sql(["l_extendedprice", "net_price"])) + f"""
SELECT 1 AS correlation_group, feature, {rs('auc')} AS auc, auc < max(auc) OVER () AS dropped FROM aucs"""),
    Query("ml14_selector_coordinator", coordinator),
    Query("ml15_static_filters", static_filters, _static_sql()),
    Query("ml15_all_filters", all_filters),
]
