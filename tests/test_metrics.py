"""Exact metrics and order statistics against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.functions.order_stats import BUCKET, exact_quantiles, filled_quantiles, grouped_quantiles, ordered_buckets, row_rank, running_sums, surrounding
from scorekit.operators import metrics, reports


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def brute_signed_ks(y, p):
    points = np.unique(p)
    gaps = [(p[y == 0] <= t).mean() - (p[y == 1] <= t).mean() for t in points]
    points, gaps = list(points), list(gaps)
    if points[0] != 0:
        points, gaps = [0.0, *points], [0.0, *gaps]
    if points[-1] != 1:
        points, gaps = [*points, 1.0], [*gaps, 0.0]
    best = int(np.argmax(gaps))
    return gaps[best], points[best]


def frame(spark, y, p, g=None):
    g = np.zeros(len(y), int) if g is None else g
    return spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, p, g)], "y int, p double, g int")


CASES = [(1, 3), (2, 50), (3, 1000)]


@pytest.mark.parametrize("seed,levels", CASES)
def test_auc_and_ks_match_brute_force(spark, seed, levels):
    rng = np.random.default_rng(seed)
    y, p = rng.integers(0, 2, 800), rng.integers(0, levels, 800) / levels
    df = frame(spark, y, p)
    row = metrics.auc_and_ks(df, "p", "y").first()
    assert row["auc"] == pytest.approx(brute_auc(y, p))
    gaps = [abs((p[y == 0] <= t).mean() - (p[y == 1] <= t).mean()) for t in np.unique(p)]
    assert row["ks"] == pytest.approx(max(gaps))
    inverse = metrics.roc_auc(df.withColumn("q", 1 - F.col("p")), "q", "y").first()["auc"]
    assert row["auc"] + inverse == pytest.approx(1.0)


@pytest.mark.parametrize("seed,levels", CASES)
def test_signed_ks_and_threshold(spark, seed, levels):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 300)
    for p in (rng.integers(0, levels, 300) / levels, 0.2 + 0.6 * rng.random(300), 1 - y * 0.5 - 0.1):
        row = metrics.ks_signed(frame(spark, y, p), "p", "y").first()
        ks, at = brute_signed_ks(y, np.asarray(p, float))
        assert row["ks"] == pytest.approx(ks) and row["threshold"] == pytest.approx(at)


def test_one_class_and_all_ties(spark):
    df = frame(spark, [1, 1, 0, 1, 0], [0.2, 0.3, 0.5, 0.5, 0.5], [1, 1, 2, 2, 2])
    rows = {r["MONTH"]: r for r in metrics.auc_over_time(df, "g", "y", "p").collect()}
    assert rows[1]["AUC"] is None and rows[2]["AUC"] == 0.5
    rows = {r["MONTH"]: r for r in metrics.ks_over_time(df, "g", "y", "p").collect()}
    assert rows[1]["KS"] is None and rows[1]["THRESHOLD"] is None and rows[2]["KS"] == 0


def test_grouped_metrics_scale_the_threshold_once(spark):
    rng = np.random.default_rng(4)
    y, p, g = rng.integers(0, 2, 600), rng.random(600), rng.integers(0, 3, 600)
    for r in metrics.ks_over_time(frame(spark, y, p, g), "g", "y", "p").collect():
        ks, at = brute_signed_ks(y[g == r["MONTH"]], p[g == r["MONTH"]])
        assert r["KS"] == pytest.approx(ks) and r["THRESHOLD"] == pytest.approx(at * 1000)


def test_no_window_without_partition(spark):
    df = frame(spark, [0, 1], [0.1, 0.2])
    plan = metrics.auc_and_ks(df, "p", "y")._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "_in_pos" in line and "Window" in line]
    assert rows and all("score_bucket" in line for line in rows)


def test_a_score_holding_a_third_of_the_rows(spark):
    rng = np.random.default_rng(5)
    p = np.where(rng.random(6000) < 0.34, 0.5, rng.random(6000))
    y = (rng.random(6000) < p).astype(int)
    row = metrics.auc_and_ks(frame(spark, y, p), "p", "y").first()
    assert row["auc"] == pytest.approx(brute_auc(y, p))


def test_exact_quantiles(spark):
    rng = np.random.default_rng(6)
    n = 60_000
    data = {"smooth": rng.normal(size=n), "tied": rng.integers(0, 5, n).astype(float),
            "hot": np.where(rng.random(n) < 0.34, 7.0, rng.exponential(size=n)),
            "constant": np.full(n, 3.0)}
    holes = rng.random(n) < 0.9
    import pandas as pd
    pdf = pd.DataFrame(data)
    pdf["short"] = np.where(holes, np.nan, pdf["smooth"])
    pdf["empty"] = np.nan
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [i / 20 for i in range(21)] + [0.00001, 0.333, 0.99999]
    found = exact_quantiles(df, list(pdf.columns), probs)
    for c in ("smooth", "tied", "hot", "constant", "short"):
        expected = np.quantile(pdf[c].dropna(), probs)
        assert np.allclose(found[c], expected, rtol=1e-12, atol=1e-12), c
    assert found["empty"] == [None] * len(probs)


@pytest.mark.parametrize("n", [1, 2, 7, 40_000])
def test_quantiles_of_filled_columns(spark, n):
    import pandas as pd
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"smooth": rng.normal(size=n), "tied": rng.integers(0, 4, n) / 4.0, "mostly": rng.random(n), "whole": rng.random(n)})
    for c, share in (("smooth", 0.3), ("tied", 0.2), ("mostly", 0.97)):
        pdf.loc[(rng.random(n) < share) & (np.arange(n) > 0), c] = np.nan
    pdf["empty"] = np.nan
    probs = [i / 20 for i in range(21)] + [0.333]
    got = filled_quantiles(spark.createDataFrame(pdf).repartition(3), list(pdf.columns), probs)
    assert set(got) == {"smooth", "tied", "mostly", "whole"}
    for c, (median, values) in got.items():
        assert median == pytest.approx(pdf[c].median(), abs=1e-12)
        assert np.allclose(values, np.quantile(pdf[c].fillna(pdf[c].median()), probs), rtol=1e-12, atol=1e-12), c


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_grouped_quantiles(spark, monkeypatch, accuracy):
    monkeypatch.setattr("scorekit.functions.order_stats.SKETCH_ACCURACY", accuracy)
    import pandas as pd
    rng = np.random.default_rng(16)
    n = 20_000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c", "one"], n, p=[0.7, 0.25, 0.0499, 0.0001]), "h": rng.integers(0, 2, n),
                        "smooth": rng.normal(size=n), "tied": rng.integers(0, 4, n) / 4.0, "hot": np.where(rng.random(n) < 0.6, 1.0, rng.random(n))})
    pdf.loc[rng.random(n) < 0.1, "smooth"] = np.nan
    pdf.loc[pdf.g == "b", "tied"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "c", F.col("g"))).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.501, 0.999, 1.0]
    rows = grouped_quantiles(df, ["g", "h"], ["smooth", "tied", "hot"], probs).collect()
    got = {(r["g"], r["h"], r["variable"], r["prob"]): r["value"] for r in rows}
    assert len(got) == len(rows)
    count = 0
    for (g, h), part in pdf.groupby(["g", "h"]):
        for c in ("smooth", "tied", "hot"):
            values = part[c].dropna()
            for p in probs if len(values) else ():
                assert got[None if g == "c" else g, h, c, p] == pytest.approx(np.quantile(values, p), abs=1e-12), (g, h, c, p)
                count += 1
    assert count == len(got)


def test_reports_by_group_equal_those_of_each_group(spark):
    rng = np.random.default_rng(17)
    rows = [(s, float(p), int(rng.random() < p), int(p > 0.5), float(x), m) for s in ("x", "y", "z")
            for p, x, m in zip(np.round(rng.random(400) ** (1 + (s == "y")), 2), rng.random(400), ["m1", "m2"] * 200)]
    df = spark.createDataFrame(rows, "sample string, p double, y int, pred int, x double, month string").withColumn("score", 1000 - F.col("p") * 1000)
    from scorekit.operators import profile
    both = {
        "ratings": (reports.rating_tables(df, ["sample"], "p", "y", 7), lambda d: reports.rating_table(d, "p", "y", 7)),
        "summary": (reports.score_summaries(df, ["sample"], "score", "y"), lambda d: reports.score_summary(d, "score", "y")),
        "report": (metrics.classification_report(df, "y", "pred", ["sample"]), lambda d: metrics.classification_report(d, "y", "pred")),
        "cohorts": (reports.cohort_monitor(df, "month", "y", "score", keys=["sample"]), lambda d: reports.cohort_monitor(d, "month", "y", "score")),
        "correlation": (profile.correlation_matrices(df, ["p", "x", "score"], "sample"), lambda d: profile.correlation_matrix(d, ["p", "x", "score"])),
    }
    plain = lambda rows, columns: sorted(str([round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns]) for r in rows)
    for name, (grouped, single) in both.items():
        rows = grouped.collect()
        for s in ("x", "z"):
            want = single(df.where(F.col("sample") == s))
            assert plain([r for r in rows if r["sample"] == s], want.columns) == plain(want.collect(), want.columns), name


def test_running_sums_and_ranks_over_buckets(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id % 97 AS v", "1 AS one", "id", "(id % 97) div 10 AS b")
    counted = df.groupBy("k", "b", "v").agg(F.sum("one").alias("n"))
    for r in running_sums(counted, ["k"], "b", "v", ["n"]).collect():
        expected = sum(1 for i in range(1000) if i % 3 == r["k"] and i % 97 <= r["v"])
        assert r["cum_n"] == expected and r["tot_n"] == sum(1 for i in range(1000) if i % 3 == r["k"])
    ranked = row_rank(df, ["k"], ["b"], ["v", "id"], "rn").collect()
    for k in range(3):
        order = sorted((i % 97, i) for i in range(1000) if i % 3 == k)
        assert {r["id"]: r["rn"] for r in ranked if r["k"] == k} == {i: n for n, (_, i) in enumerate(order, 1)}


@pytest.mark.parametrize("ties", [0.0, 0.99])
def test_buckets_are_bounded_and_ordered(spark, ties):
    rng = np.random.default_rng(12)
    values = np.where(rng.random(150_000) < ties, 0.5, rng.random(150_000) ** 3)
    y = (rng.random(len(values)) < values).astype(int)
    df = frame(spark, y, values)
    counted = metrics.class_counts(df, "p", "y")
    stored = ordered_buckets(counted, [], "score", most=1000)
    ranges = sorted((r["a"], r["b"], r["n"], r[BUCKET]) for r in stored.groupBy(BUCKET).agg(
        F.min("score").alias("a"), F.max("score").alias("b"), F.count("*").alias("n")).collect())
    assert sum(r[2] for r in ranges) == len(np.unique(values)) and max(r[2] for r in ranges) <= 1000
    assert all(one[1] < two[0] and one[3] < two[3] for one, two in zip(ranges, ranges[1:]))
    placed = running_sums(stored, [], BUCKET, "score", ["pos", "neg"])
    assert placed.agg(metrics.auc_expression()).first()[0] == pytest.approx(brute_auc(y, values))


def test_buckets_keep_keys_apart(spark):
    df = spark.range(30_000).selectExpr("id % 7 AS k", "if(id % 11 = 0, null, id % 5000) AS v", "1L AS n")
    stored = ordered_buckets(df.groupBy("k", "v").agg(F.sum("n").alias("n")), ["k"], "v", most=500)
    assert stored.groupBy(BUCKET).count().agg(F.max("count")).first()[0] <= 500
    wrong = (stored.alias("a").join(stored.alias("b"), "k").where(
        f"(a.v < b.v OR a.v IS NULL AND b.v IS NOT NULL) AND a.{BUCKET} > b.{BUCKET}"))
    assert wrong.isEmpty()
    assert ordered_buckets(df.where("id < 0"), ["k"], "v").count() == 0


def test_surrounding_points(spark):
    rng = np.random.default_rng(13)
    xs = np.unique(np.round(rng.random(300), 3))
    probes = np.unique(np.concatenate([np.round(rng.random(4000) * 1.4 - 0.2, 4), xs[:20]]))
    points = spark.createDataFrame([(float(x), float(i)) for i, x in enumerate(xs)], "x double, y double")
    rows = surrounding(spark.createDataFrame([(float(x),) for x in probes], "x double"), points, most=100).collect()
    got = {r["x"]: (r["x0"], r["y0"], r["x1"], r["y1"]) for r in rows}
    for x in probes:
        a, b = np.searchsorted(xs, x, "right") - 1, np.searchsorted(xs, x, "left")
        left = (xs[a], float(a)) if a >= 0 else (None, None)
        right = (xs[b], float(b)) if b < len(xs) else (None, None)
        assert got[x] == (*left, *right)


def test_classification_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "y int, p int")
    rows = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["1"]["precision"] == pytest.approx(2 / 3) and rows["1"]["support"] == 3
    assert rows["accuracy"]["support"] == pytest.approx(0.6)
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2)
    empty = metrics.classification_report(df.where("p = 0"), "y", "p").collect()
    assert {r["label"]: r["precision"] for r in empty}["1"] == 0.0


def test_ratings_merge_equal_edges(spark):
    df = frame(spark, [0, 1] * 50, [0.2] * 60 + [0.7] * 40)
    rows = reports.rating_table(df, "p", "y").collect()
    assert sum(r["volume"] for r in rows) == 100 and {r["rating"] for r in rows} <= {"R1", "R2"}


def test_importance_and_status(spark):
    imp = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.0)], "feature string, importance double")
    assert [(r.feature, r.importance) for r in reports.normalised_importance(imp, 2).collect()] == [("a", 75.0), ("b", 25.0)]
    assert reports.most_important(imp).first()["feature"] == "a"
    report = reports.removal_report(spark, [(["b"], "weak")])
    status = reports.feature_status(spark, ["a", "b", "id"], report, ["id"])
    assert {r.FEATURE_NAME: r.DROP_COL for r in status.collect()} == {"a": 0, "b": 1}


def test_penalised_auc_formula():
    from scorekit.operators.train import penalise
    assert penalise(0.8, 0.7, 2.0) == pytest.approx(np.mean([0.8, 0.7]) - 2 * np.std([0.8, 0.7]))
