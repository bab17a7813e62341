"""Profiling, encoders and calibration against pandas / numpy."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorekit.operators import calibrate, encode, profile
from scorekit.operators.metrics import feature_auc


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    n = 4000
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"a": a, "twin": a * 2 + rng.normal(scale=0.1, size=n), "b": rng.exponential(size=n),
                        "ties": rng.integers(0, 4, n).astype(float), "flat": np.full(n, 0.1)})
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(-a))).astype(int)
    pdf["holes"] = np.where(rng.random(n) < 0.3, np.nan, pdf["b"] + pdf["y"])
    pdf["text"] = pd.Series(rng.choice(["p", "q", "r"], n)).where(pd.Series(rng.random(n) > 0.1), None)
    pdf["k"] = np.arange(n)
    return pdf


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data).repartition(5).cache()


def test_null_ratio(df, data):
    got = {r.feature: r.null_ratio for r in profile.null_ratio(df, ["y"]).collect()}
    assert got["holes"] == pytest.approx(data.holes.isna().mean()) and got["text"] == pytest.approx(data.text.isna().mean())
    assert profile.high_missing(df, "y", 0.25) == ["holes"] and profile.high_missing(df, "y", 0.99) == []
    assert profile.high_missing(df, "y", got["holes"]) == []


def brute_iv(x, y, numeric):
    if numeric:
        x = x.fillna(x.median())
        bins = pd.qcut(x, 10, duplicates="drop").astype(str)
    else:
        bins = x.astype(object).where(x.notna(), "nan")
    d = pd.DataFrame({"x": bins, "y": y}).groupby("x").y.agg(["count", "sum"])
    events, others = d["sum"], d["count"] - d["sum"]
    s1, s0 = np.maximum(events, 0.5) / events.sum(), np.maximum(others, 0.5) / others.sum()
    return float((np.log(s0 / s1) * (s0 - s1)).sum())


def test_information_value(df, data):
    numeric = ["a", "b", "ties", "holes", "flat"]
    got = {r.variable: r.iv for r in profile.information_value(df, "y", numeric, ["text"]).collect()}
    for c in numeric[:-1]:
        assert got[c] == pytest.approx(brute_iv(data[c], data.y, True)), c
    assert got["text"] == pytest.approx(brute_iv(data.text, data.y, False))
    assert got["flat"] == 0 and all(v >= 0 for v in got.values())


def test_correlation_agrees_with_pandas(df, data):
    columns = ["a", "twin", "b", "ties", "holes", "flat"]
    expected = data[columns].corr()
    for chosen in (columns, ["a", "flat"], ["a", "holes"], ["b", "twin"]):
        for r in profile.pearson_pairs(df, chosen).collect():
            want = expected.loc[r.feature_1, r.feature_2]
            assert (r.r is None) if np.isnan(want) else r.r == pytest.approx(want, abs=1e-10)
    pairs = profile.correlated_pairs(df, 0.9, columns)
    assert [(r.feature_1, r.feature_2) for r in pairs.collect()] == [("twin", "a")]
    drops = profile.drop_by_variance(df, pairs, columns).first()
    assert drops.drop_feature == "a"
    assert profile.drop_by_auc(df, pairs, columns, "y").first().drop_feature in ("a", "twin")


def test_ties_keep_the_first_feature(spark):
    pairs = spark.createDataFrame([("a", "b", 0.99)], "feature_1 string, feature_2 string, r double")
    quality = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "feature string, value double")
    assert profile.keep_better(pairs, quality).first().drop_feature == "b"


def test_spearman(df, data):
    columns = ["a", "twin", "b", "ties"]
    expected = data[columns].rank().corr()
    for r in profile.spearman_pairs(df, columns).collect():
        assert r.r == pytest.approx(expected.loc[r.feature_1, r.feature_2], abs=1e-10)
    copies = df.select(*columns).unionAll(df.select(*columns).limit(500)).cache()
    expected = copies.toPandas().rank().corr()
    for r in profile.spearman_pairs(copies, columns).collect():
        assert r.r == pytest.approx(expected.loc[r.feature_1, r.feature_2], abs=1e-10)
    ranks = {(r.feature, r.value): r.avg_rank for r in profile.average_ranks(df, ["ties"]).collect()}
    want = data.ties.rank().groupby(data.ties).first()
    assert ranks == {("ties", v): want[v] for v in want.index}
    table = profile.smart_correlated_drops(df, columns, "y", 0.9).collect()
    assert {r.feature for r in table} == {"a", "twin"} and sum(r.dropped for r in table) == 1


def test_univariate_auc_is_direction_free(df, data):
    got = {r.feature: r.auc for r in feature_auc(df, ["a", "holes"], "y").collect()}
    for c in got:
        x = data[c].fillna(data[c].mean())
        pos, neg = x[data.y == 1].values, x[data.y == 0].values
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        assert got[c] == pytest.approx(max(auc, 1 - auc))


def test_f_statistic_and_mrmr(df, data):
    features = ["a", "b", "ties", "twin"]
    got = {r.feature: r.f for r in profile.f_statistic(df, features, "y").collect()}
    for c in features:
        g = [data.loc[data.y == k, c] for k in (0, 1)]
        between = sum(len(x) * (x.mean() - data[c].mean()) ** 2 for x in g)
        within = sum(((x - x.mean()) ** 2).sum() for x in g) / (len(data) - 2)
        assert got[c] == pytest.approx(between / within)
    ranking = profile.mrmr_ranking(df, features, "y", 3)
    assert ranking[0] == max(got, key=got.get) and len(ranking) == 3


def test_rank_count_worked_example(spark):
    df = spark.createDataFrame([(c,) for c in ["a", "a", "a", "a", "b", "c", "c", None]], "cat string")
    model = encode.RankCountEncoder(["cat"], set_nans=-1, min_count=0).fit(df)
    assert sorted(r.cat for r in model.transform(df).collect()) == sorted([3, 3, 3, 3, 1, 2, 2, -1])
    rare = encode.RankCountEncoder(["cat"]).fit(df).transform(df)
    assert sorted(r.cat for r in rare.collect()) == [-999, 1, 1, 1, 1, 1, 1, 1]
    unseen = model.transform(spark.createDataFrame([("zzz",), ("a",)], "cat string"))
    assert sorted(r.cat for r in unseen.collect()) == [1, 3]


def test_codes_are_contiguous_and_ordered(spark):
    rows = [(f"v{i}",) for i in range(300) for _ in range(1 + i % 4)]
    ranks = encode.frequency_ranks(spark.createDataFrame(rows, "c string"), ["c"], 0).collect()
    order = sorted(((r.n, hashlib.md5(r.value.encode()).hexdigest(), r.value) for r in ranks))
    assert {r.value: r.code for r in ranks} == {v: i for i, (_, _, v) in enumerate(order, 1)}


def test_long_mapping_uses_the_shuffled_path(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "cat string")
    model = encode.RankCountEncoder(["cat"], min_count=0).fit(df)
    other = encode.RankCountModel(model.mapping, ["cat"], -999)
    assert sorted(r.cat for r in other.transform(df).collect()) == sorted(r.cat for r in model.transform(df).collect())


def test_several_long_mappings_share_a_join(spark):
    rng = np.random.default_rng(30)
    names = np.array(["a", "b", "c", "d", None], object)
    rows = [(i, *(names[k] for k in rng.integers(0, 5, 3)), "kept") for i in range(300)] * 2
    df = spark.createDataFrame(rows, "k int, x string, y string, z string, _codes_of string")
    model = encode.RankCountEncoder(["x", "y", "z"], min_count=115).fit(df)
    assert model.short_columns == {"x", "y", "z"}
    for short in ((), ("y",)):
        long = encode.RankCountModel(model.mapping, ["x", "y", "z"], -999, model.short, frozenset(short))
        out = long.transform(df)
        assert out.columns == df.columns
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, model.transform(df).collect()))
        if not short:
            assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2  # values to codes, codes to rows


def test_scalers(df, data):
    scaled = encode.fit_standard(df, ["holes", "flat"]).transform(df).select("k", "holes", "flat").toPandas().set_index("k")
    want = (data.holes - data.holes.mean()) / data.holes.std(ddof=0)
    assert np.allclose(scaled.holes.sort_index(), want, equal_nan=True)
    assert np.allclose(scaled.flat, 0)
    scaled = encode.fit_max_abs(df, ["a"]).transform(df).select("k", "a").toPandas().set_index("k")
    assert np.allclose(scaled.a.sort_index(), data.a / data.a.abs().max())


def test_preprocessors_pass_other_columns_through(df):
    for kind in ("lgbm", "xgboost", "catboost", "logit"):
        out = encode.fit_preprocessor(kind, df, ["a", "holes"], ["text"]).transform(df)
        assert out.columns == df.columns
        first, again = out.orderBy("k").first(), df.orderBy("k").first()
        assert first["y"] == again["y"] and first["twin"] == again["twin"]
    assert encode.fit_preprocessor("logit", df, ["holes"], []).transform(df).where("holes IS NULL").count() == 0
    with pytest.raises(ValueError):
        encode.fit_preprocessor("other", df, ["a"], [])


@pytest.mark.parametrize("tile", [1, 3, 64])
def test_correlation_in_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(profile, "TILE", tile)
    rng = np.random.default_rng(21)
    data = pd.DataFrame(rng.normal(size=(500, 8)), columns=[f"c{i}" for i in range(8)])
    data["c3"] = data.c1 * 2 + rng.normal(size=500) / 10
    data = data.mask(rng.random(data.shape) < 0.1)
    found = profile.pearson_pairs(spark.createDataFrame(data).repartition(20), list(data.columns)).collect()
    want = data.corr()
    assert len(found) == 28 and all(r.r == pytest.approx(want.loc[r.feature_1, r.feature_2], abs=1e-9) for r in found)
    assert all(r.feature_1 > r.feature_2 for r in found)


def test_wide_correlation_shuffles_tiles(spark):
    df = spark.range(0, 400, 1, 40).select(*[((F.col("id") * (i + 7)) % 101).cast("double").alias(f"c{i}") for i in range(200)])
    plan = profile.pearson_pairs(df, df.columns)
    assert "Coalesce" in plan._jdf.queryExecution().optimizedPlan().toString() or "Repartition" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == 200 * 199 // 2


def brute_isotonic(p, y):
    points = pd.DataFrame({"p": p, "y": y}).groupby("p").y.agg(["mean", "count"]).reset_index()
    blocks = []
    for _, r in points.iterrows():
        blocks.append([r["mean"], r["count"], [r["p"]]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, p2 = blocks.pop()
            m1, w1, p1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, p1 + p2])
    return {x: m for m, _, ps in blocks for x in ps}


def test_isotonic_matches_pool_adjacent_violators(spark):
    rng = np.random.default_rng(8)
    p = rng.integers(1, 60, 2000) / 60
    y = (rng.random(2000) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    fitted = calibrate.fit_isotonic(df, "p", "y")
    want = brute_isotonic(p, y)
    rows = fitted.transform(df, "p").distinct().collect()
    for r in rows:
        assert r.calibrated_prob == pytest.approx(min(max(want[r.p], p.min()), p.max()))
    ordered = [r.calibrated_prob for r in sorted(rows, key=lambda r: r.p)]
    assert ordered == sorted(ordered)
    outside = fitted.transform(spark.createDataFrame([(0.0,), (1.0,)], "p double"), "p").collect()
    assert [r.calibrated_prob for r in outside] == [ordered[0], ordered[-1]]


@pytest.mark.parametrize("kind", ["noise", "rising", "falling"])
def test_isotonic_in_many_buckets_and_by_lookup(spark, kind):
    rng = np.random.default_rng(18)
    p = np.round(rng.random(5000), 4)
    y = {"noise": (rng.random(5000) < p), "rising": p > 0.5, "falling": p < 0.5}[kind].astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)] + [(None, 1), (0.5, None)], "p double, y int")
    fitted = calibrate.fit_isotonic(df, "p", "y", most=200, merged=2)
    want = brute_isotonic(p, y)
    probes = spark.createDataFrame([(float(x), i) for i, x in enumerate([*p, *rng.random(300), -1.0, 2.0])] + [(None, -1)], "p double, i int")
    searched = {r.i: r.calibrated_prob for r in fitted.transform(probes, "p").collect()}
    looked_up = {r.i: r.calibrated_prob for r in fitted.transform(probes, "p", searched=0).collect()}
    assert searched.keys() == looked_up.keys() and searched[-1] is None and looked_up[-1] is None
    assert all(searched[i] == pytest.approx(looked_up[i], abs=1e-12) for i in searched if i >= 0)
    assert all(searched[i] == pytest.approx(min(max(want[x], p.min()), p.max())) for i, x in enumerate(p))
    nothing = calibrate.fit_isotonic(df.where("p > 5"), "p", "y")
    assert {r.calibrated_prob for r in nothing.transform(probes, "p").collect()} == {None}


def test_sigmoid_matches_newton(spark):
    rng = np.random.default_rng(9)
    f = rng.normal(size=1500)
    y = (rng.random(1500) < 1 / (1 + np.exp(-(1.7 * f - 0.4)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(f, y)], "f double, y int")
    fitted = calibrate.fit_sigmoid(df, "f", "y")
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    design, w = np.column_stack([f, np.ones_like(f)]), np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-design @ w))
        w += np.linalg.solve(design.T @ (design * (q * (1 - q))[:, None]), design.T @ (t - q))
    assert fitted.slope == pytest.approx(w[0], abs=1e-3) and fitted.intercept == pytest.approx(w[1], abs=1e-3)


def test_quantile_transform_matches_two_sided_interpolation(spark):
    rng = np.random.default_rng(10)
    for x in (rng.random(3000), rng.integers(0, 9, 3000) / 9):
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        fitted = calibrate.fit_quantile_transform(df, "x", 100)
        probe = np.unique(np.concatenate([x[:200], [-1.0, 2.0, x.min(), x.max()], rng.random(50)]))
        steps = np.linspace(0, 1, 100)
        marks = np.quantile(x, steps)
        want = 0.5 * (np.interp(probe, marks, steps) - np.interp(-probe, -marks[::-1], -steps[::-1]))
        want[probe == marks[-1]], want[probe == marks[0]] = 1.0, 0.0
        rows = fitted.transform(spark.createDataFrame([(float(v),) for v in probe], "x double"), "x").collect()
        got = {r.x: r.calibrated_prob for r in rows}
        assert np.allclose([got[v] for v in probe], want, atol=1e-9)


def test_spearman_ranks_wide_rows(spark, monkeypatch):
    """Ranks of hot values, holes, both zeros and infinities equal pandas', whether a column is sorted or counted; no value meets
    its rank in a join."""
    rng = np.random.default_rng(5)
    n = 3000
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"fine": x, "hot": np.where(rng.random(n) < 0.4, 0.0, x + rng.normal(size=n)), "flags": rng.integers(0, 2, n) * 1.0,
                        "signs": rng.choice([-0.0, 0.0, 1.0], n), "holes": np.where(rng.random(n) < 0.3, np.nan, -x),
                        "ends": np.where(rng.random(n) < 0.1, np.inf, np.round(x, 1)), "gone": np.full(n, np.nan)})
    columns = list(pdf.columns)
    table = spark.createDataFrame(pdf).repartition(3).cache()
    expected = pdf.replace([np.inf, -np.inf], np.nan).rank().corr()

    def check():
        for r in profile.spearman_pairs(table, columns).collect():
            want = expected.loc[r.feature_1, r.feature_2]
            assert (r.r is None) if np.isnan(want) else r.r == pytest.approx(want, abs=1e-10)
    with monkeypatch.context() as patch:
        patch.setattr(profile, "SORTED_COLUMNS", 0)
        check()
    monkeypatch.setattr(profile, "RANK_CELLS", 30)
    monkeypatch.setattr(profile, "EDGE_ROWS", 500)
    monkeypatch.setattr(profile, "spread_join", None)
    check()
    assert profile.spearman_pairs(table.limit(0), columns).where("r IS NOT NULL").count() == 0
