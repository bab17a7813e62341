"""Derived features against row-by-row Python."""

import math

import numpy as np
import pytest

from scorekit.functions import feature_names as names
from scorekit.operators import derive

X = [None, 0.0, 1.0, -1.0, 2.0, 10.0, 0.5, -3.5, 20.0]


def test_spec_sizes():
    sizes = {n: make().new_columns() for n, make in derive.FAMILY_SPECS.items()}
    assert sizes == {"materialidade_90": 960, "hefindahl": 320, "indice_liquidez": 254, "ranking_pcr": 386, "trend": 800}
    for make in derive.FAMILY_SPECS.values():
        spec = make()
        made = [c for u in spec.unary for c in derive.unary_features(u)]
        assert len(made) == 20 * len(spec.unary)


def test_concentration_pairs_cross_sides_by_default():
    pairs = derive.concentration_spec().pairs
    assert pairs[0] == ("ind_Hefindahl_H_paga_1m", "ind_Hefindahl_H_bene_2m")
    assert pairs[4] == ("ind_Hefindahl_H_bene_1m", "ind_Hefindahl_H_paga_2m")
    assert derive.concentration_spec(False).pairs[0] == ("ind_Hefindahl_H_paga_1m", "ind_Hefindahl_H_paga_2m")


def test_groups_and_pairs():
    groups = derive.group_by_stem(["b_2", "a_1", "b_1", "skip"], ["a", "b"], drop=["skip"])
    assert groups == {"a": ["a_1"], "b": ["b_1", "b_2"]}
    assert derive.adjacent_pairs(groups) == [("b_1", "b_2")]


def test_unary_features(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(X)], "i int, x double")
    rows = {r["i"]: r for r in derive.derive_family(df, derive.FamilySpec("u", unary=["x"])).collect()}
    for i, x in enumerate(X):
        r = rows[i]
        assert r["NEW__is_null_x"] == (x is None)
        assert r["NEW__multiple_of_10_x"] == int(x is not None and x % 10 == 0)
        if x is None:
            assert r["NEW__is_even_x"] is None and r["NEW__is_odd_x"] is None and r["NEW__exp_x"] is None
            continue
        assert r["NEW__polynomial_dg3_x"] == (None if x == 0 else pytest.approx(x ** 3))
        assert r["NEW__log_value_x"] == (pytest.approx(math.log(x)) if x > 0 else None)
        assert r["NEW__ln_value_x"] == (pytest.approx(math.log1p(x)) if x > -1 else None)
        assert r["NEW__inverse_x"] == (None if x == 0 else pytest.approx(1 / x))
        assert r["NEW__sqrt_x"] == (pytest.approx(math.sqrt(x)) if x >= 0 else None)
        assert r["NEW__arc_sin_value_x"] == (pytest.approx(math.asin(x)) if abs(x) <= 1 else None)
        assert r["NEW__hiperbolic_sin_x"] == pytest.approx(math.sinh(x))
        assert r["NEW__is_even_x"] == int(math.fmod(x, 2) == 0) and r["NEW__is_odd_x"] == int(math.fmod(x, 2) != 0)


def test_pair_features(spark):
    data = [(0, 2.0, 4.0), (1, 4.0, 4.0), (2, 0.0, 4.0), (3, None, 1.0), (4, 4.0, 1.0)]
    df = spark.createDataFrame(data, "i int, a double, b double")
    out = derive.derive_family(df, derive.FamilySpec("p", pairs=[("a", "b")]), ["i"])
    assert len(out.columns) == 14
    rows = {r["i"]: r for r in out.collect()}
    assert rows[0]["NEW__trend_ratio_b_vs_a"] == 2.0 and rows[0]["NEW__trend_cluster_b_vs_a"] == "Aumentou"
    assert rows[0]["NEW__trend_cluster_a_vs_b"] == "Diminuiu"
    assert rows[1]["NEW__trend_cluster_a_vs_b"] == "Manteve"
    assert rows[2]["NEW__trend_ratio_b_vs_a"] is None and rows[2]["NEW__trend_cluster_b_vs_a"] is None
    assert rows[2]["NEW__trend_ratio_a_vs_b"] == 0.0
    assert rows[3]["NEW__sum_b_vs_a"] is None
    assert rows[4]["NEW__delta_a_vs_mean_a_and_b"] == 1.5
    assert rows[4]["NEW__sqrt_of_delta_b_vs_mean_a_and_b"] == 2.25
    assert rows[4]["NEW__stddev_b_vs_a"] == pytest.approx(np.std([4.0, 1.0], ddof=1))


def test_family_statistics(spark):
    rng = np.random.default_rng(1)
    data = [[None if rng.random() < 0.3 else float(v) for v in rng.normal(size=5)] for _ in range(60)]
    data += [[None] * 5, [3.0] + [None] * 4, [2.0, 2.0, None, 2.0, None]]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, a double, b double, c double, d double, e double")
    out = derive.row_statistics(df, list("abcde"), "f", ["i"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    for r in out.collect():
        v = np.array([x for x in data[r["i"]] if x is not None])
        if len(v) == 0:
            assert all(r[c] is None for c in out.columns if c != "i")
            continue
        assert r["NEW__sum_f"] == pytest.approx(v.sum()) and r["NEW__mean_f"] == pytest.approx(v.mean())
        assert r["NEW__median_f"] == pytest.approx(np.median(v))
        assert (r["NEW__max_f"], r["NEW__min_f"]) == (v.max(), v.min())
        assert r["NEW__stddev_f"] == (None if len(v) == 1 else pytest.approx(v.std(ddof=1)))
        m2 = ((v - v.mean()) ** 2).sum()
        if m2 == 0:
            assert r["NEW__skewness_f"] is None and r["NEW__kurtosis_f"] is None
        else:
            assert r["NEW__skewness_f"] == pytest.approx(math.sqrt(len(v)) * ((v - v.mean()) ** 3).sum() / m2 ** 1.5)
            assert r["NEW__kurtosis_f"] == pytest.approx(len(v) * ((v - v.mean()) ** 4).sum() / m2 ** 2 - 3)


def test_selected_families_refuse_unknown_names(spark):
    with pytest.raises(ValueError):
        derive.derive_selected(spark.range(1), ["nothing"])


def test_selected_families_add_their_columns(spark):
    df = spark.createDataFrame([(1, *[float(i) for i in range(8)])], "id int, " + ", ".join(f"{c} double" for c in names.LIQUIDITY))
    out = derive.derive_selected(df, ["indice_liquidez"])
    assert len(out.columns) == 9 + 254
