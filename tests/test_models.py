"""Model-driven selection, training and the three jobs on small data with a known answer."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorekit import session
from scorekit.functions.feature_names import LIQUIDITY
from scorekit.operators import enrich, select, train
from scorekit.plans import build_abt as abt
from scorekit.plans import select_features as filters
from scorekit.plans import train_and_report as reporting
from scorekit.session import shared_path

TREES = {"maxIter": 4, "maxDepth": 3}
SIGNAL, NOISE = "signal", "noise"


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(2)
    n = 3000
    signal = rng.normal(size=n)
    pdf = pd.DataFrame({"k": np.arange(n), SIGNAL: signal, NOISE: rng.normal(size=n), "noise2": rng.normal(size=n)})
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(-3 * signal))).astype(int)
    pdf["month"] = [dt.date(2023, 1 + i % 6, 1) for i in range(n)]
    pdf["sample"] = np.where(pdf.month >= dt.date(2023, 6, 1), "oot", rng.choice(["train", "test", "val"], n, p=[0.6, 0.2, 0.2]))
    pdf["drifts"] = [m.month * 10.0 for m in pdf.month] + rng.random(n)
    return spark.createDataFrame(pdf).cache()


FEATURES = [SIGNAL, NOISE, "noise2"]


@pytest.mark.parametrize("kind,params", [("lgbm", TREES), ("forest", {"numTrees": 5, "maxDepth": 3}), ("logit", {})])
def test_classifiers_score_and_rank(df, kind, params):
    fitted = train.fit_classifier(df.where("sample = 'train'"), FEATURES, "y", kind, params)
    scored = fitted.score(df)
    assert scored.where("PROBA < 0 OR PROBA > 1 OR PRED NOT IN (0, 1)").count() == 0
    assert fitted.importance()[0][0] == SIGNAL
    metrics = train.sample_metrics(scored, "y")
    assert metrics["test"][0] > 0.85 and metrics["oot"][0] > 0.85


def test_unknown_kind():
    with pytest.raises(ValueError):
        train.make_classifier("svm", "y")


def test_search_board_and_winner(df):
    space = lambda rng: {"maxIter": rng.randint(2, 3), "maxDepth": 2}
    trials = train.random_search(df, FEATURES, "y", "lgbm", 2, space=space)
    again = train.random_search(df, FEATURES, "y", "lgbm", 2, space=space)
    assert [t.params for t in trials] == [t.params for t in again]
    board = train.leaderboard(df.sparkSession, trials)
    assert board.count() == 2 and board.first()["PARAMS"]["maxDepth"] == "2"
    best = train.best_trial(trials)
    assert best.penalised == max(t.penalised for t in trials)
    assert all(set(t.features) <= set(FEATURES) and t.features for t in trials)


def test_search_spaces_make_valid_estimators():
    for kind in train.KINDS:
        train.make_classifier(kind, "y", train.search_space(kind)(random.Random(1)))


def test_linear_importance(df):
    got = {r.feature: r.importance for r in train.linear_importance(df, {SIGNAL: 2.0, NOISE: -1.0}).collect()}
    pdf = df.toPandas()
    assert got[SIGNAL] == pytest.approx((2 * (pdf[SIGNAL] - pdf[SIGNAL].mean())).abs().mean())
    signed = {r.feature: r.importance for r in train.linear_importance(df, {NOISE: -1.0}, signed=True).collect()}
    assert signed[NOISE] == -1.0


def test_exchange_importance_finds_the_signal(df):
    fitted = train.fit_classifier(df.where("sample = 'train'"), FEATURES, "y", "logit")
    loss = {r.feature: r.importance for r in train.permutation_importance(df, fitted, ["k"]).collect()}
    assert loss[SIGNAL] > 0.2 and abs(loss[NOISE]) < 0.05


def test_exchange_importance_equals_scoring_each_exchange(df):
    fitted = train.fit_classifier(df.where("sample = 'train'"), FEATURES, "y", "logit", {"maxIter": 20})
    part = df.where("sample = 'test'").select("k", "y", *FEATURES)
    mixed = select.shuffled_copies(part, FEATURES, ["k"], 7).toPandas()
    spark = df.sparkSession

    def auc(frame):
        return train.auc_and_ks(fitted.score(spark.createDataFrame(frame)), "PROBA", "y").first()["auc"]

    whole = auc(mixed[["k", "y", *FEATURES]])
    got = {r.feature: r.importance for r in train.permutation_importance(part, fitted, ["k"]).collect()}
    for f in FEATURES[:2]:
        swapped = mixed[["k", "y", *FEATURES]].assign(**{f: mixed[f"shadow_{f}"]})
        assert got[f] == pytest.approx(whole - auc(swapped), abs=1e-12)


def test_shuffled_copies_keep_every_value(df):
    mixed = select.shuffled_copies(df.select("k", SIGNAL, NOISE), [SIGNAL, NOISE], ["k"], 3).toPandas()
    assert sorted(mixed[SIGNAL]) == sorted(mixed[f"shadow_{SIGNAL}"])
    assert abs(np.corrcoef(mixed[SIGNAL], mixed[f"shadow_{SIGNAL}"])[0, 1]) < 0.1


def test_drift_elimination_names_the_drifting_feature(df):
    older, recent = df.where("month < '2023-06-01'"), df.where("month >= '2023-06-01'")
    out = select.drift_elimination(older, recent, df.where("sample = 'test'"), [*FEATURES, "drifts"], "y", params=TREES)
    rows = out.orderBy("round").collect()
    assert rows[0]["feature"] == "drifts" and rows[0]["drift_auc"] > 0.95
    calm = select.drift_elimination(older, recent, df.where("sample = 'test'"), [SIGNAL], "y",
                                    params={"maxIter": 2, "maxDepth": 1}, max_auc=0.6)
    assert calm.count() == 0


def test_curve_forward_and_recursive(df):
    curve = select.progressive_curve(df, FEATURES, "y", params=TREES, step=2).collect()
    assert [r.N_features for r in curve] == [2, 3] and curve[0].test_auc > 0.85
    forward = {r.feature: r.kept for r in select.forward_selection(df, [SIGNAL, NOISE], "y", params=TREES).collect()}
    assert forward[SIGNAL]
    found = select.recursive_elimination(df.where("sample = 'train'"), FEATURES, "y", [1, 2], params=TREES)
    assert found["catboost_top1"] == [SIGNAL] and len(found["catboost_top2"]) == 2


def test_all_relevant_and_coordinator(df):
    part = df.where("sample = 'train'")
    verdict = {r.feature: r for r in select.all_relevant(part, FEATURES, "y", ["k"], rounds=7, params={"numTrees": 5, "maxDepth": 3}).collect()}
    assert verdict[SIGNAL].decision == "confirmed" and verdict[SIGNAL].hits == 7
    assert verdict[NOISE].decision != "confirmed"
    found = select.select_features(part, FEATURES, "y", ["k"], ("catboost", "mrmr"), (1,), (100,), (2,), model_params=TREES)
    assert found["catboost_top1"] == [SIGNAL] and found["mrmr_top2"][0] == SIGNAL
    twin = part.withColumn("twin", F.col(SIGNAL) * 2 + 1)
    pruned = select.prune_correlated(twin, {"m": [SIGNAL, "twin", NOISE]}, "y", 0.9)
    assert len(pruned["m"]) == 2 and NOISE in pruned["m"]


def test_filters_end_to_end(df):
    wide = df.withColumns({"empty": F.lit(None).cast("double"), "twin": F.col(SIGNAL) * 2,
                           "NEW__x": F.col(SIGNAL) + 1, "text": F.when(F.col("y") == 1, "a").otherwise("b")})
    part = wide.where("sample = 'train'").drop("sample", "k")
    static = filters.filter_static(part, "y", ["month"], drop_derived=True)
    reasons = {r.FEATURE_NAME: r.REASON_FOR_REMOVAL for r in static.report.collect()}
    assert reasons["NEW__x"] == filters.REASON_PREFIX and reasons["empty"] == "High Percentage of Null Values (threshold: above 90%)"
    assert "High Correlation (threshold: above 0.9)" in (reasons.get("signal"), reasons.get("twin"))
    assert "text" in static.features
    result = filters.select_by_filters(part.drop("NEW__x"), wide.where("sample = 'test'").drop("sample"), "y", "month",
                                       n_recent=2, params=TREES, max_rounds=1)
    assert set(result.features).isdisjoint({r.FEATURE_NAME for r in result.report.collect()})


def test_refinement_job(spark, df):
    wide = df.withColumn("text", F.when(F.col("y") == 1, "a").otherwise("b"))
    out = filters.refine_features(wide, [SIGNAL, NOISE, "text"], "y", ["k"], [(["old"], filters.REASON_IV)], 2, 2, step=2,
                                  methods=("catboost",), params=TREES, recursive_sizes=(1,), model_params=TREES)
    assert set(out.features) <= {SIGNAL, NOISE, "text"} and out.features
    assert out.curve.count() == 1 and out.history.count() == 2
    reasons = {r.FEATURE_NAME: r.REASON_FOR_REMOVAL for r in out.report.collect()}
    assert reasons["old"] == filters.REASON_IV and set(reasons) - {"old"} == {SIGNAL, NOISE, "text"} - set(out.features)
    assert {r.FEATURE_NAME: r.DROP_COL for r in out.status.collect()}["old"] == 1
    assert list(out.selections) == ["catboost_top1"]
    source, folder = shared_path(spark, "source"), shared_path(spark, "refined")
    wide.write.parquet(source)
    filters.write_refined(spark, {"train": source}, folder, out)
    slim = spark.read.parquet(f"{folder}/train").columns
    assert set(slim) == set(wide.columns) - set(reasons)
    assert filters.remaining_features(wide.columns, out.report, ["k"]) == [c for c in slim if c != "k"]
    # a feature that was never tried stays
    tried = {r.feature for r in out.history.collect()}
    assert len(tried) == 2 and {SIGNAL, NOISE, "text"} - tried <= set(out.features)


def test_loops_assemble_once(df, monkeypatch):
    calls = []
    real = train.assemble
    monkeypatch.setattr(train, "assemble", lambda *a, **k: calls.append(1) or real(*a, **k))
    train.random_search(df, FEATURES, "y", "lgbm", 2, space=lambda rng: dict(TREES))
    assert len(calls) == 1
    select.progressive_curve(df, FEATURES, "y", params=TREES)
    assert len(calls) == 2
    select.recursive_elimination(df, FEATURES, "y", [1], params=TREES)
    assert len(calls) == 3


def test_slices_give_the_same_fit(df):
    few = list(FEATURES)[::-1][:2]
    table = train.vector_table(df, FEATURES, ["k", "y"])
    one, two = (train.fit_classifier(t, few, "y", "logit", {"maxIter": 50}) for t in (table, df))
    assert dict(one.importance()) == pytest.approx(dict(two.importance()), rel=1e-6)
    a, b = ({r["k"]: r["PROBA"] for r in c.score(t).collect()} for c, t in ((one, table), (two, df)))
    assert a == pytest.approx(b, abs=1e-9)


def test_balanced_classes_change_the_fit(df):
    rare = df.where((F.col("y") == 0) | (F.col("k") % 9 == 0))
    plain, balanced = (train.fit_classifier(rare, FEATURES, "y", "logit", {"maxIter": 50, "class_weight": w}).score(rare)
                       .agg(F.avg("PROBA")).first()[0] for w in (None, "balanced"))
    share = rare.agg(F.avg("y")).first()[0]
    assert plain == pytest.approx(share, abs=0.02) and balanced > plain
    weights = train.class_weights(rare.select("y"), "y").groupBy("y").agg(F.sum(train.WEIGHT).alias("w")).collect()
    assert weights[0]["w"] == pytest.approx(weights[1]["w"])
    assert {train.search_space("logit")(random.Random(s))["class_weight"] for s in range(9)} == {None, "balanced"}
    with pytest.raises(ValueError):
        train.fit_classifier(rare, FEATURES, "y", "logit", {"class_weight": "heavy"})


def test_train_and_report(df):
    board, tables = reporting.train_and_report(
        df, FEATURES, "y", "month", kinds=("lgbm", "logit"), n_trials=1,
        spaces={"lgbm": lambda rng: dict(TREES)}, baseline_params={"lgbm": TREES})
    assert board.count() == 4
    by_sample = {r["sample"]: r for r in tables["metrics_by_sample"].collect()}
    assert set(by_sample) == {"train", "test", "val", "oot"} and by_sample["oot"]["auc"] > 85
    assert tables["ratings_test"].count() == 10
    # a better rating has a lower bad rate
    rates = [r.bad_rate for r in sorted(tables["ratings_test"].collect(), key=lambda r: int(r.rating[1:]))]
    assert rates[0] > rates[-1]
    assert tables["isotonic_val"].first()["auc"] > 0.85


def test_build_abt_job(spark):
    months = [dt.date(2023, m, 1) for m in range(1, 9)]
    rows = [(f"00{i}-", m.strftime("%Y%m"), ["good", "bad", "odd"][(i + m.month) % 3]) for i in range(1, 60) for m in months]
    base = spark.createDataFrame(rows + rows[:20], "doc string, ref string, label string")
    store = spark.createDataFrame([(i, m, *[float(i % 7), float(m.month), float(i + m.month), 1.0, 2.0, None, 0.0, 3.0])
                                   for i in range(1, 50) for m in months],
                                  "ent int, mes date, " + ", ".join(f"{c} double" for c in LIQUIDITY))
    spec = abt.BaseSpec("doc", "ref", "label", "yyyyMM", "good", "bad")
    source = enrich.FeatureSource("indice_liquidez", store, "ent", "mes", LIQUIDITY)
    out = abt.build_abt(base, spec, [source], ["indice_liquidez"], n_recent=2)
    assert out.count() == sum(1 for r in rows if r[2] != "odd")
    assert len([c for c in out.columns if c.startswith("NEW__")]) == 254
    row = out.where("doc = '001-' AND ref = '2023-05-01'").first() or out.where("doc = '002-' AND ref = '2023-05-01'").first()
    assert row["FLAG_COBERTURA_DADOS_indice_liquidez"] == 1 and row["cedente_indice_liquidez_2m"] == 4.0
    assert "radical_cnpj" not in out.columns and out.where("data_ref1 >= '2023-07-01' AND sample <> 'oot'").count() == 0
    path = shared_path(spark, "abt")
    abt.write_samples(out, path)
    assert set(r["sample"] for r in spark.read.parquet(path).select("sample").distinct().collect()) >= {"train", "oot"}
    keep = abt.build_abt(base, spec, [source], features=["cedente_indice_liquidez_1m"])
    assert keep.columns == ["doc", "ref", "data_ref1", "label", "sample", "cedente_indice_liquidez_1m"]


def test_rounds_of_the_shadow_test_run_side_by_side(df, monkeypatch):
    """Two rounds wait for each other before they fit."""
    import threading
    meet, real = threading.Barrier(2, timeout=60), select.fit_classifier
    monkeypatch.setattr(select, "fit_classifier", lambda *a: meet.wait() is not None and real(*a))
    verdict = select.all_relevant(df, FEATURES, "y", ["k"], rounds=2, params={"numTrees": 3, "maxDepth": 2})
    assert {r.feature: r.hits for r in verdict.collect()}[SIGNAL] == 2


def test_fits_of_large_tables_follow_their_rows(df, monkeypatch):
    """A task of a fit holds a bounded number of rows; small tables stay as they are."""
    assert train.spread_rows(df).rdd.getNumPartitions() == df.rdd.getNumPartitions()
    monkeypatch.setattr(train, "FIT_ROWS", 150)
    spread = train.spread_rows(df)
    assert spread.rdd.getNumPartitions() == 20 and spread.count() == 3000
    assert max(spread.rdd.glom().map(len).collect()) <= 160
    fitted = train.fit_classifier(df.where("sample = 'train'"), FEATURES, "y", "lgbm", TREES)
    assert fitted.importance()[0][0] == SIGNAL


def test_fits_count_the_rows_of_their_tasks(df, monkeypatch):
    """What a task holds decides, not how many tasks the session could have."""
    monkeypatch.setattr(train, "FIT_ROWS", 1000)
    spread = train.spread_rows(df.coalesce(1))
    assert spread.rdd.getNumPartitions() == 3 and max(spread.rdd.glom().map(len).collect()) <= 1010


def test_report_prepares_every_kind_once(df, monkeypatch):
    """The winner is fitted on the table that its trials were prepared with."""
    made, prepare = [], reporting.prepare
    monkeypatch.setattr(reporting, "prepare", lambda *a: made.append(a[-1]) or prepare(*a))
    monkeypatch.setattr(reporting, "evaluate", lambda scored, *more: {"scored": scored})
    space = lambda rng: {"maxIter": 2, "maxDepth": 2}
    _, tables = reporting.train_and_report(df, FEATURES, "y", "month", kinds=("lgbm", "logit"), n_trials=1,
                                           spaces={"lgbm": space, "logit": lambda rng: {"maxIter": 5}})
    assert made == ["lgbm", "logit"]
    assert set(tables["scored"].columns) == {*df.columns, "PROBA", "PRED"} and tables["scored"].count() == df.count()


def test_even_tables_follow_their_rows(df, monkeypatch):
    """Neither the session's partitions nor its cores bound what a task deals out, only the rows do."""
    monkeypatch.setattr(session, "EVEN_ROWS", 100)
    rows, fewest = df.count(), df.sparkSession.sparkContext.defaultParallelism
    table = train.vector_table(df, FEATURES, ["y", "sample"]).rows
    held = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(held) == rows and len(held) == math.ceil(rows / 100) > fewest and max(held) <= 110


@pytest.mark.parametrize("loop", ["search", "curve"])
def test_fits_of_a_loop_find_their_rows_in_the_same_places(df, monkeypatch, loop):
    """Where rows are dealt anew, tasks hold a bounded number of them, and which features a fit takes does not move them."""
    monkeypatch.setattr(train, "FIT_ROWS", 100)
    held, make = [], train.make_classifier

    class Recorder:
        def __init__(self, *args):
            self.estimator = make(*args)

        def fit(self, data):
            held.append(data.rdd.map(lambda r: (float(r[train.VECTOR][0]), r["y"])).glom().collect())
            return self.estimator.fit(data)

    monkeypatch.setattr(train, "make_classifier", Recorder)
    if loop == "curve":
        select.progressive_curve(df, FEATURES, "y", params=TREES)
    else:
        train.random_search(df, FEATURES, "y", "lgbm", 2, space=lambda rng: {"maxIter": rng.randint(2, 3), "maxDepth": 2})
    rows = df.where("sample = 'train'").count()
    assert len(held) > 2 and sum(map(len, held[0])) == rows and max(map(len, held[0])) <= 110
    assert all(h == held[0] for h in held[1:])


def test_dealt_rows_have_an_order_of_their_own(df, monkeypatch):
    """The order in which a task gets its rows does not reach the fit."""
    monkeypatch.setattr(train, "FIT_ROWS", 1000)
    dealt = train.spread_rows(df.select("k", SIGNAL).coalesce(1))
    marks = [[r[0] for r in part] for part in dealt.select(F.xxhash64("k", SIGNAL)).rdd.glom().collect()]
    assert len(marks) == 3 and all(m == sorted(m) for m in marks)


def test_spread_copies_equal_those_of_the_window(df, monkeypatch):
    """Large tables exchange values in batches, with the same copies whatever the batches cut: gaps, repeated and missing keys."""
    odd = df.select(F.when(F.col("k") % 50 != 0, F.col("k") % 2900).alias("k"), "y", SIGNAL,
                    F.when(F.col("k") % 7 != 0, F.col(NOISE)).alias(NOISE), F.lit(float("nan")).alias("noise2"))
    monkeypatch.setattr(select, "GROUP_ROWS", 300)
    monkeypatch.setattr(select, "FIT_ROWS", 500)
    monkeypatch.setattr(select, "PERIOD", 12)
    names = ["k", "y", *FEATURES, *[f"shadow_{f}" for f in FEATURES]]
    ordered = odd.withColumn("place", F.col(SIGNAL))  # rows of one key stand in an order of their own
    was = select.shuffled_copies(ordered, FEATURES, ["k", "place"], 5).withColumn("noise2", train.finite("noise2")).select(*names)
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        now = select.spread_copies(ordered, FEATURES, ["k", "place"], 5, ["k", "y"], odd.count()).select(*names)
        assert now.rdd.getNumPartitions() == 9
        assert sorted(map(repr, now.collect())) == sorted(map(repr, was.collect()))
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_shadow_rounds_of_large_tables_are_dealt_once(df, monkeypatch):
    """Rounds of a large table fit on the tasks that exchanged its values: nothing is stored, nor dealt again."""
    part = df.where("sample = 'train'")
    small = {r.feature: r.hits for r in select.all_relevant(part, FEATURES, "y", ["k"], rounds=3, params={"numTrees": 5, "maxDepth": 3}).collect()}
    monkeypatch.setattr(train, "FIT_ROWS", 300)
    monkeypatch.setattr(select, "FIT_ROWS", 300)
    monkeypatch.setattr(select, "GROUP_ROWS", 20)
    monkeypatch.setattr(select, "vector_table", None)
    held, real = [], train.spread_rows
    monkeypatch.setattr(train, "spread_rows", lambda rows: held.append((rows, real(rows))) or held[-1][1])
    large = {r.feature: r.hits for r in select.all_relevant(part, FEATURES, "y", ["k"], rounds=3, params={"numTrees": 5, "maxDepth": 3}).collect()}
    assert len(held) == 3 and all(a is b for a, b in held)
    assert large[SIGNAL] == small[SIGNAL] == 3


@pytest.mark.parametrize("loop", ["search", "curve", "forward", "recursive", "drift"])
def test_loops_deal_their_rows_once(df, monkeypatch, loop):
    """The fits of a loop read rows that were dealt before it, and leave nothing kept."""
    monkeypatch.setattr(train, "FIT_ROWS", 100)
    dealt, real = [], train.spread_rows
    monkeypatch.setattr(train, "spread_rows", lambda rows: dealt.append(1) or real(rows))
    kept = df.sparkSession.sparkContext._jsc.getPersistentRDDs
    before = set(kept())
    if loop == "search":
        train.random_search(df, FEATURES, "y", "lgbm", 2, space=lambda rng: {"maxIter": 2, "maxDepth": 2})
    elif loop == "curve":
        select.progressive_curve(df, FEATURES, "y", params=TREES)
    elif loop == "forward":
        select.forward_selection(df, FEATURES, "y", params=TREES)
    elif loop == "recursive":
        assert select.recursive_elimination(df, FEATURES, "y", [1], params=TREES)["catboost_top1"] == [SIGNAL]
    else:
        older, recent = df.where("month < '2023-06-01'"), df.where("month >= '2023-06-01'")
        select.drift_elimination(older, recent, df.where("sample = 'test'"), [*FEATURES, "drifts"], "y", params=TREES, max_rounds=2)
    assert len(dealt) == (2 if loop == "drift" else 1)
    assert set(kept()) == before
