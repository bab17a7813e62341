"""Sources, sinks, target, dates, identifiers, casts, duplicates, enrichment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorekit.functions import skew
from scorekit.functions.feature_names import AMOUNTS, BEHAVIOUR, CONCENTRATION, LIQUIDITY, RANKING, TREND
from scorekit.operators import clean, enrich, target
from scorekit.session import lookup_join, shared_path, small_table, stage
from scorekit.sources import feature_store, readers, writers


def values(df, column):
    return [r[column] for r in df.collect()]


def test_base_feature_counts():
    assert [len(x) for x in (BEHAVIOUR + AMOUNTS, CONCENTRATION, LIQUIDITY, RANKING, TREND)] == [42, 10, 8, 12, 40]
    assert BEHAVIOUR[0] == "count_m01" and RANKING[1] == "vl_pago_boletos_sum_2m_ranking"
    assert TREND[0] == "vl_recebido_cartao_credito_avg_1m_2m_trend"


def test_excel_is_rejected(spark):
    with pytest.raises(ValueError):
        readers.read_table(spark, "/x/base.xlsx")
    with pytest.raises(ValueError):
        readers.read_by_extension(spark, "/x/base.xls")


def test_unknown_extension_must_be_parquet(spark):
    path = shared_path(spark, "words") + ".dat"
    spark.createDataFrame([("a",)], "v string").write.text(path)
    with pytest.raises(ValueError):
        readers.read_by_extension(spark, path)


def test_text_fallback_keeps_strings(spark):
    path = shared_path(spark, "text")
    spark.createDataFrame([(1, "x;y")], "a int, b string").write.option("sep", "|").option("header", True).csv(path)
    assert [tuple(r) for r in readers.read_table(spark, path, "|").collect()] == [("1", "x;y")]


def test_labels_map_and_unmatched_rows(spark):
    df = spark.createDataFrame([("good",), ("bad",), ("other",), (None,)], "t string")
    assert sorted(values(target.normalise_target(df, "t", "good", "bad"), "t")) == [0, 1]
    kept = values(target.normalise_target(df, "t", "good", "bad", drop_unmatched=False), "t")
    assert sorted(kept, key=str) == [0, 1, None, None]


def test_target_without_labels(spark):
    text = spark.createDataFrame([("1",), ("0",), ("x",)], "t string")
    assert sorted(values(target.normalise_target(text, "t"), "t")) == [0, 1]
    real = spark.createDataFrame([(0.9,), (1.2,), (2.0,), (float("nan"),), (None,)], "t double")
    assert sorted(values(target.normalise_target(real, "t"), "t")) == [0, 1]
    exact = spark.sql("SELECT CAST(v AS DECIMAL(12,4)) AS t FROM VALUES (0.0), (1.5), (7.0) AS x(v)")
    assert sorted(values(target.normalise_target(exact, "t"), "t")) == [0, 1]


def test_coerced_target_counts_removed_rows(spark):
    df = spark.createDataFrame([(" a ",), ("b",), ("nan",), ("",), ("zzz",), (None,)], "t string")
    kept, removed = target.coerce_target(df, "t", "a", "b")
    assert sorted(values(kept, "t")) == [0, 1]
    assert removed.first()[0] == 4
    kept, removed = target.coerce_target(spark.createDataFrame([("1.0",), ("0",), ("y",), ("3",)], "t string"), "t")
    assert sorted(values(kept, "t")) == [0, 1] and removed.first()[0] == 2


@pytest.mark.parametrize("text,fmt,expected", [
    ("202304", "yyyyMM", dt.date(2023, 4, 1)), ("2023-04", "yyyy-MM", dt.date(2023, 4, 1)),
    ("20230415", "yyyyMMdd", dt.date(2023, 4, 15)), ("15/04/2023", "dd/MM/yyyy", dt.date(2023, 4, 15)),
    ("04/15/2023", "MM/dd/yyyy", dt.date(2023, 4, 15)), ("2023-04-15", "yyyy-MM-dd", dt.date(2023, 4, 15)),
    ("2023-04-15", "anything", dt.date(2023, 4, 15)), ("oops", "yyyyMM", None), ("99/99/2023", "dd/MM/yyyy", None),
    ("oops", "anything", None)])
def test_dates(spark, text, fmt, expected):
    df = spark.createDataFrame([(text, 1)], "d string, x int")
    out = clean.convert_date(df, "d", fmt)
    assert out.columns == ["x", "d"] and out.first()["d"] == expected


def test_identifiers(spark):
    df = spark.createDataFrame([("00.123-4/0001",), ("000",), (None,)], "id string")
    assert values(df.select(clean.clean_id("id").alias("id")), "id") == ["12340001", "", None]
    tagged = clean.tag_id(df, "id", "Radical").first()
    assert (tagged["num_digitos_cnpj"], tagged["tipo_cnpj"]) == (13, "radical")


def test_missing_values(spark):
    df = spark.createDataFrame([(float("inf"), "NaN"), (float("nan"), None), (2.0, "x")], "v double, t string")
    plain = clean.replace_missing(df).collect()
    assert [r["v"] for r in plain] == [None, None, 2.0] and [r["t"] for r in plain] == [None, None, "x"]
    filled = clean.replace_missing(df, clean.MISSING_NUMBER, "NA").collect()
    assert [r["v"] for r in filled] == [-99999.0, -99999.0, 2.0] and [r["t"] for r in filled] == ["NA", "NA", "x"]


def test_mean_and_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,), (float("inf"),)], "v double")
    assert values(clean.fill_mean(df, ["v"]), "v") == [1, 2, 9, 4, 4]
    assert values(clean.fill_median(df, ["v"]), "v") == [1, 2, 9, 2, 2]


def test_duplicates_are_split_exactly(spark):
    rows = [(1, None), (1, None), (2, 5.0)] + [(3, 7.0)] * 25_000
    kept, members = clean.split_duplicates(spark.createDataFrame(rows, "a int, b double"))
    assert sorted((r.a, r.b) for r in kept.collect()) == sorted([(1, None), (2, 5.0), (3, 7.0)], key=lambda t: t[0])
    got = {(r.a, r.b): r.n for r in members.groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, None): 2, (3, 7.0): 25_000}


def test_latest_row_survives(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "w"), ("b", None, "z")], "id string, d int, v string")
    out = clean.dedup_by_key(df, ["id"], ["d"])
    assert {r.id: r.v for r in out.collect()} == {"a": "y", "b": "z"}
    assert out.columns == df.columns


def _base_and_store(spark):
    month = dt.date(2023, 3, 1)
    base = spark.createDataFrame([("1", month, i) for i in range(500)] + [("2", month, 1), (None, month, 2), (None, month, 3)],
                                 "id string, data_ref1 date, n int")
    store = spark.createDataFrame([(1, dt.date(2023, 2, 1), 10.0), (1, month, 99.0), (3, dt.date(2023, 2, 1), 5.0)],
                                  "ent int, mes date, f double")
    return base, enrich.FeatureSource("s", store, "ent", "mes", ["f"])


def test_point_in_time_never_sees_its_own_month(spark):
    base, source = _base_and_store(spark)
    out = enrich.join_features(base, source, "id", "data_ref1")
    assert out.count() == base.count()
    assert {(r["id"], r["f"], r["FLAG_COBERTURA_DADOS_s"]) for r in out.collect()} == {("1", 10.0, 1), ("2", None, 0), (None, None, 0)}


def test_hot_keys_are_spread_without_changing_the_join(spark):
    base, source = _base_and_store(spark)
    hot = skew.hot_keys(base, ["id", "data_ref1"], 2)
    assert len(hot) == 2  # the frequent id and the missing id
    plain = enrich.join_features(base, source, "id", "data_ref1", {})
    spread = enrich.join_features(base, source, "id", "data_ref1", hot)
    assert "_salt" not in spread.columns
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0
    one, two = spark.range(300).selectExpr("'k' AS k", "id"), spark.createDataFrame([("k", 7)], "k string, v int")
    assert skew.spread_join(one, two, ["k"], "inner", {"k": 8}).count() == 300
    assert skew.spread_join(one, two.select("k"), ["k"], "left_semi", {"k": 8}).count() == 300


def test_lookup_that_is_too_long_is_not_broadcast(spark):
    big = spark.range(100).selectExpr("id % 50 AS k", "id")
    lookup = spark.range(50).selectExpr("id AS k", "id * 2 AS v")
    assert small_table(lookup, 10) is None
    assert lookup_join(big, lookup, ["k"], "inner", 10).count() == 100
    assert lookup_join(big, lookup, ["k"], "inner").count() == 100


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "y"), ("a", None), ("a", None), ("a", None), ("b", "q")], "k string, v string")
    assert {r.k: r.mode for r in enrich.most_frequent(df, ["k"], "v").collect()} == {"a": "y", "b": "q"}


def test_card_flags(spark):
    df = spark.createDataFrame([(1.0, 0.0, None)], "total_cartao_recebido_3M double, total_cartao_recebido_6M double, total_cartao_recebido_12M double")
    row = enrich.card_flags(df).first()
    assert (row.flag_cartao_3m, row.flag_cartao_6m, row.flag_cartao_12m) == (1, 0, 0)


def test_odd_spellings_of_months_are_refused(spark):
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    good = [("2024-01", 1), ("2024-02", 2), ("2024-03", 3), (None, 4)]
    store = spark.createDataFrame(good, "mes string, x int")
    assert {r["x"] for r in feature_store.feature_months(store, months, "mes", "yyyy-MM").collect()} == {1, 2}
    for odd in ("2024/01", "2024-1", "2024-02-01", "202402", "other"):
        mixed = spark.createDataFrame([*good, (odd, 5)], "mes string, x int").repartition(3)
        with pytest.raises(ValueError):
            feature_store.feature_months(mixed, months, "mes", "yyyy-MM")


def test_month_predicates_prune_partitions(spark):
    path = shared_path(spark, "store")
    rows = [(i, y, m) for i, (y, m) in enumerate([(2022, 12), (2023, 1), (2023, 2)])]
    spark.createDataFrame(rows, "e int, year int, month int").write.partitionBy("year", "month").parquet(path)
    months = feature_store.shift_months([dt.date(2023, 1, 1), dt.date(2023, 2, 1)], -1)
    assert months == [dt.date(2022, 12, 1), dt.date(2023, 1, 1)]
    df = feature_store.read_feature_months(spark, path, months)
    assert sorted(values(df, "e")) == [0, 1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.inputFiles() and len(spark.read.parquet(path).inputFiles()) >= 3
    with pytest.raises(ValueError):
        feature_store.month_predicate(["other"], months)
    assert feature_store.read_feature_months(spark, path, []).count() == 0


def test_text_month_formats(spark):
    path = shared_path(spark, "store")
    spark.createDataFrame([(1, "202301"), (2, "202302")], "e int, date_ref string").write.parquet(path)
    df = feature_store.read_feature_months(spark, path, [dt.date(2023, 2, 1)], "date_ref", "yyyyMM")
    assert [(r.e, r.date_ref) for r in df.collect()] == [(2, dt.date(2023, 2, 1))]


def test_sinks_round_trip(spark):
    df = spark.createDataFrame([("f1", "why; because"), ("f2", "x")], "FEATURE_NAME string, REASON_FOR_REMOVAL string")
    path = shared_path(spark, "report")
    writers.save_report(df, path)
    assert sorted(map(tuple, writers.read_report(spark, path).collect())) == sorted(map(tuple, df.collect()))
    chosen = {"top2": ["b", "a"], "top1": ["b"]}
    writers.save_feature_list(spark, chosen, path + "-l")
    assert writers.read_feature_list(spark, path + "-l") == chosen
    staged = stage(df)
    assert staged.columns == df.columns and staged.count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_enrichment_reads_only_the_months_it_needs(spark):
    path = shared_path(spark, "monthly")
    rows = [(i, dt.date(2022, m, 1), float(m)) for i in range(3) for m in range(1, 13)]
    spark.createDataFrame(rows, "ent int, mes date, f double").write.partitionBy("mes").parquet(path)
    base = spark.createDataFrame([("1", dt.date(2022, 6, 1)), ("2", dt.date(2022, 7, 1)), ("9", dt.date(2022, 7, 1))],
                                 "id string, data_ref1 date")
    source = enrich.FeatureSource("s", spark.read.parquet(path), "ent", "mes", ["f"])
    out = enrich.enrich(base, [source], "id", "data_ref1")
    assert {(r["id"], r["f"]) for r in out.collect()} == {("1", 5.0), ("2", 6.0), ("9", None)}
    cut = enrich.within_months(source, [dt.date(2022, 6, 1), dt.date(2022, 7, 1)]).table
    assert len(cut.select("mes").distinct().collect()) == 2
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "mes" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_keyless_stratified_read(spark):
    path = shared_path(spark, "copies") + ".parquet"
    spark.range(1000).selectExpr("id % 2 AS y", "1 AS same").write.parquet(path)
    out = readers.read_by_extension(spark, path, target="y", keep_fraction=0.25)
    assert out.columns == ["y", "same"]
    assert sorted((r.y, r["count"]) for r in out.groupBy("y").count().collect()) == [(0, 125), (1, 125)]
    assert 0 < readers.read_sampled(spark, path, 0.5).count() < 1000


def test_stored_sources_are_pruned_whatever_their_month_looks_like(spark):
    rows = [(i, dt.date(2022, m, 1), float(m)) for i in range(3) for m in range(1, 13)]
    store = spark.createDataFrame(rows, "ent int, mes date, f double")
    base = spark.createDataFrame([("1", dt.date(2022, 6, 1)), ("2", dt.date(2022, 7, 1)), ("9", dt.date(2022, 7, 1))],
                                 "id string, data_ref1 date")
    layouts = {"pair": (store.selectExpr("ent", "f", "year(mes) AS year", "month(mes) AS month"), ["year", "month"], None),
               "yyyyMM": (store.selectExpr("ent", "f", "date_format(mes, 'yyyyMM') AS mes"), ["mes"], "yyyyMM"),
               "date": (store, ["mes"], None)}
    for name, (table, columns, spelled) in layouts.items():
        path = shared_path(spark, name)
        table.write.partitionBy(*columns).parquet(path)
        source = enrich.FeatureSource("s", path, "ent", "mes", ["f"], month_format=spelled)
        out = enrich.enrich(base, [source], "id", "data_ref1")
        assert {(r["id"], r["f"]) for r in out.collect()} == {("1", 5.0), ("2", 6.0), ("9", None)}, name
        cut = enrich.within_months(source, [dt.date(2022, 6, 1), dt.date(2022, 7, 1)]).table
        assert {r["mes"] for r in cut.collect()} == {dt.date(2022, 5, 1), dt.date(2022, 6, 1)}
        filters = cut._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert columns[0] in filters
    wrong = enrich.FeatureSource("s", store.selectExpr("ent", "f", "date_format(mes, 'yyyyMM') AS mes"), "ent", "mes", ["f"])
    with pytest.raises(ValueError, match="not spelled"):
        enrich.enrich(base, [wrong], "id", "data_ref1")


def test_damaged_parquet_is_not_read_as_text(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/good")
    data = next(tmp_path.glob("good/part-*.parquet")).read_bytes()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(data[:-20] + b"\x00" * 16 + b"PAR1")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_table(spark, f"{tmp_path}/bad").count()
    (tmp_path / "t.csv").write_text("a;b\n1;2\n")
    assert readers.read_table(spark, f"{tmp_path}/t.csv", ";").columns == ["a", "b"]
