"""Sampling and splits."""

import hashlib
import math

from pyspark.sql import functions as F

from scorekit.operators import sample


def md5_32(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def test_row_sample_is_reproducible(spark):
    df = spark.range(5000)
    one = {r.id for r in sample.sample_rows(df, 0.2, 7, ["id"]).collect()}
    two = {r.id for r in sample.sample_rows(df.repartition(9), 0.2, 7, ["id"]).collect()}
    assert one == two == {i for i in range(5000) if md5_32(7, i) < int(0.2 * 2 ** 32)}
    assert one != {r.id for r in sample.sample_rows(df, 0.2, 8, ["id"]).collect()}


def test_stratified_sample_takes_the_smallest_hashes(spark):
    """One stratum holds most rows, one holds a single row, one has a missing target."""
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id = 0 THEN 7 WHEN id < 200 THEN 1 WHEN id < 210 THEN NULL ELSE 0 END AS y")
    strata = {}
    for r in df.collect():
        strata.setdefault(r.y, []).append(r.id)
    for fraction in (0.0, 0.3, 0.55, 1.0):
        got = {r.id for r in sample.stratified_sample(df, "y", ["id"], fraction, 10).collect()}
        expected = set()
        for ids in strata.values():
            expected |= set(sorted(ids, key=lambda i: md5_32(10, i))[:math.floor(len(ids) * fraction)])
        assert got == expected, fraction


def test_sampling_by_month_and_target_honours_the_seed(spark):
    df = spark.range(600).selectExpr("id", "id % 3 AS m", "id % 2 AS y")
    a = {r.id for r in sample.sample_by_month_and_target(df, "m", "y", ["id"], 0.4, 1).collect()}
    b = {r.id for r in sample.sample_by_month_and_target(df, "m", "y", ["id"], 0.4, 2).collect()}
    assert len(a) == len(b) == 240 and a != b
    counts = df.where(F.col("id").isin(list(a))).groupBy("m", "y").count().collect()
    assert all(r["count"] == 40 for r in counts)


def test_random_rank(spark):
    df = spark.range(900).selectExpr("id", "id % 2 AS s")
    rows = sample.random_rank(df, ["s"], ["id"], 3).collect()
    for s in (0, 1):
        order = sorted((i for i in range(900) if i % 2 == s), key=lambda i: md5_32(3, i))
        assert {r.id: r.row_num for r in rows if r.s == s} == {i: n for n, i in enumerate(order, 1)}


def test_split_is_entity_disjoint_and_in_time(spark):
    df = spark.range(20_000).selectExpr("cast(id % 2000 as string) AS id", "add_months(date'2022-01-01', cast(id % 12 as int)) AS m")
    parts = sample.split_samples(df, "id", "m", n_recent=3)
    sizes = {k: v.count() for k, v in parts.items()}
    assert sum(sizes.values()) == 20_000
    latest_before = max(parts[k].agg(F.max("m")).first()[0] for k in ("train", "test", "val"))
    assert latest_before < parts["oot"].agg(F.min("m")).first()[0]
    ids = {k: {r.id for r in parts[k].select("id").distinct().collect()} for k in ("train", "test", "val")}
    assert not ids["train"] & ids["test"] and not ids["train"] & ids["val"] and not ids["test"] & ids["val"]
    rest = sizes["train"] + sizes["test"] + sizes["val"]
    assert abs(sizes["train"] / rest - 0.70) < 0.04 and abs(sizes["val"] / rest - 0.15) < 0.04


def test_split_needs_no_shuffle_of_the_facts(spark):
    df = spark.range(10).selectExpr("id", "date'2022-01-01' AS m")
    plan = sample.assign_sample(df, "id", "m")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main


def test_recency_split_and_union(spark):
    df = spark.range(12).selectExpr("id", "add_months(date'2022-01-01', cast(id as int)) AS m") \
        .unionByName(spark.range(1).selectExpr("id", "cast(null as date) AS m"))
    older, recent = sample.split_by_recency(df, "m", 2)
    assert (older.count(), recent.count()) == (11, 2)
    both = sample.label_and_union(older, recent)
    assert both.agg(F.sum("target_drift")).first()[0] == 2


def test_group_counts(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert {r.id: r.n_group for r in sample.with_group_count(df, ["k"]).collect()}[0] == 4
