"""Sources, sinks, projections, filters, casts, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (BASE, FEATURES, SCORED, STORE, STORE2, STORE_FEATURES, ROW_KEY, Query,
                            behaviour_rows, behaviour_sql, feature_frame, load, md5_32, monthly_store,
                            orders_base, r, rounded, rs, scored, second_store, stored, with_)
from scorekit.functions.feature_names import AMOUNTS, BEHAVIOUR_MONTHS
from scorekit.operators import clean, enrich, reports, sample, target
from scorekit.operators.metrics import feature_auc
from scorekit.session import shared_path, stage
from scorekit.sources import feature_store, readers, writers

# scans and sinks ---------------------------------------------------------------------------------

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customer_text(spark, sf, sep):
    path = shared_path(spark, "customer-text")
    load(spark, sf, "customer").write.option("sep", sep).option("header", True).csv(path)
    return path


def _typed_customer(df):
    return df.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                     F.col("c_nationkey").cast("int").alias("c_nationkey"),
                     F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


def read_fallback_parquet(spark, sf):
    return readers.read_table(spark, f"{sf}/customer.parquet")


def read_fallback_text(spark, sf):
    return _typed_customer(readers.read_table(spark, _customer_text(spark, sf, "|"), "|"))


def read_sampled(spark, sf):
    return readers.read_sampled(spark, f"{sf}/lineitem.parquet", 0.25, 42,
                                [*ROW_KEY, "l_quantity"], ROW_KEY)


def read_by_extension(spark, sf):
    path = shared_path(spark, "customer") + ".csv"
    load(spark, sf, "customer").write.option("sep", "\t").option("header", True).csv(path)
    return _typed_customer(readers.read_by_extension(spark, path))


def read_with_volume(spark, sf):
    df, n_columns, n_rows = readers.read_with_volume(spark, f"{sf}/orders.parquet")
    return df.agg(F.count("*").alias("counted"), F.lit(n_columns).alias("n_columns"),
                  F.lit(n_rows).cast("bigint").alias("n_rows"))


def _store_on_disk(spark, sf, by):
    path = shared_path(spark, "store")
    store = monthly_store(spark, sf)
    if by == "year_month":
        store = store.withColumns({"year": F.year("mes"), "month": F.month("mes")})
        writers.save_dataset(store, path, partition_by=["year", "month"])
    else:
        writers.save_dataset(store.withColumn("mes", F.date_format("mes", "yyyy-MM-dd")), path,
                             partition_by=["mes"])
    return path


def _wanted_months(spark, sf):
    months = feature_store.collect_months(sample.recent_months(orders_base(spark, sf), "data_ref1", 6),
                                          "data_ref1")
    return feature_store.shift_months(months, -1)


def feature_months_year_month(spark, sf):
    path, months = _store_on_disk(spark, sf, "year_month"), _wanted_months(spark, sf)
    df = feature_store.read_feature_months(spark, path, months)
    return df.select("entity", "mes", *STORE_FEATURES)


def feature_months_text(spark, sf):
    path, months = _store_on_disk(spark, sf, "mes"), _wanted_months(spark, sf)
    df = feature_store.read_feature_months(spark, path, months, "mes", "yyyy-MM-dd")
    return df.select("entity", "mes", *STORE_FEATURES)


FEATURE_MONTHS_SQL = with_(BASE, STORE, """wanted AS (
  SELECT CAST(m - INTERVAL 1 MONTH AS DATE) AS m
  FROM (SELECT DISTINCT data_ref1 AS m FROM base ORDER BY m DESC LIMIT 6))""") + \
    "SELECT entity, mes, n_items, sum_qty, avg_discount, card_amount FROM store WHERE mes IN (SELECT m FROM wanted)"


def save_overwrite(spark, sf):
    path = shared_path(spark, "saved")
    store = monthly_store(spark, sf)
    writers.save_dataset(store, path, partitions=10)
    writers.save_dataset(store, path, partitions=10)
    return spark.read.parquet(path).select("entity", "mes", *STORE_FEATURES)


def stage_resume(spark, sf):
    staged = stage(second_store(spark, sf), "stage-one")
    return staged.groupBy("mes").agg(F.count("*").alias("n"), F.sum("n_orders").alias("n_orders"))


def report_round_trip(spark, sf):
    path = shared_path(spark, "report")
    writers.save_report(load(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), path)
    back = writers.read_report(spark, path)
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand")


def rewrite_without(spark, sf):
    return writers.rewrite_without(spark, f"{sf}/customer.parquet", shared_path(spark, "slim"),
                                   ["c_name", "c_nationkey", "not_there"])


def feature_list_table(spark, sf):
    """Brands by frequency, per size, persisted as a selection table and read back."""
    quality = feature_auc(stored(feature_frame(spark, sf), "l_quantity", "l_extendedprice", "l_tax", "target"),
                          ["l_quantity", "l_extendedprice", "l_tax"], "target")
    ranked = [x["feature"] for x in quality.orderBy(F.desc("auc"), "feature").collect()]
    path = shared_path(spark, "selection")
    writers.save_feature_list(spark, {"auc_top3": ranked, "auc_top1": ranked[:1]}, path)
    back = writers.read_feature_list(spark, path)
    return writers.feature_list(spark, back)


def auc_sql(features, source="feats", target_col="target"):
    """Rank-sum AUC per feature, missing filled with the mean, either direction."""
    parts = []
    for f in features:
        parts.append(f"""SELECT '{f}' AS feature, (SELECT
  (sum(CASE WHEN y = 1 THEN rk END) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
  / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0))
  FROM (SELECT y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
        FROM (SELECT {target_col} AS y, coalesce({f}, (SELECT avg({f}) FROM {source})) AS v FROM {source}))) AS a""")
    return "aucs AS (SELECT feature, greatest(a, 1 - a) AS auc FROM (\n" + "\nUNION ALL ".join(parts) + "))"


# projections and filters -------------------------------------------------------------------------

def target_labels(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("tg"))
    kept = target.normalise_target(df, "tg", "O", "F", drop_unmatched=False)
    dropped = target.normalise_target(df, "tg", "O", "F")
    return kept.groupBy("tg").agg(F.count("*").alias("n")).withColumn("variant", F.lit("keep")).unionByName(
        dropped.groupBy("tg").agg(F.count("*").alias("n")).withColumn("variant", F.lit("drop")))


def target_typed(spark, sf):
    """Text digits, integers and truncated doubles through the same normaliser."""
    items = load(spark, sf, "lineitem").select("l_linenumber", "l_discount", "l_quantity")
    as_text = items.select(F.col("l_linenumber").cast("string").alias("tg"))
    as_int = items.select((F.col("l_linenumber") - 1).alias("tg"))
    as_double = items.select((F.col("l_quantity") / 10).alias("tg"))
    parts = []
    for kind, df in (("text", as_text), ("int", as_int), ("double", as_double)):
        parts.append(target.normalise_target(df, "tg").groupBy("tg").agg(F.count("*").alias("n"))
                     .withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def target_coerced(spark, sf):
    orders = load(spark, sf, "orders")
    text = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit("nan"))
                         .otherwise(F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" "))).alias("tg"))
    kept, removed = target.coerce_target(text, "tg", "O", "F")
    counts = kept.groupBy("tg").agg(F.count("*").alias("n"))
    return counts.unionByName(removed.select(F.lit(None).cast("int").alias("tg"),
                                             F.col("n_rows_removed").alias("n")))


def target_selected(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '1.0' WHEN 2 THEN 'x' WHEN 3 THEN '2' ELSE ' 1 ' END")
        .alias("tg"))
    return target.select_binary(df, "tg").groupBy("tg").agg(F.count("*").alias("n"))


def month_set_predicate(spark, sf):
    months = _wanted_months(spark, sf)
    store = monthly_store(spark, sf).withColumns({
        "partition_0": F.year("mes").cast("string"), "partition_1": F.month("mes").cast("string")})
    by_parts = store.where(feature_store.month_predicate(store.columns, months))
    by_mes = store.where(feature_store.month_predicate(["mes"], months))
    count = [F.count("*").alias("n"), F.sum("n_items").alias("n_items")]
    return (by_parts.groupBy("mes").agg(*count).withColumn("via", F.lit("parts"))
            .unionByName(by_mes.groupBy("mes").agg(*count).withColumn("via", F.lit("mes"))))


def cast_selected(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return clean.cast_columns(df, ["o_totalprice"]).select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def cast_patterns(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_quantity", F.lit("1").alias("target"))
    return clean.cast_by_pattern(df, ["supp", "part"], "target", ["l_orderkey", "l_linenumber"])


def output_selection(spark, sf):
    df = clean.tag_id(orders_base(spark, sf), "id", "RADICAL").withColumn("radical_cnpj", F.col("id"))
    slim = clean.output_columns(df)
    return clean.output_columns(slim, ["o_totalprice"], ["id", "o_orderkey", "data_ref1", "target"])


def drop_derived(spark, sf):
    df = load(spark, sf, "part").withColumns({"NEW__a": F.col("p_size") + 1, "NEW__b": F.lit(1)})
    slim, names = clean.drop_prefixed(df)
    return slim.select("*", F.lit(len(names)).alias("n_removed"))


def align_to_train(spark, sf):
    train = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return clean.align_columns(load(spark, sf, "customer"), train)


def replace_missing(spark, sf):
    df = load(spark, sf, "lineitem").select(
        *ROW_KEY, F.when(F.col("l_linenumber") == 1, float("inf")).when(F.col("l_linenumber") == 2, float("nan"))
        .otherwise(F.col("l_quantity")).alias("v"),
        F.when(F.col("l_linenumber") == 3, "NaN").otherwise(F.col("l_returnflag")).alias("t"))
    return clean.replace_missing(df, clean.MISSING_NUMBER, "NA", ROW_KEY)


def mean_imputed(spark, sf):
    df = clean.fill_mean(feature_frame(spark, sf).select(*ROW_KEY, "line_gap"), ["line_gap"])
    return df.select(*ROW_KEY, r("line_gap").alias("line_gap"))


def median_imputed(spark, sf):
    df = clean.fill_median(feature_frame(spark, sf).select(*ROW_KEY, "line_gap", "mostly_null"),
                           ["line_gap", "mostly_null"])
    return rounded(df, "line_gap", "mostly_null")


# joins -------------------------------------------------------------------------------------------

def _store_source(spark, sf, lag=1, name="store"):
    return enrich.FeatureSource(name, monthly_store(spark, sf), "entity", "mes", STORE_FEATURES, lag)


def point_in_time(spark, sf):
    return enrich.join_features(orders_base(spark, sf), _store_source(spark, sf), "id", "data_ref1")


def same_month(spark, sf):
    return enrich.join_features(orders_base(spark, sf), _store_source(spark, sf, 0), "id", "data_ref1")


PIT = """SELECT b.id, b.o_orderkey, b.o_orderdate, b.data_ref1, b.target, b.o_totalprice,
  s.n_items, s.sum_qty, s.avg_discount, s.card_amount,
  CASE WHEN s.entity IS NULL THEN 0 ELSE 1 END AS "FLAG_COBERTURA_DADOS_store"
FROM base b LEFT JOIN store s ON b.id = CAST(s.entity AS VARCHAR) AND b.data_ref1 = {month}"""
LAGGED = "CAST(s.mes + INTERVAL 1 MONTH AS DATE)"


def multi_source(spark, sf):
    second = enrich.FeatureSource("orders", second_store(spark, sf), "entity", "mes",
                                  ["n_orders", "max_order"], 2)
    return enrich.enrich(orders_base(spark, sf), [_store_source(spark, sf), second], "id", "data_ref1")


def stored_source(layout):
    """The multi-source join with the first source on disk, its months spelled as ``layout`` says."""
    def run(spark, sf):
        path = shared_path(spark, "store")
        store = monthly_store(spark, sf)
        if layout == "yyyyMM":
            store = store.withColumn("mes", F.date_format("mes", layout))
            writers.save_dataset(store, path, partition_by=["mes"])
        else:
            store = store.withColumns({"year": F.year("mes"), "month": F.month("mes")}).drop("mes")
            writers.save_dataset(store, path, partition_by=["year", "month"])
        first = enrich.FeatureSource("store", path, "entity", "mes", STORE_FEATURES,
                                     month_format=layout if layout == "yyyyMM" else None)
        second = enrich.FeatureSource("orders", second_store(spark, sf), "entity", "mes", ["n_orders", "max_order"], 2)
        return enrich.enrich(orders_base(spark, sf), [first, second], "id", "data_ref1")
    return run


def coverage(spark, sf):
    joined = enrich.join_features(orders_base(spark, sf), _store_source(spark, sf), "id", "data_ref1")
    return joined.groupBy("data_ref1", "FLAG_COBERTURA_DADOS_store").agg(F.count("*").alias("n"))


def threshold_flags(spark, sf):
    joined = enrich.join_features(orders_base(spark, sf), _store_source(spark, sf), "id", "data_ref1")
    flagged = enrich.positive_flags(joined, {"flag_card": "card_amount"})
    return flagged.select("id", "o_orderkey", "flag_card")


def entity_membership(spark, sf):
    base = orders_base(spark, sf)
    ids = base.select("id").distinct().where(sample.entity_bucket("id") < 70)
    return sample.rows_of_entities(base, ids, "id")


def group_counts(spark, sf):
    base = orders_base(spark, sf).withColumn("stratum", clean.stratum_key("data_ref1", "target"))
    return sample.with_group_count(base, ["stratum"]).select("o_orderkey", "stratum", "n_group")


STATUS_FEATURES = ["l_quantity", "l_extendedprice", "l_tax", "net_price"]


def removal_status(spark, sf):
    quality = feature_auc(stored(feature_frame(spark, sf), *STATUS_FEATURES, "target"), STATUS_FEATURES, "target")
    report = quality.where(F.col("auc") < 0.55).select(F.col("feature").alias("FEATURE_NAME"),
                                                      F.lit("weak").alias("REASON_FOR_REMOVAL"))
    return reports.feature_status(spark, [*STATUS_FEATURES, "id"], report, ["id"])


def removal_counts(spark, sf):
    return reports.status_counts(removal_status(spark, sf))


STATUS_SQL = with_(FEATURES, auc_sql(STATUS_FEATURES), """status AS (
  SELECT feature AS "FEATURE_NAME", CASE WHEN auc < 0.55 THEN 'weak' END AS "REASON_FOR_REMOVAL",
         CASE WHEN auc < 0.55 THEN 1 ELSE 0 END AS "DROP_COL" FROM aucs)""")


def registry(spark, sf):
    events = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("cd_cnpj"), F.col("o_orderdate").cast("date").alias("dt_situ"),
        F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("cd_cep_logr"))
    base = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return enrich.join_registry(base, events, "id", "cd_cnpj", "dt_situ", "cd_cep_logr", ["cd_cep_logr"])


def id_cleaning(spark, sf):
    raw = F.concat(F.lit("00"), F.col("o_custkey"), F.lit("-"), F.col("o_orderkey") % 10)
    df = load(spark, sf, "orders").select("o_orderkey", raw.alias("raw_id"))
    return df.select("o_orderkey", clean.clean_id("raw_id").alias("clean_id"))


def id_tags(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", "c_name")
    return clean.tag_id(df, "c_name", "Completo").drop("c_name")


# Accepted date formats with their spelling in the other engine.
DATE_FORMATS = {"yyyyMM": "%Y%m", "yyyy-MM": "%Y-%m", "yyyyMMdd": "%Y%m%d", "dd/MM/yyyy": "%d/%m/%Y",
                "MM/dd/yyyy": "%m/%d/%Y", "yyyy-MM-dd": "%Y-%m-%d"}


def date_formats(spark, sf):
    """Every accepted format, with unparsable text every 11th row."""
    orders = load(spark, sf, "orders")
    out = orders.select("o_orderkey", *[
        clean.parse_date(F.when(F.col("o_orderkey") % 11 == 0, F.lit("20x5/99/99"))
                         .otherwise(F.date_format("o_orderdate", f)), f).alias(f"d{i}")
        for i, f in enumerate(DATE_FORMATS)])
    return out


DATE_SQL = "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderkey % 11 <> 0 THEN CAST({'date_trunc(' + chr(39) + 'month' + chr(39) + ', o_orderdate)' if i < 2 else 'o_orderdate'} AS DATE) END AS d{i}"
    for i in range(len(DATE_FORMATS))) + " FROM orders"


def month_columns(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("dt"))
    return clean.add_month(df, "dt", "yyyyMMdd").withColumn("previous", clean.shift_month("data_ref1", -1))


def stratum_keys(spark, sf):
    return orders_base(spark, sf).select("o_orderkey", clean.stratum_key("data_ref1", "target").alias("stratum"))


def postcodes(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cep"))
    return clean.postcode_prefixes(df, "cep")


def _rollup(spark, sf):
    return enrich.rollup_behaviour(behaviour_rows(spark, sf), "root", "date_ref")


ROLLUP_FLOATS = [f"{stem}_{m}" for m in BEHAVIOUR_MONTHS
                 for stem in ("atraso_medio", "count_good", "perc_vl_pg", "perc_good")]


def behaviour_rollup(spark, sf):
    return rounded(_rollup(spark, sf), *ROLLUP_FLOATS)


def _rollup_sql():
    cols = []
    for m in BEHAVIOUR_MONTHS:
        good = f"sum(count_{m} * perc_good_{m})"
        cols += [f"{rs(f'avg(atraso_medio_{m})')} AS atraso_medio_{m}", f"{rs(good)} AS count_good_{m}",
                 f"CAST(sum(count_{m}) AS BIGINT) AS count_{m}", f"sum(vl_total_{m}) AS vl_total_{m}",
                 f"sum(vl_pg_em_dia_{m}) AS vl_pg_em_dia_{m}",
                 f"{rs(f'sum(vl_pg_em_dia_{m}) / nullif(sum(vl_total_{m}), 0)')} AS perc_vl_pg_{m}",
                 f"{rs(f'{good} / nullif(sum(count_{m}), 0)')} AS perc_good_{m}",
                 f"min(atraso_minimo_{m}) AS atraso_minimo_{m}"]
    cols += [f'sum("{a}") AS "{a}"' for a in AMOUNTS]
    return with_(behaviour_sql()) + "SELECT root, date_ref,\n" + ",\n".join(cols) + \
        "\nFROM behaviour GROUP BY root, date_ref"


def behaviour_passthrough(spark, sf):
    rows = behaviour_rows(spark, sf)
    return enrich.passthrough(rows, "full", "date_ref", ["root", "count_m01", "vl_total_m01", *AMOUNTS],
                              "cnpj", "data_ref1")


def most_frequent(spark, sf):
    return enrich.most_frequent(load(spark, sf, "lineitem"), ["l_suppkey"], "l_shipdate", "mode") \
        .withColumn("mode", F.col("mode").cast("date"))


def flagship(spark, sf):
    """Customer base, target, cohort month, lagged features, coverage and sample in one plan."""
    base = orders_base(spark, sf).where(F.col("target") < 2)
    joined = enrich.join_features(base, _store_source(spark, sf), "id", "data_ref1")
    return sample.assign_sample(joined, "id", "data_ref1")


FLAGSHIP_SQL = with_(BASE.replace("FROM orders)", "FROM orders WHERE o_orderstatus IN ('O', 'F'))"), STORE, "pit AS (" + PIT.format(month=LAGGED) + ")",
                     "cutoff AS (SELECT min(m) AS m FROM (SELECT DISTINCT data_ref1 AS m FROM base ORDER BY m DESC LIMIT 3))") + f"""
SELECT pit.*, CASE WHEN data_ref1 >= (SELECT m FROM cutoff) THEN 'oot'
  WHEN {md5_32("'42'", 'id')} % 100 < 70 THEN 'train'
  WHEN {md5_32("'42'", 'id')} % 100 < 85 THEN 'test' ELSE 'val' END AS sample
FROM pit"""

MULTI_SQL = with_(BASE, STORE, STORE2, "pit AS (" + PIT.format(month=LAGGED) + ")") + """
SELECT p.*, t.n_orders, t.max_order, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS "FLAG_COBERTURA_DADOS_orders"
FROM pit p LEFT JOIN store2 t ON p.id = CAST(t.entity AS VARCHAR) AND p.data_ref1 = CAST(t.mes + INTERVAL 2 MONTH AS DATE)"""

QUERIES = [
    Query("abt_minimum_slice", flagship, FLAGSHIP_SQL),
    Query("io1_read_fallback_parquet", read_fallback_parquet, CUSTOMER_SQL),
    Query("io1_read_fallback_text", read_fallback_text, CUSTOMER_SQL),
    Query("io2_read_sampled_pruned", read_sampled,
          f"SELECT {', '.join(ROW_KEY)}, l_quantity FROM lineitem WHERE "
          f"{md5_32(chr(39) + '42' + chr(39), *[f'CAST({c} AS VARCHAR)' for c in ROW_KEY])} < {int(0.25 * 2 ** 32)}"),
    Query("io3_read_by_extension", read_by_extension, CUSTOMER_SQL),
    Query("io4_read_with_volume", read_with_volume,
          "SELECT CAST(count(*) AS BIGINT) AS counted, 6 AS n_columns, CAST(count(*) AS BIGINT) AS n_rows FROM orders"),
    Query("io5_feature_months_partitioned", feature_months_year_month, FEATURE_MONTHS_SQL),
    Query("io5_feature_months_text_key", feature_months_text, FEATURE_MONTHS_SQL),
    Query("io6_save_overwrite", save_overwrite,
          with_(STORE) + "SELECT entity, mes, n_items, sum_qty, avg_discount, card_amount FROM store"),
    Query("io7_stage_resume", stage_resume,
          with_(STORE2) + "SELECT mes, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_orders) AS BIGINT) AS n_orders FROM store2 GROUP BY mes"),
    Query("io8_report_round_trip", report_round_trip, "SELECT p_partkey, p_name, p_brand FROM part"),
    Query("io9_rewrite_without_features", rewrite_without,
          "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer"),
    Query("io10_feature_list", feature_list_table,
          with_(FEATURES, auc_sql(["l_quantity", "l_extendedprice", "l_tax"]),
                "ranked AS (SELECT feature, CAST(row_number() OVER (ORDER BY auc DESC, feature) AS INTEGER) AS rank FROM aucs)") +
          "SELECT 'auc_top3' AS method, rank, feature FROM ranked UNION ALL "
          "SELECT 'auc_top1' AS method, rank, feature FROM ranked WHERE rank = 1"),
    Query("pf1_target_labels", target_labels, """
SELECT CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS tg, CAST(count(*) AS BIGINT) AS n, 'keep' AS variant
FROM orders GROUP BY 1 UNION ALL
SELECT CASE o_orderstatus WHEN 'O' THEN 0 ELSE 1 END AS tg, CAST(count(*) AS BIGINT) AS n, 'drop' AS variant
FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1"""),
    Query("pf1_target_typed", target_typed, """
SELECT 1 AS tg, CAST(count(*) AS BIGINT) AS n, 'text' AS kind FROM lineitem WHERE l_linenumber = 1
UNION ALL SELECT l_linenumber - 1, CAST(count(*) AS BIGINT), 'int' FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1
UNION ALL SELECT CAST(trunc(l_quantity / 10) AS INTEGER), CAST(count(*) AS BIGINT), 'double' FROM lineitem
WHERE l_quantity < 20 GROUP BY 1"""),
    Query("pf2_target_coerced", target_coerced, """
SELECT CASE o_orderstatus WHEN 'O' THEN 0 ELSE 1 END AS tg, CAST(count(*) AS BIGINT) AS n FROM orders
WHERE o_orderkey % 7 <> 0 AND o_orderstatus IN ('O', 'F') GROUP BY 1
UNION ALL SELECT NULL, CAST(count(*) AS BIGINT) FROM orders WHERE o_orderkey % 7 = 0 OR o_orderstatus NOT IN ('O', 'F')"""),
    Query("pf3_target_selected", target_selected, """
SELECT tg, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '1.0'
  WHEN 2 THEN 'x' WHEN 3 THEN '2' ELSE ' 1 ' END AS tg FROM orders) WHERE TRY_CAST(tg AS DOUBLE) IN (0, 1) GROUP BY tg"""),
    Query("pf4_month_predicate", month_set_predicate, FEATURE_MONTHS_SQL.split("SELECT entity")[0] + """,
hit AS (SELECT mes, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_items) AS BIGINT) AS n_items FROM store
        WHERE mes IN (SELECT m FROM wanted) GROUP BY mes)
SELECT *, 'parts' AS via FROM hit UNION ALL SELECT *, 'mes' AS via FROM hit"""),
    Query("pf5_cast_selected", cast_selected,
          "SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice FROM orders"),
    Query("pf6_cast_by_pattern", cast_patterns,
          "SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey, "
          "CAST(l_suppkey AS VARCHAR) AS l_suppkey, l_quantity, 1 AS target FROM lineitem"),
    Query("pf7_output_columns", output_selection,
          with_(BASE) + "SELECT id, o_orderkey, data_ref1, target, o_totalprice FROM base"),
    Query("pf8_drop_prefixed", drop_derived,
          "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 2 AS n_removed FROM part"),
    Query("pf9_align_columns", align_to_train, "SELECT c_custkey, c_mktsegment FROM customer"),
    Query("pf10_replace_missing", replace_missing, f"""
SELECT {', '.join(ROW_KEY)}, CASE WHEN l_linenumber IN (1, 2) THEN -99999.0 ELSE l_quantity END AS v,
  CASE WHEN l_linenumber = 3 THEN 'NA' ELSE l_returnflag END AS t FROM lineitem"""),
    Query("pf11_coverage_flag", coverage, with_(BASE, STORE) + """
SELECT b.data_ref1, CASE WHEN s.entity IS NULL THEN 0 ELSE 1 END AS "FLAG_COBERTURA_DADOS_store",
  CAST(count(*) AS BIGINT) AS n
FROM base b LEFT JOIN store s ON b.id = CAST(s.entity AS VARCHAR) AND b.data_ref1 = """ + LAGGED + " GROUP BY 1, 2"),
    Query("pf12_threshold_flags", threshold_flags, with_(BASE, STORE) + """
SELECT b.id, b.o_orderkey, CASE WHEN s.card_amount > 0 THEN 1 ELSE 0 END AS flag_card
FROM base b LEFT JOIN store s ON b.id = CAST(s.entity AS VARCHAR) AND b.data_ref1 = """ + LAGGED),
    Query("pf13_mean_imputation", mean_imputed, with_(FEATURES) + f"""
SELECT {', '.join(ROW_KEY)}, {rs('coalesce(line_gap, (SELECT avg(line_gap) FROM feats))')} AS line_gap FROM feats"""),
    Query("pf13_median_imputation", median_imputed, with_(FEATURES) + f"""
SELECT {', '.join(ROW_KEY)}, {rs('coalesce(line_gap, (SELECT quantile_cont(line_gap, 0.5) FROM feats))')} AS line_gap,
  {rs('coalesce(mostly_null, (SELECT quantile_cont(mostly_null, 0.5) FROM feats))')} AS mostly_null FROM feats"""),
    Query("j1_point_in_time_join", point_in_time, with_(BASE, STORE) + PIT.format(month=LAGGED)),
    Query("j2_same_month_join", same_month, with_(BASE, STORE) + PIT.format(month="s.mes")),
    Query("j3_multi_source_enrichment", multi_source, MULTI_SQL),
    Query("j3_year_month_store", stored_source("year/month"), MULTI_SQL),
    Query("j3_text_month_store", stored_source("yyyyMM"), MULTI_SQL),
    Query("j4_entity_membership_join", entity_membership, with_(BASE) +
          f"SELECT * FROM base WHERE {md5_32(chr(39) + '42' + chr(39), 'id')} % 100 < 70"),
    Query("j5_group_count_join", group_counts, with_(BASE) + """
SELECT o_orderkey, data_ref1 || '_' || target AS stratum,
  CAST(count(*) OVER (PARTITION BY data_ref1, target) AS BIGINT) AS n_group FROM base"""),
    Query("j7_removal_status", removal_status, STATUS_SQL + "SELECT * FROM status"),
    Query("j7_removal_counts", removal_counts, STATUS_SQL + """
SELECT CASE WHEN "DROP_COL" = 1 THEN 'Dropped' ELSE 'Not Dropped' END AS drop_status, CAST(count(*) AS BIGINT) AS n
FROM status GROUP BY 1"""),
    Query("j8_registry_join", registry, """
WITH latest AS (SELECT o_custkey, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cep, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment, cep AS cd_cep_logr, substr(cep, 1, 2) AS "NEW__cep_2_digitos",
  substr(cep, 1, 3) AS "NEW__cep_3_digitos", substr(cep, 1, 4) AS "NEW__cep_4_digitos", substr(cep, 1, 5) AS "NEW__cep_5_digitos"
FROM customer LEFT JOIN latest ON o_custkey = c_custkey AND rn = 1"""),
    Query("ag1_behaviour_rollup", behaviour_rollup, _rollup_sql()),
    Query("ag2_full_id_passthrough", behaviour_passthrough, with_(behaviour_sql()) +
          "SELECT root, count_m01, vl_total_m01, " + ", ".join(f'"{a}"' for a in AMOUNTS) +
          ', CAST("full" AS VARCHAR) AS cnpj, date_ref AS data_ref1 FROM behaviour'),
    Query("ag3_most_frequent", most_frequent, """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS mode FROM (
  SELECT l_suppkey, l_shipdate, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_shipdate) AS rn
  FROM lineitem GROUP BY 1, 2) WHERE rn = 1"""),
    Query("ag5_cohort_months", lambda spark, sf: feature_store.cohort_months(orders_base(spark, sf), "data_ref1"),
          with_(BASE) + "SELECT DISTINCT data_ref1 FROM base"),
    Query("sc1_date_formats", date_formats, DATE_SQL),
    Query("sc2_sc3_month_columns", month_columns, """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, CAST(date_trunc('month', o_orderdate) AS DATE) AS data_ref1,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS previous FROM orders"""),
    Query("sc4_id_tags", id_tags,
          "SELECT c_custkey, CAST(length(upper(c_name)) AS INTEGER) AS num_digitos_cnpj, 'completo' AS tipo_cnpj FROM customer"),
    Query("sc5_id_cleaning", id_cleaning,
          "SELECT o_orderkey, ltrim(CAST(o_custkey AS VARCHAR) || CAST(o_orderkey % 10 AS VARCHAR), '0') AS clean_id FROM orders"),
    Query("sc6_stratum_key", stratum_keys, with_(BASE) + "SELECT o_orderkey, data_ref1 || '_' || target AS stratum FROM base"),
    Query("sc7_postcode_prefixes", postcodes, """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, """ + ", ".join(
        f"substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, {n}) AS \"NEW__cep_{n}_digitos\"" for n in (2, 3, 4, 5)) +
          " FROM customer"),
]
