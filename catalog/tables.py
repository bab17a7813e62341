"""Inputs of the registered queries: frames derived from the given tables, next to the same
derivations as SQL common table expressions."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.functions import feature_names as names
from scorekit.functions.columns import hash32
from scorekit.operators.clean import month_of
from scorekit.operators.sample import assign_sample
from scorekit.session import stage


class Query(NamedTuple):
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r(value, digits: int = 6) -> Column:
    """Rounded, without negative zero."""
    c = F.col(value) if isinstance(value, str) else value
    return F.rint(c * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits) + F.lit(0.0)


def rs(expr: str, digits: int = 6) -> str:
    return f"round_even({expr}, {digits}) + 0.0"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    chosen = set(columns)
    return df.select([r(c, digits).alias(c) if c in chosen else F.col(c) for c in df.columns])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# customer base -----------------------------------------------------------------------------------

def orders_base(spark, sf) -> DataFrame:
    """One row per order: text id, date, cohort month, and a target that is 2 for pending orders."""
    return (load(spark, sf, "orders")
            .select(F.col("o_custkey").cast("string").alias("id"), "o_orderkey",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"),
                    month_of("o_orderdate").alias("data_ref1"),
                    F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
                    .alias("target"),
                    "o_totalprice"))


BASE = """base AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS data_ref1,
         CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS target, o_totalprice
  FROM orders)"""

# monthly feature store ---------------------------------------------------------------------------

STORE_FEATURES = ["n_items", "sum_qty", "avg_discount", "card_amount"]


def monthly_store(spark, sf) -> DataFrame:
    """(entity, mes) features from line items."""
    items = load(spark, sf, "lineitem").join(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    return (items.groupBy(F.col("o_custkey").alias("entity"), month_of("l_shipdate").alias("mes"))
            .agg(F.count("*").alias("n_items"), F.sum("l_quantity").alias("sum_qty"),
                 r(F.avg("l_discount")).alias("avg_discount"),
                 F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
                 .alias("card_amount")))


STORE = f"""store AS (
  SELECT o_custkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes,
         CAST(count(*) AS BIGINT) AS n_items, sum(l_quantity) AS sum_qty,
         {rs('avg(l_discount)')} AS avg_discount,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS card_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

# supplier-side store with the same shape, for multi-source enrichment
def second_store(spark, sf) -> DataFrame:
    return (load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"),
                                              month_of("o_orderdate").alias("mes"))
            .agg(F.count("*").alias("n_orders"), r(F.max("o_totalprice"), 2).alias("max_order")))


STORE2 = f"""store2 AS (
  SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
         CAST(count(*) AS BIGINT) AS n_orders, {rs('max(o_totalprice)', 2)} AS max_order
  FROM orders GROUP BY 1, 2)"""

# scored sample -----------------------------------------------------------------------------------

ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def scored(spark, sf, sample: bool = False) -> DataFrame:
    """Line items with a smooth score, a heavily tied score, a target that follows the score and a
    prediction; optionally the entity / time sample."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    z = (quantity - 25) / 10 + (price - 53000) / 60000
    base = load(spark, sf, "lineitem").select(
        *ROW_KEY, month_of("l_shipdate").alias("data_ref1"), "l_quantity", "l_extendedprice",
        (F.col("l_discount") + 0.0).alias("l_discount"), "l_tax", "l_returnflag", "l_linestatus",
        r(1 / (1 + F.exp(-z))).alias("proba"),
        r(1 / (1 + F.exp(-(quantity - 25) / 10))).alias("proba_tied"),
        (hash32(*ROW_KEY, seed="t") % 1000).alias("_u"))
    out = base.select(*[c for c in base.columns if c != "_u"],
                      (F.col("_u") < 700 * F.col("proba")).cast("int").alias("target"),
                      (F.col("proba") >= 0.5).cast("int").alias("pred"))
    return assign_sample(out, "l_orderkey", "data_ref1") if sample else out


def md5_32(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


_ROW = [f"CAST({c} AS VARCHAR)" for c in ROW_KEY]
SCORED = f"""scored0 AS (
  SELECT {', '.join(ROW_KEY)}, CAST(date_trunc('month', l_shipdate) AS DATE) AS data_ref1, l_quantity,
         l_extendedprice, l_discount + 0.0 AS l_discount, l_tax, l_returnflag, l_linestatus,
         round(1 / (1 + exp(-((l_quantity - 25) / 10 + (l_extendedprice - 53000) / 60000))), 6) AS proba,
         round(1 / (1 + exp(-(l_quantity - 25) / 10)), 6) AS proba_tied,
         {md5_32("'t'", *_ROW)} % 1000 AS u
  FROM lineitem),
scored AS (
  SELECT * EXCLUDE (u), CASE WHEN u < 700 * proba THEN 1 ELSE 0 END AS target,
         CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM scored0)"""
SAMPLED = SCORED + f""",
cutoff AS (SELECT min(m) AS m FROM (SELECT DISTINCT data_ref1 AS m FROM scored ORDER BY m DESC LIMIT 3)),
sampled AS (
  SELECT scored.*, CASE WHEN data_ref1 >= (SELECT m FROM cutoff) THEN 'oot'
         WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'test' ELSE 'val' END AS sample
  FROM (SELECT *, {md5_32("'42'", 'CAST(l_orderkey AS VARCHAR)')} % 100 AS b FROM scored) AS scored)"""

# features with missing values and correlated twins -----------------------------------------------

NUMERIC_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price", "line_gap"]


def feature_frame(spark, sf, sample: bool = False) -> DataFrame:
    """The scored rows plus a correlated twin, a column with missing values and a nearly empty one."""
    return scored(spark, sf, sample).withColumns({
        "net_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "line_gap": F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") * F.col("l_quantity")),
        "mostly_null": F.when(F.col("l_linenumber") == 7, F.when(F.col("l_tax") > 0.07, F.col("l_tax")))})


def stored(df: DataFrame, *columns: str) -> DataFrame:
    """The wanted columns as a stored table: what operators with several passes are given in practice."""
    return stage(df.select(*columns) if columns else df, "table")


FEATURES = SCORED + """,
feats AS (
  SELECT *, l_extendedprice * (1 - l_discount) AS net_price,
         CASE WHEN l_linenumber > 1 THEN l_linenumber * l_quantity END AS line_gap,
         CASE WHEN l_linenumber = 7 AND l_tax > 0.07 THEN l_tax END AS mostly_null
  FROM scored)"""

# wide monthly families ---------------------------------------------------------------------------

def _cell(i: int) -> tuple[int, int]:
    return i % 12 + 1, 1 + i // 12


def wide_features(spark, sf, columns) -> DataFrame:
    """One row per customer; column i counts or sums scaled prices of one calendar month (NULL when
    absent). Sums are divided by an odd constant so that no derived value ends on a rounding tie."""
    items = load(spark, sf, "lineitem").join(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    slim = items.select(F.col("o_custkey").cast("string").alias("id"),
                        F.month("l_shipdate").alias("_m"), "l_linenumber",
                        (F.col("l_extendedprice") / 100000).alias("_x"))
    sums = []
    for i, c in enumerate(columns):
        m, s = _cell(i)
        here = (F.col("_m") == m) & (F.col("l_linenumber") <= 7 - s % 5)
        sums.append(F.sum(F.when(here, 1.0)).alias(c) if i % 3 == 0
                    else (r(F.sum(F.when(here, F.col("_x"))), 7) / 7.3890561).alias(c))
    return slim.groupBy("id").agg(*sums)


def wide_sql(columns) -> str:
    cells = []
    for i, c in enumerate(columns):
        m, s = _cell(i)
        here = f"m = {m} AND l_linenumber <= {7 - s % 5}"
        cells.append(f'CAST(nullif(count(*) FILTER ({here}), 0) AS DOUBLE) AS "{c}"' if i % 3 == 0
                     else f'round(sum(x) FILTER ({here}), 7) / 7.3890561::DOUBLE AS "{c}"')
    sums = ",\n".join(cells)
    return f"""items AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, month(l_shipdate) AS m, l_linenumber,
         l_extendedprice / 100000 AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
wide AS (SELECT id, {sums} FROM items GROUP BY id)"""


# full-id behaviour rows --------------------------------------------------------------------------

AMOUNT_RULES = [(stem, h, f"{stem}_{h}") for stem in names.AMOUNT_STEMS for h in names.AMOUNT_HORIZONS]
_AMOUNT_FLAG = dict(zip(names.AMOUNT_STEMS, ["A", "R", "N", None]))


def behaviour_rows(spark, sf) -> DataFrame:
    """Rows per (customer, supplier, year): calendar months 1 to 5 play the five month columns."""
    items = load(spark, sf, "lineitem").join(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    m, flag = F.month("l_shipdate"), F.col("l_returnflag")
    cols = []
    for k, name in enumerate(names.BEHAVIOUR_MONTHS, 1):
        here = m == k
        cols += [
            F.count_if(here).alias(f"count_{name}"),
            F.avg(F.when(here, (flag != "R").cast("double"))).alias(f"perc_good_{name}"),
            F.avg(F.when(here, F.col("l_linenumber").cast("double"))).alias(f"atraso_medio_{name}"),
            F.min(F.when(here, F.col("l_quantity"))).alias(f"atraso_minimo_{name}"),
            F.sum(F.when(here & (F.col("l_linestatus") == "F"), F.col("l_quantity")))
            .alias(f"vl_pg_em_dia_{name}"),
            F.sum(F.when(here, F.col("l_quantity"))).alias(f"vl_total_{name}")]
    for stem, h, column in AMOUNT_RULES:
        want = _AMOUNT_FLAG[stem]
        within = m <= int(h[:-1])
        cols.append(F.sum(F.when(within if want is None else within & (flag == want), F.col("l_quantity")))
                    .alias(column))
    return (items.groupBy(F.col("o_custkey").alias("root"), F.col("l_suppkey").alias("full"),
                          F.trunc("l_shipdate", "year").alias("date_ref")).agg(*cols))


def behaviour_sql() -> str:
    cols = []
    for k, name in enumerate(names.BEHAVIOUR_MONTHS, 1):
        here = f"month(l_shipdate) = {k}"
        cols += [
            f"CAST(count(*) FILTER ({here}) AS BIGINT) AS count_{name}",
            f"avg(CASE WHEN l_returnflag <> 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER ({here}) AS perc_good_{name}",
            f"avg(CAST(l_linenumber AS DOUBLE)) FILTER ({here}) AS atraso_medio_{name}",
            f"min(l_quantity) FILTER ({here}) AS atraso_minimo_{name}",
            f"sum(l_quantity) FILTER ({here} AND l_linestatus = 'F') AS vl_pg_em_dia_{name}",
            f"sum(l_quantity) FILTER ({here}) AS vl_total_{name}"]
    for stem, h, column in AMOUNT_RULES:
        want = _AMOUNT_FLAG[stem]
        cond = f"month(l_shipdate) <= {int(h[:-1])}" + (f" AND l_returnflag = '{want}'" if want else "")
        cols.append(f"sum(l_quantity) FILTER ({cond}) AS \"{column}\"")
    return ("behaviour AS (SELECT o_custkey AS root, l_suppkey AS \"full\", "
            "CAST(date_trunc('year', l_shipdate) AS DATE) AS date_ref,\n" + ",\n".join(cols)
            + "\nFROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)")
