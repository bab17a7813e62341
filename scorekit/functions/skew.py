"""Joins whose big side may hold a large share of its rows under a few keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key that a task is given before the key is split
LISTED_KEYS = 20_000  # hot keys on the driver; with more of them, tasks are given more rows
SALT = "_salt"


def key_text(keys: Sequence[str]) -> Column:
    """One text per key combination, NULL being a value of its own."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys])


def hot_counts(counts: DataFrame, keys: Sequence[str], n: str, hot_rows: int = HOT_ROWS) -> dict[str, int]:
    """Keys of ``counts`` that own at least ``hot_rows`` rows, as texts, and over how many tasks to deal them.

    There can be no more than rows / ``hot_rows`` of them. When that is still too long a list, the bar is
    doubled until it is not, so no key ever brings a task more than twice the bar.
    """
    while True:
        found = (counts.where(F.col(n) >= hot_rows).select(key_text(keys).alias("key"), F.col(n).alias("n"))
                 .limit(LISTED_KEYS + 1).collect())
        if len(found) <= LISTED_KEYS:
            return {r["key"]: 1 + r["n"] // hot_rows for r in found}
        hot_rows *= 2


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> dict[str, int]:
    """The hot keys of ``df``; counting is combined map-side."""
    return hot_counts(df.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "_n", hot_rows)


def _with_salts(df: DataFrame, keys: Sequence[str], hot: Mapping[str, int]) -> DataFrame:
    table = df.sparkSession.createDataFrame(list(hot.items()), "_key string, _salts int")
    return df.withColumn("_key", key_text(keys)).join(F.broadcast(table), "_key", "left").drop("_key")


def salted(df: DataFrame, keys: Sequence[str], hot: Mapping[str, int]) -> DataFrame:
    """``df`` with the column SALT, which deals the rows of each hot key. Joins that follow reuse it and
    share one partitioning.

    The salt depends on the row and its input partition, so a retried task deals the same way and
    exact copies from different partitions part company.
    """
    dealt = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col("_salts")).cast("int")
    return _with_salts(df, keys, hot).withColumn(SALT, F.coalesce(dealt, F.lit(0))).drop("_salts")


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                hot: Mapping[str, int] | None = None) -> DataFrame:
    """Equi-join (left, inner, left_semi) that deals the left rows of every hot key over several tasks and
    repeats only the matching right rows. Without hot keys it is an ordinary join. A left side that is
    already salted stays so.
    """
    keys = list(keys)
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot:
        return left.join(right, keys, how)
    keep = SALT in left.columns
    ready = left if keep else salted(left, keys, hot)
    repeated = (_with_salts(right, keys, hot)
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                .drop("_salts"))
    joined = ready.join(repeated, [*keys, SALT], how)
    return joined if keep else joined.drop(SALT)
