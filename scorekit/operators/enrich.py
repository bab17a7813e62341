"""Point-in-time enrichment of a customer base with monthly feature tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.functions.columns import ratio
from scorekit.functions.feature_names import AMOUNTS, BEHAVIOUR_MONTHS
from scorekit.functions.skew import SALT, hot_keys, salted, spread_join
from scorekit.operators.clean import dedup_by_key, postcode_prefixes
from scorekit.sources.feature_store import collect_months, feature_months, shift_months

# Fixed value: prefix of the coverage flags.
COVERAGE_PREFIX = "FLAG_COBERTURA_DADOS_"


@dataclass(frozen=True)
class FeatureSource:
    """A monthly feature table: one row per (entity, month) after the optional roll-up.

    ``table`` is a frame, or the path of a stored one. The month is a date, a text or number in
    ``month_format``, or a pair of year and month partition columns, which then become ``month``.
    """

    name: str
    table: DataFrame | str
    entity: str
    month: str
    features: Sequence[str]
    lag: int = 1
    rollup: Callable[[DataFrame, str, str], DataFrame] | None = None
    month_format: str | None = None


def shifted_features(source: FeatureSource, id_column: str, month: str) -> DataFrame:
    """The source keyed for the join: text id, and the cohort month ``lag`` months after the
    snapshot, so that a cohort never sees its own or a later month."""
    table = source.table
    if source.rollup is not None:
        table = source.rollup(table, source.entity, source.month)
    return table.select(
        F.col(source.entity).cast("string").alias(id_column),
        F.add_months(F.col(source.month).cast("date"), source.lag).alias(month),
        *source.features,
        F.lit(1).alias(COVERAGE_PREFIX + source.name))


def join_features(base: DataFrame, source: FeatureSource, id_column: str, month: str,
                  hot: Mapping[str, int] | None = None) -> DataFrame:
    """Left join of one source plus its 0/1 coverage flag.

    Both sides are hashed on (id, month). Keys that own very many base rows (``hot``, looked up when
    not given) are dealt over several tasks.
    """
    flag = COVERAGE_PREFIX + source.name
    keyed = base.withColumn(id_column, F.col(id_column).cast("string"))
    joined = spread_join(keyed, shifted_features(source, id_column, month), [id_column, month], "left", hot)
    return joined.select(*[F.coalesce(F.col(flag), F.lit(0)).alias(flag) if c == flag else F.col(c)
                           for c in joined.columns])


def within_months(source: FeatureSource, months: Sequence[date]) -> FeatureSource:
    """The source cut to the snapshots that the cohort months ask for, before any roll-up, with its month
    as a date. The filter is on the stored columns, so partitions and row groups are skipped."""
    table = source.table
    if isinstance(table, str):
        table = SparkSession.active().read.parquet(table)
    cut = feature_months(table, shift_months(months, -source.lag), source.month, source.month_format)
    return replace(source, table=cut, month_format=None)


def enrich(base: DataFrame, sources: Sequence[FeatureSource], id_column: str, month: str) -> DataFrame:
    """Fold all sources onto the base. Every source is first cut to the months the base needs; the
    joins share one partitioning and one dealing of hot keys."""
    keyed = base.withColumn(id_column, F.col(id_column).cast("string"))
    hot = hot_keys(keyed, [id_column, month])
    months = collect_months(keyed, month)
    dealt = salted(keyed, [id_column, month], hot) if hot else keyed
    return reduce(lambda df, source: join_features(df, within_months(source, months), id_column, month, hot),
                  sources, dealt).drop(SALT)


def positive_flags(df: DataFrame, amounts: dict[str, str]) -> DataFrame:
    """Flag name -> amount column: 1 when the amount is positive, 0 otherwise and for NULL."""
    return df.withColumns({name: F.when(F.col(c) > 0, 1).otherwise(0) for name, c in amounts.items()})


def card_flags(df: DataFrame) -> DataFrame:
    return positive_flags(df, {f"flag_cartao_{n}m": f"total_cartao_recebido_{n}M" for n in (3, 6, 12)})


def rollup_behaviour(table: DataFrame, entity: str, month: str,
                     months: Sequence[str] = tuple(BEHAVIOUR_MONTHS),
                     amounts: Sequence[str] = tuple(AMOUNTS)) -> DataFrame:
    """Full-id rows to one row per (root id, month): means, minima, sums and ratios of sums."""
    def per_month(m: str) -> list[Column]:
        good = F.sum(F.col(f"count_{m}") * F.col(f"perc_good_{m}"))
        count, total = F.sum(f"count_{m}"), F.sum(f"vl_total_{m}")
        paid = F.sum(f"vl_pg_em_dia_{m}")
        return [F.mean(f"atraso_medio_{m}").alias(f"atraso_medio_{m}"),
                good.alias(f"count_good_{m}"), count.alias(f"count_{m}"),
                total.alias(f"vl_total_{m}"), paid.alias(f"vl_pg_em_dia_{m}"),
                ratio(paid, total).alias(f"perc_vl_pg_{m}"),
                ratio(good, count).alias(f"perc_good_{m}"),
                F.min(f"atraso_minimo_{m}").alias(f"atraso_minimo_{m}")]
    measures = [c for m in months for c in per_month(m)]
    return table.groupBy(entity, month).agg(*measures, *[F.sum(a).alias(a) for a in amounts])


def passthrough(table: DataFrame, entity: str, month: str, features: Sequence[str],
                id_column: str, month_column: str) -> DataFrame:
    """Full-id features: select, rename and cast only."""
    return table.select(*features, F.col(entity).cast("string").alias(id_column),
                        F.col(month).cast("date").alias(month_column))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """Mode of a column per key, smallest value on ties. Counting (key, value) first keeps every
    group's state to one struct, however many values a key has."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return (counts.groupBy(*keys)
            .agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_best"))
            .select(*keys, F.col("_best.v").alias(name)))


def join_registry(base: DataFrame, registry: DataFrame, id_column: str, registry_id: str,
                  updated: str, postcode: str, columns: Sequence[str]) -> DataFrame:
    """Company registry: latest row per id, left join, postcode prefixes of 2 to 5 digits."""
    latest = dedup_by_key(registry.select(registry_id, updated, *columns), [registry_id], [updated])
    keyed = latest.select(F.col(registry_id).cast("string").alias(id_column), *columns)
    joined = spread_join(base.withColumn(id_column, F.col(id_column).cast("string")), keyed, [id_column])
    return postcode_prefixes(joined, postcode)
