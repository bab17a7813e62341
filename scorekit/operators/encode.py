"""Encoders and scalers: fitted on the training sample, applied to any sample."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import finite, unpivot_structs
from scorekit.functions.order_stats import row_rank
from scorekit.functions.skew import hot_counts, spread_join
from scorekit.operators.clean import MISSING_NUMBER, replace_missing
from scorekit.session import LOOKUP_ROWS, small_table, stage

# Codes of rare or unseen and of missing categories, least count of a ranked one.
RARE_CODE, MISSING_CODE, MIN_COUNT = 1, -999, 40


def frequency_ranks(df: DataFrame, columns: Sequence[str], min_count: int = MIN_COUNT) -> DataFrame:
    """(variable, value, n, code): the values of each column seen more than ``min_count`` times,
    numbered from 1 by ascending count; equal counts are ordered by the md5 of the value.

    All columns are counted in one map-side combined aggregation, and positions are added up per
    (count, md5 prefix), so no task ever holds all values of a column.
    """
    entries = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value"))
               for c in columns]
    counted = (unpivot_structs(df, [], entries).where(F.col("value").isNotNull())
               .groupBy("variable", "value").agg(F.count("*").alias("n"))
               .where(F.col("n") > min_count)
               .withColumn("_md5", F.md5("value")).withColumn("_head", F.substring("_md5", 1, 2)))
    ranked = row_rank(counted, ["variable"], ["n", "_head"], ["_md5"], "code")
    return ranked.select("variable", "value", "n", "code")


@dataclass(frozen=True)
class RankCountModel:
    """Frequency codes: known values get their rank, unseen or rare ones 1, missing ``set_nans``.

    ``short`` holds the codes of columns whose lists were checked to be small, and lives in memory; all
    other columns together take one shuffled join that deals the values of which the mapping counts many rows.
    """

    mapping: DataFrame
    columns: Sequence[str]
    set_nans: int = MISSING_CODE
    short: DataFrame | None = None
    short_columns: frozenset[str] = frozenset()

    def transform(self, df: DataFrame) -> DataFrame:
        long = [c for c in self.columns if c not in self.short_columns]
        out = self._all_at_once(df, long) if len(long) > 1 else df
        for c in (self.columns if len(long) == 1 else [c for c in self.columns if c not in long]):
            own = ((self.short if c in self.short_columns else self.mapping).where(F.col("variable") == c)
                   .select(F.col("value").alias("_value"), F.col("code").alias("_code"), "n"))
            codes, keyed = own.drop("n"), out.withColumn("_value", F.col(c).cast("string"))
            joined = (keyed.join(F.broadcast(codes), "_value", "left") if c in self.short_columns
                      else spread_join(keyed, codes, ["_value"], hot=hot_counts(own, ["_value"], "n")))
            out = joined.select(*[self._code(F.col(c), F.col("_code")).alias(c) if x == c else F.col(x) for x in out.columns])
        return out

    def _code(self, value, found):
        return (F.when(value.isNull(), F.lit(self.set_nans)).otherwise(F.coalesce(found, F.lit(RARE_CODE)))).cast("int")

    def _all_at_once(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Codes of several long columns from one join: (row, column, value) meets the mapping, and a row's codes come back
        as a map. Row numbers are stored with the rows, so a task that is run again finds the same."""
        rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "encoder-rows")
        entries = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
        values = unpivot_structs(rows, ["_row"], entries).where(F.col("value").isNotNull())
        own, keys = self.mapping.where(F.col("variable").isin(columns)), ["variable", "value"]
        met = spread_join(values, own.select(*keys, "code"), keys, "inner", hot_counts(own, keys, "n"))
        codes = met.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("variable", "code"))).alias("_codes"))
        joined = rows.join(codes, "_row", "left")
        return joined.select(*[self._code(F.col(x), F.col("_codes")[x]).alias(x) if x in columns else F.col(x) for x in df.columns])


@dataclass(frozen=True)
class RankCountEncoder:
    columns: Sequence[str]
    set_nans: int = MISSING_CODE
    min_count: int = MIN_COUNT

    def fit(self, df: DataFrame) -> RankCountModel:
        """Count once into a stored table; the short lists of it also become an in-memory relation."""
        ranks = stage(frequency_ranks(df, self.columns, self.min_count), "rank-count")
        lengths = {r["variable"]: r["count"] for r in ranks.groupBy("variable").count().collect()}
        short, rows = [], 0
        for c in sorted(self.columns, key=lambda c: lengths.get(c, 0)):
            rows += lengths.get(c, 0)
            if rows <= LOOKUP_ROWS:
                short.append(c)
        local = small_table(ranks.where(F.col("variable").isin(short)))
        if local is None:
            return RankCountModel(ranks, self.columns, self.set_nans)
        return RankCountModel(ranks, self.columns, self.set_nans, local, frozenset(short))


@dataclass(frozen=True)
class LinearScaler:
    """(x - offset) / scale per column, NULL kept."""

    offsets: dict[str, float]
    scales: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select([((finite(c) - F.lit(self.offsets[c])) / F.lit(self.scales[c])).alias(c)
                          if c in self.scales else F.col(c) for c in df.columns])


def fit_standard(df: DataFrame, columns: Sequence[str]) -> LinearScaler:
    """Mean and population deviation over the finite values; a constant column is only centred."""
    row = df.agg(*[F.avg(finite(c)).alias(f"m_{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(finite(c)).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    means = {c: row[f"m_{i}"] or 0.0 for i, c in enumerate(columns)}
    spreads = {c: row[f"s_{i}"] or 0.0 for i, c in enumerate(columns)}
    # a spread that is only rounding noise of the mean means a constant column
    return LinearScaler(means, {c: s if s > 1e-10 * abs(means[c]) else 1.0 for c, s in spreads.items()})


def fit_max_abs(df: DataFrame, columns: Sequence[str]) -> LinearScaler:
    row = df.agg(*[F.max(F.abs(finite(c))).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    return LinearScaler({c: 0.0 for c in columns},
                        {c: row[f"s_{i}"] or 1.0 for i, c in enumerate(columns)})


@dataclass(frozen=True)
class Preprocessor:
    """Fitted preparation of one model kind. Columns that are neither numeric features nor
    categorical (dates, ids, target) pass through untouched."""

    kind: str
    encoder: RankCountModel | None
    scaler: LinearScaler | None
    numeric: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.encoder.transform(df) if self.encoder is not None else df
        return _prepare(self.kind, out, self.scaler, self.numeric)


def _prepare(kind: str, df: DataFrame, scaler, features: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in set(features)]
    if kind == "catboost":
        return replace_missing(df, text="NA", exclude=others)
    if kind == "logit":
        df = replace_missing(df, number=MISSING_NUMBER, exclude=others)
    elif kind == "xgboost":
        df = replace_missing(df, exclude=others)
    return scaler.transform(df) if scaler is not None else df


def fit_preprocessor(kind: str, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     min_count: int = MIN_COUNT) -> Preprocessor:
    """Recipes: ``lgbm`` encodes; ``xgboost`` encodes, drops infinities, standardises; ``catboost``
    spells missing text 'NA'; ``logit`` encodes, fills missing, scales by the maximum."""
    if kind not in ("lgbm", "xgboost", "catboost", "logit"):
        raise ValueError(f"unknown model kind: {kind}")
    features = [*numeric, *categorical]
    if kind == "catboost":
        return Preprocessor(kind, None, None, features)
    encoder = RankCountEncoder(categorical, min_count=min_count).fit(train) if categorical else None
    ready = encoder.transform(train) if encoder is not None else train
    scaler = None
    if kind == "xgboost":
        scaler = fit_standard(ready, features)
    elif kind == "logit":
        scaler = fit_max_abs(_prepare(kind, ready, None, features), features)
    return Preprocessor(kind, encoder, scaler, features)
