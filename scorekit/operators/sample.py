"""Row sampling and entity / time splits, all driven by portable hashes of natural keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorekit.functions.columns import hash32
from scorekit.functions.order_stats import row_rank
from scorekit.functions.skew import spread_join
from scorekit.session import lookup_join

HASH_RANGE = 1 << 32
SLICES = 4096  # slices of the hash range in which positions are counted


def hash_order(keys, seed) -> Column:
    return hash32(*keys, seed=seed)


def sample_rows(df: DataFrame, fraction: float, seed: int, key=None) -> DataFrame:
    """Bernoulli sample: a row is in iff the hash of its key is below the fraction. Reproducible
    whatever the partitioning, and pushed into the scan stage. Without a key each row is drawn on its
    own by Spark's seeded sampler."""
    if not key:
        return df.sample(False, fraction, seed)
    return df.where(hash32(*key, seed=seed) < F.lit(int(fraction * HASH_RANGE)))


def random_rank(df: DataFrame, stratum, key, seed: int, name: str = "row_num") -> DataFrame:
    """Random position of each row within its stratum (1..n)."""
    marked = (df.withColumn("_hash", hash_order(key, seed))
              .withColumn("_slice", F.floor(F.col("_hash") * SLICES / HASH_RANGE)))
    ranked = row_rank(marked, stratum, ["_slice"], ["_hash", *key], name)
    return ranked.drop("_hash", "_slice")


def with_group_count(df: DataFrame, stratum, name: str = "n_group") -> DataFrame:
    """Attach the size of each stratum: aggregate, then a size-checked lookup join."""
    sizes = df.groupBy(*stratum).agg(F.count("*").alias(name))
    return lookup_join(df, sizes, list(stratum), "inner")


def stratified_rows(df: DataFrame, stratum: Column, keep_fraction: float, seed: int, key) -> DataFrame:
    """The floor(n * keep_fraction) rows of each stratum with the smallest hash.

    Rows are counted per (stratum, hash slice). Whole slices below the cut pass in the scan stage;
    only the one slice that holds the cut is sorted, so no task ever sees a whole stratum.
    """
    slices = 16 * SLICES
    marked = (df.withColumn("_stratum", F.coalesce(stratum.cast("string"), F.lit("")))
              .withColumn("_hash", hash_order(key, seed))
              .withColumn("_slice", F.floor(F.col("_hash") * slices / HASH_RANGE)))
    counts = marked.groupBy("_stratum", "_slice").agg(F.count("*").alias("_n"))
    upto = (Window.partitionBy("_stratum").orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy("_stratum")
    placed = counts.select(
        "_stratum", "_slice", F.sum("_n").over(upto).alias("_upto"), "_n",
        F.floor(F.sum("_n").over(whole) * F.lit(keep_fraction)).alias("_want"))
    cuts = (placed.where(F.col("_upto") >= F.col("_want")).groupBy("_stratum")
            .agg(F.min_by(F.struct(F.col("_slice").alias("_cut"),
                                   (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need")),
                          F.col("_slice")).alias("_c"))
            .select("_stratum", "_c._cut", "_c._need"))
    joined = lookup_join(marked, cuts, ["_stratum"], "inner")
    below = joined.where(F.col("_slice") < F.col("_cut"))
    order = Window.partitionBy("_stratum").orderBy("_hash", *[F.col(k) for k in key])
    edge = (joined.where(F.col("_slice") == F.col("_cut"))
            .withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= F.col("_need")))
    return below.select(*df.columns).unionAll(edge.select(*df.columns))


def sample_by_month_and_target(df: DataFrame, month: str, target: str, key, keep_fraction: float = 0.4,
                               seed: int = 10) -> DataFrame:
    """Equal share of every (month, target) stratum; ``key`` must identify rows."""
    stratum = F.concat_ws("_", F.col(month).cast("string"), F.col(target).cast("string"))
    return stratified_rows(df, stratum, keep_fraction, seed, list(key))


def stratified_sample(df: DataFrame, target: str, key, keep_fraction: float = 0.5,
                      seed: int = 10) -> DataFrame:
    """Equal share of every target class; ``key`` must identify rows."""
    return stratified_rows(df, F.col(target), keep_fraction, seed, list(key))


def recent_months(df: DataFrame, month: str, n: int) -> DataFrame:
    """The last ``n`` distinct months."""
    return df.select(month).where(F.col(month).isNotNull()).distinct().orderBy(F.desc(month)).limit(n)


def recent_cutoff(df: DataFrame, month: str, n: int) -> Column:
    """First of the last ``n`` months, as a lazy scalar."""
    return recent_months(df, month, n).agg(F.min(month)).scalar()


def entity_bucket(id_column: str, seed: int = 42) -> Column:
    return hash32(id_column, seed=seed) % 100


def assign_sample(df: DataFrame, id_column: str, month: str, n_recent: int = 3, seed: int = 42,
                  train: int = 70, test: int = 15, name: str = "sample") -> DataFrame:
    """Entity-disjoint train / test / val by hash bucket of the id; the last ``n_recent`` months are
    out of time. One projection: no shuffle of the fact table."""
    bucket = entity_bucket(id_column, seed)
    return df.withColumn(
        name, F.when(F.col(month) >= recent_cutoff(df, month, n_recent), "oot")
        .when(bucket < train, "train").when(bucket < train + test, "test").otherwise("val"))


def split_samples(df: DataFrame, id_column: str, month: str, **options) -> dict[str, DataFrame]:
    """The four samples as filtered views of one frame."""
    marked = assign_sample(df, id_column, month, **options)
    return {s: marked.where(F.col("sample") == s).drop("sample") for s in ("train", "test", "val", "oot")}


def rows_of_entities(df: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """All rows of the listed entities."""
    return spread_join(df, ids.select(id_column).distinct(), [id_column], "left_semi")


def split_by_recency(df: DataFrame, month: str, n_recent: int = 1) -> tuple[DataFrame, DataFrame]:
    """(older rows, rows of the last ``n_recent`` months)."""
    recent = F.coalesce(F.col(month) >= recent_cutoff(df, month, n_recent), F.lit(False))
    return df.where(~recent), df.where(recent)


def label_and_union(older: DataFrame, recent: DataFrame, name: str = "target_drift") -> DataFrame:
    return older.withColumn(name, F.lit(0)).unionByName(recent.withColumn(name, F.lit(1)))
