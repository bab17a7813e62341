"""Mix sources to target weights by systematic sampling.

Each document of a source is expected in the mix target / size times (of its source). Expected copies
are summed up along the source's documents, one offset in [0, 1) is added, and a document is emitted
once for each integer that its own span crosses. The documents of a source are ordered by size, which
keeps the words taken close to the target.

The running sum needs each document's position in its source. It is built from three bounded levels,
so that no task holds a source: counts by (source, size), counts by (source, size, bucket of the id and
text), and row numbers inside such a bucket. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorekit.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


def words_of(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*columns: Column) -> Column:
    """A number in [0, 1) with 32 bits that depends on the columns as text."""
    texts = [F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    digest = F.md5(F.concat_ws("|", *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets of (source, source_size): the sources by code point, null last, take ``weights`` in turn
    and share ``share`` times all sizes by weight; a source stops at ``most`` times its size and what
    it leaves is shared again until none is above.

    Sources fill up in the order of limit / weight. With the first k of them full the others would
    stand at (total - their limits) / (weights of the others) per unit of weight; this rises with k
    until filling stops and falls after that, so the level is its maximum. The windows hold one row
    per source.
    """
    everyone = W.partitionBy(F.lit(0))
    turn = F.pmod(F.row_number().over(everyone.orderBy(F.col("source").asc_nulls_last())) - 1,
                  F.lit(len(weights))).cast("int")
    earlier = everyone.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    summed = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0.0))
    return (sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
            .withColumn("cap", F.col("source_size") * F.lit(float(most)))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("level", (F.sum("source_size").over(everyone) * F.lit(float(share)) - summed("cap"))
                        / (F.sum("weight").over(everyone) - summed("weight")))
            .withColumn("level", F.max("level").over(everyone))
            .select("source", "source_size",
                    F.least("cap", F.col("level") * F.col("weight")).alias("target")))


def _same(left: str, right: str, *columns: str) -> Column:
    met = F.lit(True)
    for c in columns:
        met = met & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return met


def plan_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
             seed: int = 1, buckets: int = BUCKETS, carry: bool = False) -> DataFrame:
    """One row per input row: key, source, size, source_size, target, copies, and with ``carry`` the
    whole input row as the struct ``row``.

    Size is the number of words; a null or empty text has none and takes part like any other, which
    adds no words. A source of size 0 has target 0 and no copies. Ties are ordered by id and text
    digest, so reruns agree; rows that repeat both are interchangeable. Null ids and the null source
    are values of their own. An empty table gives an empty plan.
    """
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    columns = [F.col(key).alias("key"), F.col(source).alias("source"), words_of(F.col(text)).alias("size"),
               digest.alias("digest")]
    place = F.floor(unit(F.col("key"), F.col("digest")) * buckets).cast("int")
    rows = stage(docs.select(*columns).withColumn("bucket", place), "mix-rows")

    cells = rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    cells = cells.withColumn("in_size", F.coalesce(F.sum("n").over(
        W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    sizes = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    steps = sizes.withColumn("in_source", F.coalesce(F.sum("n").over(
        W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    totals = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    steps = (steps.alias("s").join(targets.alias("t"), _same("s", "t", "source"))
             .select("s.source", "s.size", "in_source", "source_size", "target"))
    places = (cells.alias("c").join(steps.alias("s"), _same("c", "s", "source", "size"))
              .select("c.source", "c.size", "c.bucket", (F.col("in_source") + F.col("in_size")).alias("start"),
                      "source_size", "target"))
    order = ["key", "digest"]
    if carry:
        rows = docs.select(*columns, F.struct("*").alias("row")).withColumn("bucket", place)
        order.append(F.xxhash64("row"))
    rows = rows.withColumn("number", F.row_number().over(
        W.partitionBy("source", "size", "bucket").orderBy(*order)))
    met = rows.alias("r").join(places.alias("p"), _same("r", "p", "source", "size", "bucket"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit(F.lit(seed), F.col("r.source"))
    crossed = lambda n: F.floor(n * rate + offset)  # noqa: E731  integers that n documents cross
    number = F.col("start") + F.col("number")
    return met.select("key", "r.source", "r.size", "source_size", "target",
                      (crossed(number) - crossed(number - 1)).alias("copies"), *(["row"] if carry else []))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix: the rows of ``docs`` with all their columns, each as often as it is taken."""
    return (plan_mix(docs, key, text, source, carry=True, **options).where(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
