"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups.

Groups (rows with equal texts) stand in the order of their text's digest. The smallest capacity with
which all groups fit into the shards, taken greedily in that order, is found by binary search over many
capacities at once, and the shards are cut within that capacity. The greedy check follows the shards of every
capacity by small aggregations over the stored running sums. The driver holds one sum per shard and
capacity tried, and two per cell of a byte grid, whatever the input and its skew; there are
shards * log(largest group) / log(capacities at once) aggregations. Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorekit.llm.common import bucket_of, stage

GRID = 8192  # byte cells whose first and last sums are candidates for cuts
CANDIDATES = 64  # capacities that are checked at once
HEX = 3  # hex digits of the digest that make up a bucket of the running sum
CELLS = 4096  # cells per shard in which slots are numbered


def _running(df: DataFrame, bucket: str, order: str, values: dict[str, str]) -> DataFrame:
    """Running sums over the whole table by ``order``, of which ``bucket`` is a prefix: sums inside
    buckets plus the sums of the buckets before, of which there are few."""
    within = W.partitionBy(bucket).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    totals = df.groupBy(bucket).agg(*[F.sum(v).alias(f"{name}_all") for name, v in values.items()])
    earlier = W.partitionBy(F.lit(0)).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col(bucket).alias("at"), *[
        F.coalesce(F.sum(f"{name}_all").over(earlier), F.lit(0)).alias(f"{name}_before") for name in values])
    summed = df.select("*", *[F.sum(v).over(within).alias(f"{name}_in") for name, v in values.items()])
    return summed.join(F.broadcast(totals), F.col(bucket) == F.col("at")).select(
        *df.columns, *[(F.col(f"{name}_in") + F.col(f"{name}_before")).alias(name) for name in values])


def _even_cuts(bounds: list[int], capacity: int, shards: int) -> list[int]:
    """Ends of shards within ``capacity``, each as near as possible to an even share of what is left."""
    total = bounds[-1]
    earliest = [total]  # from the right: where a shard can end so that the rest still fits
    for _ in range(shards - 1):
        earliest.append(bounds[bisect_left(bounds, earliest[-1] - capacity)] if earliest[-1] > capacity else 0)
    earliest.reverse()
    cuts, at = [], 0
    for j in range(shards):
        ideal = at + (total - at) / (shards - j)
        k = bisect_left(bounds, ideal)
        nearest = min(bounds[max(0, k - 1):k + 1], key=lambda b: abs(b - ideal))
        latest = bounds[bisect_right(bounds, at + capacity) - 1]
        at = min(max(nearest, earliest[j]), latest)
        cuts.append(at)
    return cuts


def _starts(sums: DataFrame, total: int, largest: int, capacities: list[int], shards: int) -> dict[int, list[int]]:
    """For each capacity, where the shards begin if they are filled from the end, each with all groups that fit. The list
    ends at 0 if ``shards`` shards suffice.

    One small aggregation finds the next beginning of all capacities: the first sum not below the last beginning
    less the capacity, which is at most a group away.
    """
    found = {c: [total] for c in capacities}
    for _ in range(shards):
        wanted = sorted({at[-1] - c for c, at in found.items() if at[-1] > c})
        if wanted:
            near = sums.where(F.col("upto").between(wanted[0], wanted[-1] + largest))
            row = near.agg(*[F.min(F.when(F.col("upto") >= w, F.col("upto"))) for w in wanted]).first()
            first = dict(zip(wanted, row, strict=True))
        for c, at in found.items():
            if at[-1]:
                at.append(first[at[-1] - c] if at[-1] > c else 0)
    return found


def minimax_cuts(sums: DataFrame, shards: int, grid: int = GRID) -> list[int]:
    """Running sums at which the shards end. ``sums`` has one row per group: upto (running sum, group
    included), number (from 1), size. It should be staged.

    The smallest capacity lies between the mean shard (or the largest group) and a group more than that. Each round
    checks CANDIDATES capacities of this span at once, shard by shard, and narrows it to the gap
    between two of them. Within the capacity found, the cuts then leave shards as even as it and the first and
    last sums of ``grid`` byte cells allow.
    """
    total, largest = sums.agg(F.max("upto"), F.max("size")).first()
    if not total:
        return [0] * shards
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    while True:
        tried = sorted({low + (high - low) * k // (CANDIDATES - 1) for k in range(CANDIDATES)})
        starts = _starts(sums, total, largest, tried, shards)
        fits = [c for c in tried if starts[c][-1] == 0]
        high = fits[0]
        if high == low:
            break
        low = max(c for c in tried if c < high) + 1
        if low == high:
            break
    width = max(1, total // grid)
    cells = sums.groupBy(F.floor(F.col("upto") / width)).agg(F.min("upto").alias("first"), F.max("upto").alias("last")).collect()
    return _even_cuts(sorted({0, total, *starts[high], *(r["first"] for r in cells), *(r["last"] for r in cells)}), high, shards)


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  overhead: int = 8, grid: int = GRID) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus ``overhead``; a null text counts as an empty one. Rows with
    equal texts share a shard, so a shard can be no smaller than the largest group. Slots number the
    rows of a shard from 0. Repeated rows and null ids are rows like others. With fewer groups than
    shards the last shards stay empty, as all do for an empty table. Other columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = stage(docs.select(F.col(key).alias("key"), (F.octet_length(content) + overhead).cast("long").alias("size"),
                             F.crc32(content).alias("text_crc32"), F.md5(content).alias("digest")), "shard-rows")
    groups = (rows.groupBy("digest").agg(F.sum("size").alias("size"))
              .withColumn("bucket", F.substring("digest", 1, HEX)).withColumn("one", F.lit(1)))
    sums = stage(_running(groups, "bucket", "digest", {"upto": "size", "number": "one"})
                 .select("digest", "size", "upto", "number"), "shard-groups")
    cuts = minimax_cuts(sums, shards, grid)
    ends = {r["upto"]: r["digest"] for r in sums.where(F.col("upto").isin(sorted(set(cuts)))).collect()}
    shard = F.lit(0)  # rows after the last digest of a shard belong to a later one
    for cut in cuts[:-1]:
        shard = shard + (F.col("digest") > F.lit(ends[cut])).cast("int") if cut in ends else shard + 0
    rows = rows.withColumn("shard", shard.cast("int")).withColumn("cell", bucket_of(CELLS, "key", "digest"))
    cells = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("shard", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(W.partitionBy("shard", "cell").orderBy("key", "digest")) - 1
    return (rows.withColumn("number", number).join(cells, ["shard", "cell"])
            .select("key", "size", "text_crc32", "shard", (F.col("before") + F.col("number")).cast("long").alias("slot"))
            .withColumnRenamed("key", key))
