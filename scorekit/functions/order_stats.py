"""Exact order statistics without a global sort on one task.

Three tools:

* ``ordered_buckets`` and ``running_sums`` - cumulative sums over an order, computed inside
  order-preserving buckets of bounded size plus the total of the earlier buckets.
* ``exact_quantiles`` - a mergeable sketch brackets every wanted rank, then only the values inside
  the brackets are shuffled and counted to find the exact element. ``grouped_quantiles`` does so for
  all groups of a table at once.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorekit.functions.columns import double_array, finite
from scorekit.functions.skew import key_text
from scorekit.session import lookup_join, stage

SKETCH_ACCURACY = 10_000
BUCKET = "_bucket"
BUCKET_VALUES = 1_000_000  # distinct values that a task orders
MOST_BUCKETS = 50_000
SLICES = 1024  # parts of equal width of a bracket


def ordered_buckets(counted: DataFrame, keys, value: str, most: int = BUCKET_VALUES) -> DataFrame:
    """A table with one row per (keys, value), stored with the column BUCKET: numbers that ascend with
    (keys, value) and that no more than ``most`` rows share.

    The edges of the buckets come from a sample of the combined rows that Spark's range partitioning takes, so
    ties weigh nothing and what made the rows is not evaluated again. Where a bucket comes out too full, the
    stored rows are cut into more ranges. Beyond ``most`` * MOST_BUCKETS rows the buckets grow.
    """
    order = [F.col(k).asc_nulls_first() for k in [*keys, value]]
    spark = counted.sparkSession
    buckets = max(2, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))
    while True:
        stored = stage(counted.repartitionByRange(buckets, *order)
                       .withColumn(BUCKET, F.spark_partition_id().cast("long")), "ordered")
        sizes = stored.groupBy(BUCKET).agg(F.count("*").alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("all")).first()
        if (sizes["top"] or 0) <= most or buckets == MOST_BUCKETS:
            return stored
        counted, buckets = stored.drop(BUCKET), min(MOST_BUCKETS, max(2 * buckets, math.ceil(2 * sizes["all"] / most)))


def with_buckets(df: DataFrame, edges: dict[str, list[float]], suffix: str = "_bucket") -> DataFrame:
    """Add ``<column><suffix>``, the index of the edge interval by binary search (NULL keeps its own
    extra bucket)."""
    names = list(edges)
    splits = []
    for name in names:
        inner = [e for e in edges[name] if math.isfinite(e)] or [0.0]
        splits.append([-math.inf, *inner, math.inf])
    if not names:
        return df
    return Bucketizer(inputCols=names, outputCols=[n + suffix for n in names],
                      splitsArray=splits, handleInvalid="keep").transform(df)


def running_sums(df: DataFrame, keys, bucket: str, order, measures) -> DataFrame:
    """Add ``cum_<m>`` (inclusive running sum over ``bucket, order`` within ``keys``) and ``tot_<m>``.

    ``bucket`` must be monotone in ``order``. Only (keys, bucket) groups meet in one task; the
    offsets table has one row per (keys, bucket).
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    renamed = [F.col(k).alias(f"_k_{k}") for k in [*keys, bucket]]
    offsets = totals.select(
        *renamed,
        *[F.coalesce(F.sum(f"_s_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"tot_{m}") for m in measures])
    inside = (Window.partitionBy(*keys, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    local = df.select("*", *[F.sum(m).over(inside).alias(f"_in_{m}") for m in measures])
    match = F.lit(True)
    for k in [*keys, bucket]:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = local.join(offsets, match, "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_before_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"tot_{m}") for m in measures])


def surrounding(probes: DataFrame, points: DataFrame, most: int = BUCKET_VALUES) -> DataFrame:
    """For each distinct x of ``probes`` (x) the nearest of ``points`` (x, y; distinct x) not above and not below it:
    x, x0, y0, x1, y1, null where there is none.

    Both tables are merged in order-preserving buckets, inside which the last and the next point are carried along;
    a bucket gets what it lacks at its ends from the table of the buckets' first and last points.
    """
    merged = (probes.select("x", F.lit(None).cast("double").alias("y")).unionByName(points.select("x", "y"))
              .groupBy("x").agg(F.max("y").alias("y")))
    stored = ordered_buckets(merged, [], "x", most)
    point = F.when(F.col("y").isNotNull(), F.struct("x", "y"))
    ends = stored.groupBy(BUCKET).agg(F.max(point).alias("_top"), F.min(point).alias("_bottom"))
    order = Window.partitionBy(F.lit(0)).orderBy(BUCKET)  # a row per bucket
    ends = ends.select(F.col(BUCKET).alias("_at"),
                       F.last("_top", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.first("_bottom", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_behind"))
    inside = Window.partitionBy(BUCKET).orderBy("x")
    carried = stored.select(
        "x", BUCKET, F.last(point, True).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_left"),
        F.first(point, True).over(inside.rowsBetween(0, Window.unboundedFollowing)).alias("_right"))
    left, right = F.coalesce("_left", "_before"), F.coalesce("_right", "_behind")
    return carried.join(ends, F.col(BUCKET) == F.col("_at")).select(
        "x", left["x"].alias("x0"), left["y"].alias("y0"), right["x"].alias("x1"), right["y"].alias("y1"))


def row_rank(df: DataFrame, keys, levels, order, name: str) -> DataFrame:
    """``row_number`` within ``keys`` ordered by ``levels`` then ``order``, with no task holding a
    whole key: positions are counted level by level and only the last level is sorted."""
    keys, levels = list(keys), list(levels)
    cells = df.groupBy(*keys, *levels).agg(F.count("*").alias("_cell"))
    offset = F.lit(0)
    for depth in range(len(levels)):
        group = keys + levels[:depth]
        here = keys + levels[:depth + 1]
        sizes = cells.groupBy(*here).agg(F.sum("_cell").alias("_size"))
        earlier = (Window.partitionBy(*group).orderBy(levels[depth])
                   .rowsBetween(Window.unboundedPreceding, -1))
        starts = sizes.select(*[F.col(c).alias(f"_l{depth}_{c}") for c in here],
                              F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias(f"_start{depth}"))
        match = F.lit(True)
        for c in here:
            match = match & F.col(c).eqNullSafe(F.col(f"_l{depth}_{c}"))
        df = df.join(starts, match, "inner").drop(*[f"_l{depth}_{c}" for c in here])
        offset = offset + F.col(f"_start{depth}")
    local = F.row_number().over(Window.partitionBy(*keys, *levels).orderBy(*order))
    return (df.withColumn(name, (offset + local).cast("bigint"))
            .drop(*[f"_start{d}" for d in range(len(levels))]))


def _brackets(los, his):
    """Merge per-probability value brackets into disjoint ascending intervals; also tell which
    interval each probability fell into."""
    order = sorted(range(len(los)), key=lambda i: (los[i], his[i]))
    merged, member = [], [0] * len(los)
    for i in order:
        if merged and los[i] <= math.nextafter(merged[-1][1], math.inf):
            merged[-1][1] = max(merged[-1][1], his[i])
        else:
            merged.append([los[i], his[i]])
        member[i] = len(merged) - 1
    return merged, member


def _interpolate(values, rank):
    low = math.floor(rank)
    a, b = values[low], values[math.ceil(rank)]
    return a + (b - a) * (rank - low)


def exact_quantiles(df: DataFrame, columns, probs) -> dict[str, list[float | None]]:
    """Linear-interpolated exact quantiles of each column over its finite values.

    Returns driver-side metadata of size columns x probs. A first pass counts and sketches all columns
    at once; then only the values within a bracket of 4 / SKETCH_ACCURACY of the rows around each rank are
    counted, in slices, and searched. Where that share is less than a few rows the bracket takes all rows.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    if not columns:
        return {}
    clean = df.select(*[finite(c).alias(c) for c in columns])
    row = clean.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)], *_sketches(dict.fromkeys(columns, probs))).first()
    counts = {c: row[f"n_{i}"] for i, c in enumerate(columns)}
    filled = {c: probs for c in columns if counts[c]}
    found = _values_at(clean, {c: row[f"q_{columns.index(c)}"] for c in filled}, counts, filled) if filled else {}
    return {c: [_interpolate(found[c], p * (counts[c] - 1)) for p in probs] if c in found else [None] * len(probs) for c in columns}


def filled_quantiles(df: DataFrame, columns, probs) -> dict[str, tuple[float, list[float]]]:
    """Per column with a finite value its exact median, and the exact quantiles it has once all other values are replaced by
    the median.

    Filling puts copies of the median behind the lower half of the sorted values, so each rank of the filled
    column is a rank of the values or the median: the filled column is never sorted or even made. Three passes:
    count, sketch, search.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    clean = df.select(*[finite(c).alias(c) for c in columns])
    row = clean.agg(F.count("*").alias("_rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]).first()
    rows, counts = row["_rows"], {c: row[f"n_{i}"] for i, c in enumerate(columns) if row[f"n_{i}"]}
    if not counts:
        return {}
    places, asked = {}, {}
    for c, n in counts.items():
        lower, holes = (n - 1) // 2, rows - n
        places[c] = [[k if k <= lower else None if k <= lower + holes else k - holes for k in (math.floor(r), math.ceil(r))]
                     for r in (p * (rows - 1) for p in probs)]
        ranks = {k for pair in places[c] for k in pair if k is not None} | {lower, n // 2}
        asked[c] = [k / max(1, n - 1) for k in sorted(ranks)]
    sketch = clean.agg(*_sketches(asked)).first()
    found = _values_at(clean, {c: sketch[f"q_{i}"] for i, c in enumerate(asked)}, counts, asked)
    out = {}
    for c, n in counts.items():
        median = _interpolate(found[c], (n - 1) / 2)
        values = []
        for p, pair in zip(probs, places[c], strict=True):
            low, high = (median if k is None else found[c][k] for k in pair)
            values.append(low + (high - low) * (p * (rows - 1) - math.floor(p * (rows - 1))))
        out[c] = (median, values)
    return out


def _sketches(probs: dict[str, list[float]]):
    """Sketch aggregates that bracket the probabilities of each column."""
    margin = 2.0 / SKETCH_ACCURACY
    return [F.percentile_approx(c, double_array([max(0.0, p - margin) for p in own] + [min(1.0, p + margin) for p in own]), SKETCH_ACCURACY)
            .alias(f"q_{i}") for i, (c, own) in enumerate(probs.items())]


def _values_at(clean: DataFrame, sketches, counts, probs) -> dict[str, dict[int, float]]:
    """Per column, the values at the ranks around each of its probabilities."""
    spark, margin = clean.sparkSession, 2.0 / SKETCH_ACCURACY
    edges, targets = {}, []
    for i, (name, found) in enumerate(sketches.items()):
        few, own = counts[name] * margin < 4, probs[name]
        los = [-math.inf if few or p <= margin else v for p, v in zip(own, found[:len(own)])]
        his = [math.inf if few or p >= 1 - margin else v for p, v in zip(own, found[len(own):])]
        merged, member = _brackets(los, his)
        # cell 2k is the gap below interval k, cell 2k+1 the interval itself
        bounds = []
        for lo, hi in merged:
            bounds += [lo, math.nextafter(hi, math.inf)]
        edges[name] = bounds
        for p, where in zip(own, member):
            rank = p * (counts[name] - 1)
            for k in {math.floor(rank), math.ceil(rank)}:
                targets.append((i, 2 * where + 1, k))

    entries = []
    for i, (name, bounds) in enumerate(edges.items()):
        value, cell = F.col(name), F.col(f"{name}_cell")
        shift = 1 if bounds[0] == -math.inf else 0
        whole = not any(math.isfinite(b) for b in bounds)
        number = F.lit(1) if whole else (cell + F.lit(shift)).cast("int")
        entries.append(F.struct(F.lit(i).alias("variable"), number.alias("cell"),
                                F.when(number % 2 == 1, value).alias("value"), _slice(value, number, bounds).alias("slice"),
                                value.isNotNull().alias("present")))
    celled = with_buckets(clean, edges, "_cell")
    counted = (celled.select(F.inline(F.array(*entries))).where("present")
               .withColumn("bucket", F.col("cell") * SLICES + F.col("slice"))
               .groupBy("variable", "cell", "bucket", "value").agg(F.count("*").alias("n")))
    ranked = running_sums(counted, ["variable"], "bucket", "value", ["n"])
    wanted = spark.createDataFrame(sorted(set(targets)), "t_variable int, t_cell int, k bigint")
    hits = (ranked.where(F.col("value").isNotNull())
            .join(F.broadcast(wanted), (F.col("variable") == F.col("t_variable"))
                  & (F.col("cell") == F.col("t_cell"))
                  & (F.col("k") < F.col("cum_n")) & (F.col("k") >= F.col("cum_n") - F.col("n")))
            .select("variable", "k", "value").collect())
    by_variable: dict[int, dict[int, float]] = {}
    for hit in hits:
        by_variable.setdefault(hit["variable"], {})[hit["k"]] = hit["value"]
    return {name: by_variable[i] for i, name in enumerate(edges)}


def _slice(value, number, bounds):
    """Which of SLICES parts of equal width of its bracket a value falls into; 0 for open brackets."""
    lows, scales = [], []
    for low, high in zip(bounds[::2], bounds[1::2]):
        width = high - low
        closed = math.isfinite(width) and width > 1e-300
        lows.append(low if closed else 0.0)
        scales.append(SLICES / width if closed else 0.0)
    bracket = F.floor((number - 1) / 2).cast("int")
    part = F.floor((value - F.get(double_array(lows), bracket)) * F.get(double_array(scales), bracket))
    return F.when(number % 2 == 1, F.least(F.greatest(part, F.lit(0)), F.lit(SLICES - 1))).otherwise(0).cast("bigint")


def grouped_quantiles(df: DataFrame, keys, columns, probs) -> DataFrame:
    """Linear-interpolated exact quantiles of each column over its finite values, per combination of ``keys`` (NULL
    being a value of its own): keys, variable, prob, value. Groups without a value of a column have no rows for it.

    One pass sketches every column per group. Then all ranks of all groups are found together: values within a bracket around a
    rank are counted one by one, those between brackets only by the gap they lie in. The brackets hold 4 / SKETCH_ACCURACY
    of a group's rows for each rank, or all of a small group. Made for some tens of probabilities; the groups may
    be many and of any size.
    """
    keys, columns, probs = list(keys), list(columns), [float(p) for p in probs]
    margin = 2.0 / SKETCH_ACCURACY
    lows = double_array(max(0.0, p - margin) for p in probs)
    highs = double_array(min(1.0, p + margin) for p in probs)
    infinity = F.lit(math.inf)
    clean = df.select(key_text(keys).alias("_group"), *keys, *[finite(c).alias(c) for c in columns])
    sketch = clean.groupBy("_group").agg(*[F.struct(
        F.count(c).alias("n"), F.percentile_approx(c, lows, SKETCH_ACCURACY).alias("low"),
        F.percentile_approx(c, highs, SKETCH_ACCURACY).alias("high")).alias(c) for c in columns])

    def opened(name: str, unbounded, bound):  # brackets of few rows, or at an end, take all that is there
        return F.zip_with(f"found.{name}", F.array(*[F.lit(p) for p in probs]),
                          lambda v, p: F.when((F.col("found.n") * margin < 4) | unbounded(p), bound).otherwise(v))

    entries = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("found")) for c in columns])
    brackets = (sketch.select("_group", F.inline(entries)).where("found.n > 0")
                .select("_group", "variable", opened("low", lambda p: p <= margin, -infinity).alias("_low"),
                        opened("high", lambda p: p >= 1 - margin, infinity).alias("_high")))
    values = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in columns])
    long = lookup_join(clean.select("_group", *keys, F.inline(values)).where("value IS NOT NULL"), brackets, ["_group", "variable"], "inner")
    value = F.col("value")
    inside = F.exists(F.arrays_zip("_low", "_high"), lambda b: (b["_low"] <= value) & (value <= b["_high"]))
    cell = F.size(F.filter("_low", lambda b: b <= value)) + F.size(F.filter("_high", lambda b: b < value))
    counted = (long.select(*keys, "variable", cell.cast("long").alias("cell"), F.when(inside, value).alias("value"))
               .groupBy(*keys, "variable", "cell", "value").agg(F.count("*").alias("n")))
    ranked = running_sums(counted, [*keys, "variable"], "cell", "value", ["n"])
    spot = F.array(*[F.lit(p) for p in probs])
    ranks = F.transform(spot, lambda p: F.struct(p.alias("prob"), (p * (F.col("tot_n") - 1)).alias("rank")))
    sides = F.flatten(F.transform(ranks, lambda r: F.array(
        F.struct(r["prob"].alias("prob"), r["rank"].alias("rank"), F.floor(r["rank"]).alias("k"), F.lit(False).alias("upper")),
        F.struct(r["prob"].alias("prob"), r["rank"].alias("rank"), F.ceil(r["rank"]).alias("k"), F.lit(True).alias("upper")))))
    hits = (ranked.where("value IS NOT NULL")
            .select(*keys, "variable", "value", F.inline(F.filter(sides, lambda s: (s["k"] < F.col("cum_n")) & (s["k"] >= F.col("cum_n") - F.col("n"))))))
    found = hits.groupBy(*keys, "variable", "prob", "rank").agg(F.max(F.when(~F.col("upper"), F.col("value"))).alias("_a"),
                                                                F.max(F.when(F.col("upper"), F.col("value"))).alias("_b"))
    return found.select(*keys, "variable", "prob",
                        (F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("rank") - F.floor("rank"))).alias("value"))
