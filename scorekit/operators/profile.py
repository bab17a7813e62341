"""Feature profiling: missing ratio, weight of evidence, correlation, variance, redundancy."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorekit.functions.columns import bin_index, double_array, finite, numeric_columns, ratio, unpivot_structs
from scorekit.functions.order_stats import BUCKET, filled_quantiles, ordered_buckets, running_sums, with_buckets
from scorekit.functions.skew import hot_counts, spread_join
from scorekit.operators.metrics import feature_auc
from scorekit.session import LOOKUP_ROWS, stage

MISSING_LEVEL = "nan"
TILE = 64  # columns whose cross products with as many others travel together
PARTIALS = 2
RANK_CELLS = 1000  # ranges of values that a column is ranked in, about
EDGE_ROWS = 200_000  # rows from which the ends of the ranges are taken
SORTED_COLUMNS = 24  # columns of many values whose ranks travel in wide rows
DEALT = 4096  # parts of the rows that a sort has nothing to do with


# missing ratio -----------------------------------------------------------------------------------

def null_ratio(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(feature, null_ratio) for all columns from a single aggregation."""
    names = [c for c in df.columns if c not in set(exclude)]

    def missing(c):
        return finite(c).isNull() if c in numeric else F.col(c).isNull()
    numeric = set(numeric_columns(df))
    shares = df.agg(*[ratio(F.count_if(missing(c)), F.count("*")).alias(c) for c in names])
    return unpivot_structs(shares, [], [F.struct(F.lit(c).alias("feature"), F.col(c).alias("null_ratio"))
                                        for c in names])


def high_missing(df: DataFrame, target: str, threshold: float) -> list[str]:
    rows = null_ratio(df, [target]).where(F.col("null_ratio") > threshold).collect()
    found = {r["feature"] for r in rows}
    return [c for c in df.columns if c in found]


# weight of evidence ------------------------------------------------------------------------------

def _distinct(edges) -> list[float]:
    return sorted({e for e in edges if e is not None})


def woe_bins(df: DataFrame, target: str, numeric: Sequence[str] | None = None,
             categorical: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Counts, WoE and IV part of every bin of every variable.

    Numeric: median fill, then right-closed quantile bins. Others (text, boolean, date, timestamp): one
    bin per distinct value as text, missing being a value of its own. Counting is one map-side combined aggregation over the
    unpivoted (variable, bin) pairs; the input frame is left untouched.
    """
    numeric = list(numeric_columns(df, [target]) if numeric is None else numeric)
    if categorical is None:
        categorical = [c for c in df.columns if c != target and c not in set(numeric_columns(df, [target]))]
    y = F.col(target).cast("int")
    source = df.where(y.isin(0, 1)).select(
        y.alias("_y"), *[finite(c).alias(c) for c in numeric],
        *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LEVEL)).alias(c) for c in categorical])
    found = filled_quantiles(source, numeric, [i / bins for i in range(bins + 1)]) if numeric else {}
    numeric = [c for c in numeric if c in found]
    source = source.select([F.coalesce(F.col(c), F.lit(found[c][0])).alias(c) if c in found else F.col(c) for c in source.columns])
    edges = {c: _distinct(found[c][1]) for c in numeric}

    entries = []
    for c in numeric:
        entries.append(F.struct(F.lit(c).alias("variable"),
                                F.format_string("%04d", bin_index(F.col(c), edges[c][1:-1])).alias("bin")))
    for c in categorical:
        entries.append(F.struct(F.lit(c).alias("variable"), F.col(c).alias("bin")))
    cells = (unpivot_structs(source, ["_y"], entries).groupBy("variable", "bin")
             .agg(F.count("*").alias("n"), F.sum("_y").alias("events")))
    # one row per variable: bounded by the width of the schema
    totals = cells.groupBy("variable").agg(F.sum("events").alias("_events"),
                                           F.sum(F.col("n") - F.col("events")).alias("_others"))
    share1 = ratio(F.greatest(F.col("events").cast("double"), F.lit(0.5)), F.col("_events"))
    share0 = ratio(F.greatest((F.col("n") - F.col("events")).cast("double"), F.lit(0.5)),
                   F.col("_others"))
    return (cells.join(F.broadcast(totals), "variable")
            .select("variable", "bin", "n", "events", share1.alias("event_share"),
                    (F.col("n") - F.col("events")).alias("non_events"),
                    share0.alias("non_event_share"))
            .withColumn("woe", F.log(ratio(F.col("non_event_share"), F.col("event_share"))))
            .withColumn("iv", F.col("woe") * (F.col("non_event_share") - F.col("event_share"))))


def information_value(df: DataFrame, target: str, numeric: Sequence[str] | None = None,
                      categorical: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    return (woe_bins(df, target, numeric, categorical, bins)
            .groupBy("variable").agg(F.sum("iv").alias("iv")))


# correlation -------------------------------------------------------------------------------------

def _corr_by_blocks(df: DataFrame, columns: Sequence[str], weight: str | None = None,
                    centre: Sequence[float] | None = None, group: str | None = None) -> DataFrame:
    """Every task reduces its rows to pairwise-complete cross products (centred for stability, by default
    on the means), in tiles of TILE by TILE columns. A tile is a packed row; those of all tasks are added up, tile by tile.
    At most PARTIALS tasks a core make them, so what is shuffled does not grow with the input. A task holds 32 bytes per pair
    of columns. ``weight`` counts a row several times. With ``group``, a text of few values, there are pairs of
    each group."""
    k = len(columns)
    times = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    groups = F.lit("") if group is None else F.coalesce(F.col(group).cast("string"), F.lit(""))
    clean = df.select(*[finite(c).alias(c) for c in columns], times.alias("_times"), groups.alias("_group"))
    if centre is None:
        first = clean.agg(*[F.avg(c).alias(c) for c in columns]).first()
        centre = [0.0 if first[c] is None else first[c] for c in columns]
    centre = np.array(centre)
    blocks = [np.arange(at, min(at + TILE, k)) for at in range(0, k, TILE)]

    def tile(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Column pairs of two blocks, the later column first."""
        i, j = (x.ravel() for x in np.meshgrid(blocks[a], blocks[b], indexing="ij"))
        return i[i > j], j[i > j]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_group: dict[str, np.ndarray] = {}
        for batch in batches:
            data = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float)
                                    for c in range(k)])
            seen = (~np.isnan(data)).astype(float)
            x = np.where(seen > 0, data - centre, 0.0)
            often = seen * batch.column(k).to_numpy(zero_copy_only=False)[:, None]
            names = np.array(batch.column(k + 1).to_pylist(), object)
            for name in set(names):
                rows = names == name
                sums = by_group.setdefault(name, np.zeros((4, k, k)))
                sums[0] += seen[rows].T @ often[rows]
                sums[1] += x[rows].T @ often[rows]
                sums[2] += (x[rows] * x[rows]).T @ often[rows]
                sums[3] += x[rows].T @ (x[rows] * often[rows])
        for name, (n, s, ss, sp) in by_group.items():
            for a in range(len(blocks)):
                for b in range(a + 1):
                    i, j = tile(a, b)
                    if len(i):
                        packed = np.concatenate([n[i, j], s[i, j], s[j, i], ss[i, j], ss[j, i], sp[i, j]])
                        yield pa.RecordBatch.from_pydict({"g": pa.array([name], pa.string()), "a": pa.array([a], pa.int32()),
                                                          "b": pa.array([b], pa.int32()), "sums": pa.array([packed])})

    def total_of(table: pa.Table) -> pa.Table:
        name, a, b = (table.column(c)[0].as_py() for c in range(3))
        i, j = tile(a, b)
        packed = sum(part.values.to_numpy() for part in table.column(3)).reshape(6, -1)
        return pa.table([pa.array([name] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                         *[pa.array(row) for row in packed]], names=["g", "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    tasks = PARTIALS * df.sparkSession.sparkContext.defaultParallelism
    total = (clean.coalesce(tasks).mapInArrow(partial, "g string, a int, b int, sums array<double>").groupBy("g", "a", "b")
             .applyInArrow(total_of, "g string, i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"))
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    # a column whose spread is rounding noise around its mean counts as constant
    noise = F.lit([float(c * 1e-10) ** 2 for c in centre])
    squares = F.col("n") * F.col("n")
    moving = (vx > squares * F.get(noise, F.col("i"))) & (vy > squares * F.get(noise, F.col("j")))
    spread = F.when(moving, F.sqrt(vx) * F.sqrt(vy))
    labels = F.array(*[F.lit(c) for c in columns])
    return total.select(*([] if group is None else [F.col("g").alias(group)]), F.get(labels, F.col("i")).alias("feature_1"),
                        F.get(labels, F.col("j")).alias("feature_2"), ratio(cov, spread).alias("r"))


def pearson_pairs(df: DataFrame, columns: Sequence[str] | None = None, target: str | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair (later column first)."""
    columns = list(numeric_columns(df, [target]) if columns is None else columns)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, r double")
    return _corr_by_blocks(df, columns)


def correlated_pairs(df: DataFrame, threshold: float = 0.8, columns: Sequence[str] | None = None,
                     target: str | None = None) -> DataFrame:
    return pearson_pairs(df, columns, target).where(F.abs("r") > threshold)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form, diagonal included."""
    pairs = pearson_pairs(df, columns)
    mirrored = pairs.select(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "r")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns],
                                               "feature_1 string, feature_2 string, r double")
    return pairs.unionByName(mirrored).unionByName(diagonal)


def correlation_matrices(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """The symmetric matrix of every value of ``group`` (a text of few values, null being the empty one), from one pass."""
    fields = f"{group} string, feature_1 string, feature_2 string, r double"
    pairs = (_corr_by_blocks(df, columns, group=group) if len(columns) > 1 else df.sparkSession.createDataFrame([], fields))
    mirrored = pairs.select(group, F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "r")
    names = F.explode(F.array(*[F.lit(c) for c in columns]))
    diagonal = (df.select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias(group)).distinct().select(group, names.alias("feature_1"))
                .select(group, "feature_1", F.col("feature_1").alias("feature_2"), F.lit(1.0).alias("r")))
    return pairs.unionByName(mirrored).unionByName(diagonal)


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) with the sample variance of every column, one aggregation."""
    row = df.agg(*[F.var_samp(finite(c)).alias(c) for c in columns])
    return unpivot_structs(row, [], [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"))
                                     for c in columns])


def keep_better(pairs: DataFrame, quality: DataFrame) -> DataFrame:
    """For each pair the feature to drop: the one of lower quality, the second on ties. Both inputs
    are bounded by the number of columns."""
    q1 = quality.select(F.col("feature").alias("feature_1"), F.col("value").alias("value_1"))
    q2 = quality.select(F.col("feature").alias("feature_2"), F.col("value").alias("value_2"))
    return (pairs.join(F.broadcast(q1), "feature_1").join(F.broadcast(q2), "feature_2")
            .select("feature_1", "feature_2", "value_1", "value_2",
                    F.when(F.col("value_1") >= F.col("value_2"), F.col("feature_2"))
                    .otherwise(F.col("feature_1")).alias("drop_feature")))


def drop_by_variance(df: DataFrame, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    return keep_better(pairs, variances(df, columns))


def drop_by_auc(df: DataFrame, pairs: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return keep_better(pairs, feature_auc(df, columns, target).withColumnRenamed("auc", "value"))


# ranks -------------------------------------------------------------------------------------------

def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, avg_rank): the tie-averaged rank of every distinct value of every column."""
    entries = [F.struct(F.lit(c).alias("feature"), finite(c).alias("value")) for c in columns]
    counted = (unpivot_structs(df, [], entries).where(F.col("value").isNotNull())
               .groupBy("feature", "value").agg(F.count("*").alias("n")))
    placed = running_sums(ordered_buckets(counted, ["feature"], "value"), ["feature"], BUCKET, "value", ["n"])
    return placed.select("feature", "value",
                         (F.col("cum_n") - (F.col("n") - 1) / 2).alias("avg_rank"))


def _rank_cells(clean: DataFrame, columns: Sequence[str], rows: int) -> dict[str, list[float]]:
    """Per column, ascending edges of cells that hold about equally many rows. A value that several of them would end
    at gets a cell of its own. They come from a sample: where they lie decides how evenly tasks are loaded, never a rank."""
    cells = max(16, min(RANK_CELLS, LOOKUP_ROWS // len(columns)))
    some = clean if rows <= EDGE_ROWS else clean.sample(EDGE_ROWS / rows, seed=1)
    probs = double_array(i / cells for i in range(1, cells))
    found = some.agg(*[F.percentile_approx(c, probs, 10 * cells).alias(c) for c in columns]).first()
    edges = {}
    for c in columns:
        ends = found[c] or []
        often = {math.nextafter(a, math.inf) for a, b in zip(ends, ends[1:]) if a == b}
        edges[c] = sorted(e for e in {*ends, *often} if math.isfinite(e)) or [0.0]
    return edges


def _wide_ranks(clean: DataFrame, columns: Sequence[str], edges: dict[str, list[float]]) -> DataFrame | None:
    """The rows with every value replaced by its tie-averaged rank; None where more than SORTED_COLUMNS need sorting.

    One pass counts the cells of all columns. That gives the rank of a value that has a cell to itself; the others are ranked
    among the rows of their cell, each column in one shuffle of the rows.
    """
    numbers = [F.struct(F.lit(i).alias("i"), F.col(f"{c}_cell").cast("int").alias("cell")) for i, c in enumerate(columns)]
    counted = unpivot_structs(with_buckets(clean, edges, "_cell"), [], numbers).groupBy("i", "cell").count().collect()
    counts = {(r["i"], r["cell"]): r["count"] for r in counted}
    before, alone, sort = {}, {}, []
    for i, c in enumerate(columns):
        sizes = np.array([counts.get((i, cell), 0) for cell in range(len(edges[c]) + 1)], float)
        lone = np.array([False, *[b == math.nextafter(a, math.inf) for a, b in zip(edges[c], edges[c][1:])], False])
        before[c] = np.cumsum(sizes) - sizes
        alone[c] = np.where(lone, before[c] + (sizes + 1) / 2, -1.0)
        if sizes[~lone].any():
            sort.append(c)
    if len(sort) > SORTED_COLUMNS:
        return None
    for c in sorted(columns, key=lambda c: c in sort):
        cell = F.col("_cell").cast("int")
        known, absent = F.get(double_array(alone[c]), cell), cell > len(edges[c])
        clean = with_buckets(clean, {c: edges[c]}, "_cell").withColumnRenamed(f"{c}_cell", "_cell")
        if c in sort:
            dealt = -1 - F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(DEALT)).cast("int")
            order = Window.partitionBy("_key").orderBy(c)
            upto = F.count("*").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
            clean = clean.withColumn("_key", F.when(absent | (known >= 0), dealt).otherwise(cell))
            inside = F.get(double_array(before[c]), cell) + (F.rank().over(order) + upto) / 2
        else:
            inside = F.lit(None).cast("double")
        clean = clean.withColumn(c, F.when(absent, None).when(known >= 0, known).otherwise(inside)).select(*columns)
    return clean


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spearman correlation of every pair: tie-averaged ranks over each column's own values, then
    pairwise-complete Pearson.

    Columns of few values take their ranks from counts; each other one is ranked in one shuffle of the rows. Where
    those are more than SORTED_COLUMNS, ranks travel in long form instead.
    """
    names = [f"_r{i}" for i in range(len(columns))]
    # adding zero gives zero one sign
    clean = df.select(*[(finite(c) + F.lit(0.0)).alias(n) for n, c in zip(names, columns)])
    sizes = clean.agg(*[F.count(n).alias(n) for n in names]).first()
    ranks = _wide_ranks(clean, names, _rank_cells(clean, names, max(sizes)))
    # the mean rank of n values is (n + 1) / 2, which saves a pass over the ranks
    centre = [(sizes[n] + 1) / 2 for n in names]
    if ranks is None:
        return _corr_by_blocks(_joined_ranks(df, columns), columns, "_times", centre)
    return _corr_by_blocks(ranks.toDF(*columns), columns, None, centre)


def _joined_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows, how often they occur (_times), and the ranks in place of their values.

    Equal rows are merged into one with a weight, so 128 hash bits of its values identify a row. Ranks travel
    once in long form - (row, feature, value) meets (feature, value) - and return to wide form by
    row, whatever the number of columns.
    """
    merged = (df.select(*[finite(c).alias(c) for c in columns]).groupBy(*columns)
              .agg(F.count("*").alias("_times")))
    present = [F.col(c).isNotNull() for c in columns]
    values = [F.coalesce(F.col(c), F.lit(0.0)) for c in columns]
    row = F.struct(F.xxhash64(*values, *present), F.xxhash64(F.lit(1), *values, *present))
    entries = [F.struct(F.lit(i).alias("_i"), F.col(c).alias("_value")) for i, c in enumerate(columns)]
    long = (unpivot_structs(stage(merged.withColumn("_row", row), "merged-rows"), ["_row", "_times"], entries)
            .where(F.col("_value").isNotNull()))
    counted = ordered_buckets(long.groupBy("_i", "_value").agg(F.sum("_times").alias("n")), ["_i"], "_value")
    ranks = (running_sums(counted, ["_i"], BUCKET, "_value", ["n"])
             .select("_i", "_value", (F.col("cum_n") - (F.col("n") - 1) / 2).alias("_rank")))
    keys = ["_i", "_value"]
    return (spread_join(long.select("_row", "_times", *keys), ranks, keys, "inner", hot_counts(counted, keys, "n"))
            .groupBy("_row").agg(F.max("_times").alias("_times"),
                                 *[F.max(F.when(F.col("_i") == i, F.col("_rank"))).alias(c)
                                   for i, c in enumerate(columns)]))


def smart_correlated_drops(df: DataFrame, features: Sequence[str], target: str,
                           threshold: float = 0.8) -> DataFrame:
    """Group features whose Spearman correlation exceeds the threshold and keep, per group, the one
    with the best univariate AUC.

    Groups are formed in feature order: an unassigned feature opens a group with all unassigned
    features correlated to it. Only the list of correlated pairs reaches the driver.
    """
    strong = spearman_pairs(df, features).where(F.abs("r") > threshold).collect()
    linked: dict[str, set[str]] = {f: set() for f in features}
    for r in strong:
        linked[r["feature_1"]].add(r["feature_2"])
        linked[r["feature_2"]].add(r["feature_1"])
    groups, seen = [], set()
    for f in features:
        if f in seen:
            continue
        members = [f, *[g for g in features if g in linked[f] and g not in seen and g != f]]
        if len(members) > 1:
            seen.update(members)
            groups.append(members)
    involved = [f for members in groups for f in members]
    quality = ({r["feature"]: r["auc"] for r in feature_auc(df, involved, target).collect()}
               if involved else {})
    rows = []
    for number, members in enumerate(groups, 1):
        best = max(members, key=lambda f: (quality[f] if quality[f] is not None else 0.0))
        rows += [(number, f, float(quality[f] or 0.0), f != best) for f in members]
    return df.sparkSession.createDataFrame(
        rows, "correlation_group int, feature string, auc double, dropped boolean")


# relevance ---------------------------------------------------------------------------------------

def f_statistic(df: DataFrame, features: Sequence[str], target: str,
                missing: float = -99999.0) -> DataFrame:
    """One-way ANOVA F of every feature against the binary target, from one aggregation of count,
    sum and squared deviation by class."""
    y = F.col(target).cast("int")
    source = df.where(y.isin(0, 1)).select(
        y.alias("_y"), *[F.coalesce(finite(c), F.lit(missing)).alias(c) for c in features])
    sums = source.groupBy("_y").agg(
        F.count("*").cast("double").alias("n"),
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
        *[F.var_pop(c).alias(f"v_{i}") for i, c in enumerate(features)])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"m_{i}").alias("m"), F.col(f"v_{i}").alias("v"))
               for i, c in enumerate(features)]
    long = unpivot_structs(sums, ["n"], entries)
    total = long.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("within"),
        F.max("n").alias("n1"), F.min("n").alias("n2"),
        F.max("m").alias("hi"), F.min("m").alias("lo"), F.count("*").alias("classes"))
    between = F.col("n1") * F.col("n2") / F.col("n") * F.pow(F.col("hi") - F.col("lo"), F.lit(2))
    return total.select("feature", F.when(F.col("classes") == 2,
                        ratio(between, ratio(F.col("within"), F.col("n") - 2))).alias("f"))


def mrmr_ranking(df: DataFrame, features: Sequence[str], target: str, k: int,
                 missing: float = -99999.0) -> list[str]:
    """Greedy maximum relevance / minimum redundancy: F statistic minus mean absolute correlation
    with the chosen ones, as a quotient. The greedy loop runs on the k x k matrix only."""
    filled = df.select(target, *[F.coalesce(finite(c), F.lit(missing)).alias(c) for c in features])
    relevance = {r["feature"]: r["f"] or 0.0 for r in f_statistic(filled, features, target).collect()}
    index = {f: i for i, f in enumerate(features)}
    redundancy = np.zeros((len(features), len(features)))
    for r in pearson_pairs(filled, features).collect():
        i, j = index[r["feature_1"]], index[r["feature_2"]]
        redundancy[i, j] = redundancy[j, i] = abs(r["r"] or 0.0)
    chosen: list[str] = []
    while len(chosen) < min(k, len(features)):
        picked = [index[c] for c in chosen]

        def merit(f):
            mean = redundancy[index[f], picked].mean() if picked else 1.0
            return relevance[f] / max(mean, 1e-3)
        chosen.append(max((f for f in features if f not in chosen), key=merit))
    return chosen


def frequency_table(df: DataFrame, column: str, min_count: int = 40) -> DataFrame:
    """Values occurring strictly more often than ``min_count``."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count("*").alias("n")).where(F.col("n") > min_count))
