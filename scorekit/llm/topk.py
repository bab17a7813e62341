"""Exact top-k search by the three-phase uniform threshold.

Vectors are cut into ``parts`` runs of components. A part's list of a query holds the inner products of the
query's run with that run of every vector; a score is the sum over the parts' lists.

1. Every part gives its k best entries per query. The k-th best exact score among the vectors named is a
   lower bound of the k-th best of all.
2. That bound divided by the number of parts is the cutoff of every list: a vector that is below it in all
   parts is below the bound. All entries at or above the cutoff are gathered. A vector seen in some parts
   only is bounded from above by the cutoff in the others; those below the k-th best known score go.
3. The scores of what is left are resolved exactly.

Equal vectors are one class with its k + 1 smallest ids (one may be the query's own), so large groups of
copies cost one vector. Work is dealt as blocks of queries against blocks of vectors, one part at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import bucket_of, stage

PARTS = 2
QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
SCALE = 256
LARGEST = 2.0 ** 60  # squared length from which products may not fit a long
EXACT = 2.0 ** 53  # integers below it are exact in float64
ENTRIES = "query string, class string, part int, partial long"


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a long array. Null for vectors that are null, hold a null or
    non-finite component, or are so long (2^30 after scaling) that inner products may not fit a long."""
    square = F.aggregate(F.transform(vector, lambda x: F.pow(x.cast("double") * scale, F.lit(2.0))), F.lit(0.0), lambda s, x: s + x)
    usable = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.when(vector.isNotNull() & usable & (square < LARGEST), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: in float64 where no sum can leave its integers, else in int64."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    longest = np.sqrt((x * x).sum(axis=1).max(initial=0) * (y * y).sum(axis=1).max(initial=0))
    return (x @ y.T).astype(np.int64) if longest < EXACT / 2 else a @ b.T


def _blocks(classes: DataFrame, queries: DataFrame, parts: int):
    """Runs of both sides, as groups (part, length, query block, vector block)."""
    sizes = (classes.agg(F.count("*")).first()[0], queries.agg(F.count("*")).first()[0])
    vector_blocks, query_blocks = max(1, -(-sizes[0] // VECTOR_BLOCK)), max(1, -(-sizes[1] // QUERY_BLOCK))
    length = F.size("vector")
    run = lambda p: F.slice(F.col("vector"), F.floor(length * p / parts).cast("int") + 1,
                            (F.floor(length * (p + 1) / parts) - F.floor(length * p / parts)).cast("int"))
    runs = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), run(p).alias("run")) for p in range(parts)]))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (queries.withColumn("r", runs).withColumn("length", length).withColumn("qb", bucket_of(query_blocks, "class"))
            .withColumn("vb", every(vector_blocks)).select("length", "r.part", "qb", "vb", "class", "r.run", "cutoff"))
    right = (classes.withColumn("r", runs).withColumn("length", length).withColumn("vb", bucket_of(vector_blocks, "class"))
             .withColumn("qb", every(query_blocks)).select("length", "r.part", "qb", "vb", "class", "r.run"))
    group = ["length", "part", "qb", "vb"]
    return left.groupBy(*group).cogroup(right.groupBy(*group))


def _scan(classes: DataFrame, queries: DataFrame, parts: int, pick) -> DataFrame:
    """Entries (query, class, part, partial) that ``pick`` chooses from each block of products. A class is
    no candidate of its own queries here; its members' scores are known."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"query": pa.array([], pa.string()), "class": pa.array([], pa.string()),
                 "part": pa.array([], pa.int32()), "partial": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        products = _products(_matrix(left.column("run")), _matrix(right.column("run")))
        ours, theirs = np.array(left.column("class").to_pylist()), np.array(right.column("class").to_pylist())
        other = ours[:, None] != theirs[None, :]
        i, j = np.nonzero(pick(products, other, left.column("cutoff").to_pylist()) & other)
        return pa.table({"query": ours[i], "class": theirs[j], "part": pa.array([left.column("part")[0].as_py()] * len(i), pa.int32()),
                         "partial": products[i, j]})

    return _blocks(classes, queries, parts).applyInArrow(work, ENTRIES)


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """(query, bound): the k-th best score, null with fewer."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    return (scores.withColumn("place", place).where(F.col("place") == k).select("query", F.col("score").alias("bound")))


def _resolve(pairs: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact scores of (query, class) pairs."""
    q = queries.select(F.col("class").alias("query"), F.col("vector").alias("x"))
    c = classes.select("class", F.col("vector").alias("y"))
    return pairs.join(q, "query").join(c, "class").select("query", "class", _dot("x", "y").alias("score"))


def search(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
           parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """The k best rows for each query row: query_id, rank (from 1), vec_id, score (long); ties to the smaller
    id; fewer rows if there are fewer candidates. ``is_query`` is a condition on the column ``id``.

    Candidates are all rows but those with the query's own id, whose vectors have the query's length. Rows
    whose id is null or whose vector cannot be quantized take no part. Rows that share an id are candidates like others; of a
    query id with several rows, the list has the best of all its rows' candidates, once for each pair of rows.
    Other columns are not read. An empty table gives no rows.
    """
    rows = vectors.select(F.col(key).alias("id"), quantized(F.col(vector), scale).alias("vector")).dropna()
    rows = rows.groupBy("id", "vector").agg(F.least(F.count("*"), F.lit(k)).alias("times"))  # more than k of a kind are not needed
    rows = stage(rows.withColumn("class", F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")).cast("binary"))),
                 "topk-rows")
    # a query's own id may stand in so many classes besides its own, of which none counts
    own_classes = (rows.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1) - 1
    wanted = k + own_classes
    place = F.row_number().over(Window.partitionBy("class").orderBy("id"))
    classes = stage(rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("class")
                    .agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list(F.struct("id", "times"))).alias("ids")), "topk-classes")
    asked = rows.where(is_query).select("id", "class", "times")
    queries = stage(classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "vector"),
                    "topk-queries")

    def best(products: np.ndarray, other: np.ndarray, cutoff: list) -> np.ndarray:
        masked = np.where(other, products, -np.inf)  # rounded, but which ones are named does not matter
        if products.shape[1] <= wanted:
            return np.isfinite(masked)
        edge = np.partition(masked, -wanted, axis=1)[:, -wanted]
        chosen = masked > edge[:, None]
        for i in np.flatnonzero(chosen.sum(axis=1) < wanted).tolist():  # any of the ties will do for a bound
            chosen[i, np.flatnonzero(masked[i] == edge[i])[:wanted - chosen[i].sum()]] = True
        return chosen

    lists = _scan(classes, queries.withColumn("cutoff", F.lit(None).cast("long")), parts, best)
    place = F.row_number().over(Window.partitionBy("query", "part").orderBy(F.desc("partial"), "class"))
    named = lists.withColumn("place", place).where(F.col("place") <= wanted).select("query", "class").distinct()
    first = stage(_kth(_resolve(named, queries, classes), wanted), "topk-bound")

    def above(products: np.ndarray, other: np.ndarray, cutoff: list) -> np.ndarray:
        least = np.array([np.iinfo(np.int64).min if c is None else -(-c // parts) for c in cutoff])  # no cutoff: all
        return products >= least[:, None]

    bounded = queries.join(first.withColumnRenamed("query", "class"), "class", "left").withColumnRenamed("bound", "cutoff")
    seen = stage(_scan(classes, bounded, parts, above).groupBy("query", "class")
                 .agg(F.sum("partial").alias("known"), F.count("*").alias("lists")), "topk-entries")
    whole = seen.where(F.col("lists") == parts).select("query", "class", F.col("known").alias("score"))
    second = _kth(whole, wanted).withColumnRenamed("bound", "better")
    # a list without the vector gives it less than the cutoff
    most = F.col("known") + (parts - F.col("lists")) * F.ceil(F.col("bound") / parts)
    open_ = (seen.where(F.col("lists") < parts).join(first, "query", "left").join(second, "query", "left")
             .where(F.coalesce(most >= F.greatest("bound", "better"), F.lit(True))).select("query", "class"))
    resolved = whole.unionByName(_resolve(open_, queries, classes))
    own = queries.select(F.col("class").alias("query"), "class", _dot("vector", "vector").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    # k rows that are not the query's own, whichever rows those are
    answers = (resolved.unionByName(own).join(classes.select("class", "ids"), "class")
               .select("query", "score", F.inline("ids")).withColumn("place", place).where(F.col("place") <= wanted + 1).drop("place"))
    met = (asked.select(F.col("id").alias("query_id"), F.col("class").alias("query"), F.col("times").alias("rows")).join(answers, "query")
           .where(F.col("id") != F.col("query_id"))
           .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(k), F.col("rows") * F.col("times"))))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (met.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
