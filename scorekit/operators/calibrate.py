"""Score calibration: isotonic, sigmoid and quantile transform."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import as_column, double_array, finite
from scorekit.functions.order_stats import BUCKET, BUCKET_VALUES, exact_quantiles, ordered_buckets, surrounding
from scorekit.functions.skew import spread_join
from scorekit.session import stage

SEARCHED_POINTS = 2000  # points of a curve that a row searches itself
POOLING_ROUNDS = 30  # rounds in which whole runs of blocks are pooled


@dataclass(frozen=True)
class StepCurve:
    """Piecewise-linear map through the stored points (x, y), constant outside and clipped to [low, high].

    Curves of few points are searched by every row on its own. Longer ones meet the distinct probabilities in
    order-preserving buckets, and the rows look their probability up.
    """

    points: DataFrame
    low: float | None
    high: float | None

    def transform(self, df: DataFrame, probability: str, name: str = "calibrated_prob", searched: int = SEARCHED_POINTS) -> DataFrame:
        few = self.points.orderBy("x").limit(searched + 1).collect()
        if not few:
            return df.withColumn(name, F.lit(None).cast("double"))
        if len(few) <= searched:
            xs, ys = [r["x"] for r in few], [r["y"] for r in few]
            value = _interpolated(F.col(probability), xs, ys)
            return _position(df, probability, xs).withColumn(name, self._clipped(value)).drop("_pos")
        keyed = df.withColumn("_x", finite(probability))
        around = surrounding(keyed.select(F.col("_x").alias("x")).where("x IS NOT NULL").distinct(), self.points)
        rise = (F.col("y1") - F.col("y0")) * (F.col("x") - F.col("x0")) / (F.col("x1") - F.col("x0"))
        value = F.when(F.col("x0").isNull(), F.col("y1")).when(F.col("x1").isNull() | (F.col("x0") == F.col("x1")), F.col("y0")) \
            .otherwise(F.col("y0") + rise)
        found = around.select(F.col("x").alias("_x"), self._clipped(value).alias(name))
        return spread_join(keyed.drop(name), found, ["_x"]).drop("_x")

    def _clipped(self, value):
        return F.when(value.isNotNull(), F.greatest(F.lit(self.low), F.least(F.lit(self.high), value)))


def _position(df: DataFrame, column: str, points: list[float]) -> DataFrame:
    """Add ``_pos``, the index of the last point not above the value (-1 below all), by binary search."""
    if len(points) == 1:
        return df.withColumn("_pos", F.when(F.col(column) >= points[0], 0).otherwise(-1))
    clean = df.withColumn("_x", finite(column))
    spot = Bucketizer(inputCol="_x", outputCol="_pos", handleInvalid="keep",
                      splits=[-float("inf"), *points, float("inf")]).transform(clean)
    return spot.withColumn("_pos", F.when(F.col("_x").isNotNull(), F.col("_pos").cast("int") - 1)).drop("_x")


def _interpolated(x, points, values):
    xs, ys = double_array(points), double_array(values)
    pos, last = F.col("_pos"), len(points) - 1
    x0, x1 = F.get(xs, pos), F.get(xs, pos + 1)
    y0, y1 = F.get(ys, pos), F.get(ys, pos + 1)
    return (F.when(pos < 0, F.lit(values[0])).when(pos >= last, F.lit(values[-1]))
            .otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0)))


BLOCK = "_bucket long, low double, high double, total double, weight double"


def _pooled(table: pa.Table) -> pa.Table:
    """Blocks of one bucket in ascending order, adjacent ones pooled while their means do not ascend: runs of them at a
    time first, what is left one by one."""
    table = table.sort_by("low")
    bucket = table.column(0)[0].as_py()
    lows, highs, totals, weights = (table.column(k).to_numpy() for k in range(1, 5))
    for _ in range(POOLING_ROUNDS):
        starts = np.flatnonzero(np.r_[True, totals[:-1] * weights[1:] < totals[1:] * weights[:-1]])
        if len(starts) == len(lows):
            break
        lows, highs = lows[starts], highs[np.r_[starts[1:], len(highs)] - 1]
        totals, weights = np.add.reduceat(totals, starts), np.add.reduceat(weights, starts)
    blocks: list[list[float]] = []
    for low, high, total, weight in zip(*(x.tolist() for x in (lows, highs, totals, weights)), strict=True):
        while blocks and blocks[-1][2] * weight >= total * blocks[-1][3]:
            low, _, before, more = blocks.pop()
            total, weight = total + before, weight + more
        blocks.append([low, high, total, weight])
    columns = [[bucket] * len(blocks), *map(list, zip(*blocks, strict=True))]
    return pa.table(columns, names=["_bucket", "low", "high", "total", "weight"])


def fit_isotonic(df: DataFrame, probability: str, target: str, most: int = BUCKET_VALUES, merged: int = 16) -> StepCurve:
    """Isotonic fit of the target on the probability, clipped to the probability's own range. Rows that lack
    either are left out; without any the curve is empty.

    Equal probabilities are merged into weighted means first. Adjacent violators are then pooled inside
    order-preserving buckets, and level by level in ``merged`` neighbouring buckets together: pooling parts first
    does not change the fit. A task holds the blocks that are left of its part, and the points stay a stored table.
    A fit of n rows with 0/1 targets leaves at most in the order of n^(2/3) blocks, usually a few hundred.
    """
    counted = (df.select(finite(probability).alias("low"), F.col(target).cast("double").alias("y"))
               .groupBy("low").agg(F.sum("y").alias("total"), F.count("y").cast("double").alias("weight")))
    stored = ordered_buckets(counted.where(F.col("low").isNotNull()), [], "low", most)
    span = stored.agg(F.min("low").alias("low"), F.max("low").alias("high")).first()
    blocks = stored.where("weight > 0").select(BUCKET, "low", F.col("low").alias("high"), "total", "weight")
    buckets = stored.agg(F.max(BUCKET)).first()[0] or 0
    while True:
        blocks = blocks.groupBy(BUCKET).applyInArrow(_pooled, BLOCK)
        if buckets == 0:
            break
        blocks, buckets = stage(blocks, "isotonic").withColumn(BUCKET, F.floor(F.col(BUCKET) / merged)), buckets // merged
    mean = F.col("total") / F.col("weight")
    ends = F.array_distinct(F.array("low", "high"))
    return StepCurve(stage(blocks.select(F.explode(ends).alias("x"), mean.alias("y")), "isotonic"), span["low"], span["high"])


@dataclass(frozen=True)
class Sigmoid:
    """p -> 1 / (1 + exp(-(slope * f + intercept))) on the model output f."""

    slope: float
    intercept: float

    def transform(self, df: DataFrame, output: str, name: str = "calibrated_prob") -> DataFrame:
        z = F.lit(self.slope) * finite(output) + F.lit(self.intercept)
        return df.withColumn(name, 1 / (1 + F.exp(-z)))


def fit_sigmoid(df: DataFrame, output: str, target: str) -> Sigmoid:
    """Platt scaling with the usual soft targets, expressed as two weighted copies per distinct
    (output, class) pair and fitted by unregularised logistic regression."""
    y = F.col(target).cast("int")
    counted = (df.select(finite(output).alias("f"), y.alias("y")).where(F.col("f").isNotNull() & y.isin(0, 1))
               .groupBy("f", "y").agg(F.count("*").cast("double").alias("n")))
    sizes = {r["y"]: r["n"] for r in counted.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    positive = (sizes.get(1, 0.0) + 1) / (sizes.get(1, 0.0) + 2)
    negative = 1 / (sizes.get(0, 0.0) + 2)
    soft = F.when(F.col("y") == 1, F.lit(positive)).otherwise(F.lit(negative))
    copies = counted.select("f", F.inline(F.array(
        F.struct(F.lit(1.0).alias("label"), (soft * F.col("n")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), ((1 - soft) * F.col("n")).alias("weight")))))
    data = VectorAssembler(inputCols=["f"], outputCol="features").transform(copies)
    model = LogisticRegression(weightCol="weight", regParam=0.0, maxIter=200, tol=1e-10,
                               standardization=True).fit(data)
    return Sigmoid(float(model.coefficients[0]), float(model.intercept))


@dataclass(frozen=True)
class QuantileTransform:
    """Score to its uniform position on the training distribution; a tied landmark maps to the middle
    of its positions."""

    points: list[float]
    first: list[float]
    last: list[float]

    def transform(self, df: DataFrame, column: str, name: str = "calibrated_prob") -> DataFrame:
        x = as_column(column)
        pos, end = F.col("_pos"), len(self.points) - 1
        xs, lo, hi = double_array(self.points), double_array(self.first), double_array(self.last)
        x0, x1 = F.get(xs, pos), F.get(xs, pos + 1)
        y0, y1 = F.get(hi, pos), F.get(lo, pos + 1)
        inside = (F.when(x == x0, (F.get(lo, pos) + F.get(hi, pos)) / 2)
                  .otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0)))
        value = (F.when(x.isNull(), None).when(x <= self.points[0], F.lit(0.0))
                 .when(pos >= end, F.lit(1.0)).otherwise(inside))
        return _position(df, column, self.points).withColumn(name, value).drop("_pos")


def fit_quantile_transform(df: DataFrame, column: str, landmarks: int = 1000) -> QuantileTransform:
    """Exact landmarks over all rows at evenly spaced positions."""
    steps = [i / (landmarks - 1) for i in range(landmarks)]
    found = exact_quantiles(df, [column], steps)[column]
    first: dict[float, float] = {}
    last: dict[float, float] = {}
    for step, value in zip(steps, found):
        first.setdefault(value, step)
        last[value] = step
    return QuantileTransform(list(first), list(first.values()), list(last.values()))
