"""Quality classifier: a linear support vector machine over naive Bayes features.

Features are indicators of hashed n-grams of two kinds: byte n-grams of the text, and n-grams of its shape,
in which runs of letters, digits and blanks fall into one sign each and a word that repeats the one before
becomes a sign of its own. Each indicator is scaled by its log-count ratio between the classes (naive
Bayes), texts are brought to unit length, and a hinge-loss model is fitted by dual coordinate descent.
Scores are the fitted model's margins on a logistic scale, calibrated on a part of the sample that the
descent does not see.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import hash_share

FIT_ROWS = 12_000  # labelled documents per fit
BITS = 16  # log2 of the number of hashed features
NUMBER = np.dtype("<u2")  # a feature number as the fit keeps it
BYTE_GRAMS = (2, 4)
SHAPE_GRAMS = (2, 3, 5)
SMOOTHING = 1.0
COST = 4.0
PASSES = 12
CALIBRATION = 4  # every so-manieth row of each class calibrates; all rows, with fewer of a class

_SHAPE = np.zeros(256, np.uint8)  # sign of each byte: punctuation stays itself
_SHAPE[:] = np.arange(256)
for _low, _high, _sign in ((0, 33, 32), (48, 58, 57), (65, 91, 65), (97, 123, 97), (128, 256, 97)):
    _SHAPE[_low:_high] = _sign
_REPEAT = 1  # sign of a word that repeats the one before


def _hashed(signs: np.ndarray, size: int, salt: int) -> np.ndarray:
    n = len(signs) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    mixed = np.full(n, salt * 2654435761 % 2 ** 32, np.uint32)
    for k in range(size):
        mixed = (mixed ^ signs[k:k + n]) * np.uint32(0x01000193)
        mixed ^= mixed >> np.uint32(15)
    return (mixed >> np.uint32(32 - BITS)).astype(np.int64)


def _shape(raw: np.ndarray) -> np.ndarray:
    """Shape of a text: one sign per run, with repeated words marked."""
    signs = _SHAPE[raw]
    blank = signs == 32
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if len(starts) > 1:
        stops = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
        length = stops - starts
        first = np.zeros(len(raw), np.int64)
        first[starts] = starts
        place = np.arange(len(raw)) - np.maximum.accumulate(first)
        # equal words have equal sums of their bytes, weighted by the place in the word
        weight = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        weight ^= weight >> np.uint64(31)
        value = np.where(blank, np.uint64(0), (raw.astype(np.uint64) + np.uint64(1)) * weight)
        total = np.add.reduceat(value, starts)
        again = np.concatenate([[False], (total[1:] == total[:-1]) & (length[1:] == length[:-1])])
        signs = signs.copy()
        inside = np.repeat(again, length)
        where = np.flatnonzero(~blank)
        signs[where[inside]] = _REPEAT
    runs = np.concatenate([[True], signs[1:] != signs[:-1]])
    return signs[runs]


def features(text: bytes) -> np.ndarray:
    """Sorted feature numbers of a UTF-8 text; none for an empty one."""
    if not text:
        return np.empty(0, np.int64)
    raw = np.frombuffer(text, np.uint8)
    seen = np.zeros(1 << BITS, bool)
    for size in BYTE_GRAMS:
        seen[_hashed(raw.astype(np.uint32), size, size)] = True
    shape = _shape(raw).astype(np.uint32)
    for size in SHAPE_GRAMS:
        seen[_hashed(shape, size, 100 + size)] = True
    return np.flatnonzero(seen)


class Model(NamedTuple):
    weights: np.ndarray  # ratio times hinge-loss weight, per feature
    ratio2: np.ndarray  # squared ratio, for a text's length
    bias: float
    slope: float
    offset: float

    def score(self, text: bytes) -> float:
        """Chance of label 1, 0 to 1."""
        found = features(text)
        length = float(np.sqrt(self.ratio2[found].sum())) or 1.0
        margin = float(self.weights[found].sum()) / length + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


class Made(Sequence):
    """A sequence of arrays that are made of others whenever they are asked for, so that only the others are held."""

    def __init__(self, of: Sequence[np.ndarray], make: Callable[[np.ndarray], np.ndarray]):
        self.of, self.make = of, make

    def __len__(self) -> int:
        return len(self.of)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.make(self.of[i])


def descend(rows: Sequence[np.ndarray], values: Sequence[np.ndarray], y: np.ndarray, cost: np.ndarray, dim: int,
            passes: int = PASSES, seed: int = 1) -> np.ndarray:
    """Weights of the hinge-loss model, by dual coordinate descent; the last feature is the bias.

    Each step solves the dual problem in one row's multiplier exactly and keeps it in [0, cost].
    """
    weights, alpha = np.zeros(dim), np.zeros(len(rows))
    square = np.array([float(v @ v) for v in values])
    random = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in random.permutation(len(rows)).tolist():
            at, v = rows[i], values[i]
            slack = y[i] * float(weights[at] @ v) - 1
            new = min(max(alpha[i] - slack / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                weights[at] += step * y[i] * v
                moved = max(moved, abs(step) / cost[i])
        if moved < 1e-3:
            break
    return weights


def _calibrated(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve with the greatest likelihood, by Newton steps on targets that
    are drawn in a little, so that separable margins stay finite."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (p - target) + 1e-6 * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), gradient)
        size = np.abs(step).max()
        beta = beta - step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit_rows(found: Sequence[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on feature rows with labels 0 and 1. With one class only, or no rows, every score is the share
    of label 1 (0.5 without rows). Of each class, every CALIBRATION-th row calibrates and the others train. Beside the
    rows as given nothing is held that grows with them."""
    dim = 1 << BITS
    y = np.where(labels > 0, 1.0, -1.0)
    share = (float((y > 0).sum()) + 0.5) / (len(y) + 1)
    smaller = min((y > 0).sum(), (y < 0).sum())
    if smaller == 0:
        return Model(np.zeros(dim), np.zeros(dim), 0.0, 1.0, float(np.log(share / (1 - share))))
    place = np.where(y > 0, np.cumsum(y > 0), np.cumsum(y < 0))  # in the row's own class
    held = place % CALIBRATION == 0 if smaller >= CALIBRATION else np.ones(len(y), bool)
    train = np.flatnonzero(~held) if smaller >= CALIBRATION else np.arange(len(y))
    counts = np.full((2, dim), SMOOTHING)
    for i in train:
        counts[int(labels[i] > 0), found[i]] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))

    def scaled(at: np.ndarray) -> np.ndarray:
        v = ratio[at]
        return np.concatenate([v / (float(np.sqrt(v @ v)) or 1.0), [1.0]]).astype(np.float32)

    def placed(at: np.ndarray) -> np.ndarray:
        return np.concatenate([at, [dim]])

    balance = np.where(y > 0, len(train) / (2 * (y[train] > 0).sum()), len(train) / (2 * (y[train] < 0).sum()))
    own = [found[i] for i in train]
    weights = descend(Made(own, placed), Made(own, scaled), y[train], COST * balance[train], dim + 1)
    margins = np.array([float(weights[placed(found[i])] @ scaled(found[i])) for i in np.flatnonzero(held)])
    slope, offset = _calibrated(margins, y[held])
    return Model(weights[:dim] * ratio, ratio ** 2, float(weights[dim]), slope, offset)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = FIT_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents, those whose ids hash smallest.

    Labels that are null or have a null id are left out, and so are ids with both labels. Documents that
    share an id count once, with the smallest text; a null text counts as an empty one. The sample is
    bounded, so the descent runs in one task; only the model comes to the driver.
    """
    chosen = (labels.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna().groupBy("key")
              .agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most"))
    share = 4.0 * rows / max(1, chosen.count())
    chosen = chosen.where(hash_share("key") < share).orderBy(hash_share("key"), "key").limit(rows)
    found = (docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "key").groupBy("key").agg(F.first("label").alias("label"), F.min("text").alias("text")))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [features(v.as_py()).astype(NUMBER).tobytes() for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label").cast(pa.int32()), pa.array(at, pa.binary())],
                ["key", "label", "at"])

    kind = dict(docs.dtypes)[key]
    turned = found.select("key", "label", F.col("text").cast("binary").alias("text")).mapInArrow(
        turn, f"key {kind}, label int, at binary")

    def learn(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.column("key")).to_numpy()
        at = [np.frombuffer(v.as_buffer(), NUMBER) for v in table.column("at")]
        model = fit_rows([at[i] for i in order], table.column("label").to_numpy()[order])
        return pa.table({"weights": [model.weights], "ratio2": [model.ratio2], "rest": [model[2:]]})

    got = turned.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(learn, "weights array<double>, ratio2 array<double>, rest array<double>").first()
    if got is None:
        return fit_rows([], np.empty(0, np.int64))
    return Model(np.array(got["weights"]), np.array(got["ratio2"]), *got["rest"])


def scored(model: Model, docs: DataFrame, text: Column) -> Column:
    """Score of each text; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py() or b"") for t in texts], pa.float64())

    return score(text.cast("binary"))
