"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` words (a shorter item is one window). A document is hit where
a whole window occurs in it. Windows are sets of positioned shingles; as containment must be exact, a
window that occurs brings all its shingles, so it is enough to look for one of them: the shingles are
ordered by how rare they are in the corpus, and the prefix of that order (its rarest shingle) is joined
with the documents' shingles. The position of the shingle in its window gives the only place where
the window can stand; places that do not fit into the document are dropped (length and position), and the
words of the others are compared (verification).

Benchmarks are far smaller than the corpus, so they come to the documents: cut into runs of at most PIECE_WORDS
words, which go by hash into blocks of about BLOCK_WORDS / 2 words. That bounds what is broadcast, each block adding its hits to
the rows of the block before. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm.common import stage

WINDOW = 13
SHINGLE = 4
BLOCK_WORDS = 1_000_000
PIECE_WORDS = 10_000  # windows of an item that are looked up together
# lower-case A-Z, and blank all ASCII bytes that are no digits or letters
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def _shingles(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` word numbers; equal runs have equal numbers."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ ids[k:k + n].astype(np.uint64)) * _MIX
        mixed ^= mixed >> np.uint64(31)
    return mixed


class Block:
    """Items of one block: word numbers, and the windows with their shingles."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int, shingle: int):
        self.numbers: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        runs = [(i, words) for i, (_, text) in enumerate(items) if (words := words_of(text))]
        self.windows: list[tuple[int, np.ndarray]] = []  # item, word numbers
        for i, words in runs:
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)
            size = min(window, len(ids))
            self.windows += [(i, ids[k:k + size]) for k in range(len(ids) - size + 1)]
        self.shingle = shingle
        sizes = sorted({min(shingle, len(ids)) for _, ids in self.windows})
        self.sizes = sizes  # items shorter than a shingle have shingles of their own length
        self.shingles = {size: np.unique(np.concatenate(
            [_shingles(ids, size) for _, ids in self.windows if min(shingle, len(ids)) == size])) for size in sizes}
        self.prefixes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def number(self, words: list[bytes]) -> np.ndarray:
        """Word numbers of a document; 0 for words of no item."""
        get = self.numbers.get
        return np.array([get(w, 0) for w in words], np.int64)

    def count(self, words: list[bytes], totals: dict[int, np.ndarray]) -> None:
        """Add a document's occurrences of the block's shingles to ``totals``."""
        ids = self.number(words)
        for size, known in self.shingles.items():
            found = self._known(ids, size)
            if len(found):
                at = np.searchsorted(known, found[1])
                np.add.at(totals[size], at, 1)

    def _known(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Places and numbers of the document's shingles that occur in the block."""
        n = len(ids) - size + 1
        if n <= 0:
            return np.empty((0, 0))
        inside = ids[:n] > 0
        for k in range(1, size):
            inside &= ids[k:k + n] > 0
        places = np.flatnonzero(inside)
        if not len(places):
            return np.empty((0, 0))
        known = self.shingles[size]
        mixed = np.full(len(places), size, np.uint64)
        for k in range(size):
            mixed = (mixed ^ ids[places + k].astype(np.uint64)) * _MIX
            mixed ^= mixed >> np.uint64(31)
        at = np.searchsorted(known, mixed)
        at[at == len(known)] = 0
        fits = known[at] == mixed
        return np.stack([places[fits].astype(np.uint64), mixed[fits]]) if fits.any() else np.empty((0, 0))

    def order(self, totals: dict[int, np.ndarray]) -> None:
        """Choose each window's prefix, its rarest shingle (of equally rare ones the smallest number), and
        sort the windows by it: shingle, position in the window, window."""
        for size, known in self.shingles.items():
            shingle, position, window = [], [], []
            for w, (_, ids) in enumerate(self.windows):
                if min(self.shingle, len(ids)) == size:
                    own = _shingles(ids, size)
                    k = int(np.lexsort((own, totals[size][np.searchsorted(known, own)]))[0])
                    shingle.append(own[k])
                    position.append(k)
                    window.append(w)
            order = np.argsort(np.array(shingle, np.uint64), kind="stable")
            keys = np.array(shingle, np.uint64)[order]
            self.prefixes[size] = (keys, np.array(position)[order], np.array(window)[order])

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Hit words as a mask, and the items that have an occurring window."""
        ids, mask, items = self.number(words), np.zeros(len(words) + 1, np.int64), set()
        for size, (keys, position, window) in self.prefixes.items():
            found = self._known(ids, size)
            if not len(found):
                continue
            low, high = np.searchsorted(keys, found[1], "left"), np.searchsorted(keys, found[1], "right")
            for at, a, b in zip(found[0].tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, b):
                    item, run = self.windows[window[k]]
                    start = int(at) - int(position[k])
                    if start < 0 or start + len(run) > len(ids):
                        continue
                    if (ids[start:start + len(run)] == run).all():
                        mask[start] += 1
                        mask[start + len(run)] -= 1
                        items.add(self.items[item])
        return np.cumsum(mask[:-1]) > 0, sorted(items - {None})


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """Items (item, text) as runs of at most PIECE_WORDS words that have all their windows: item, text (words joined by blanks),
    n. Neighbouring runs share ``window`` - 1 words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item"), batch.column("text"), strict=True):
                words = words_of(text.as_py())
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    run = words[at:at + PIECE_WORDS + window - 1]
                    if run:
                        yield pa.RecordBatch.from_pydict({"item": pa.array([item.as_py()], pa.string()),
                                                          "text": pa.array([b" ".join(run)], pa.binary()), "n": pa.array([len(run)], pa.int64())})

    return items.mapInArrow(cut, "item string, text binary, n long").distinct()


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[DataFrame]:
    """The items' runs in blocks of about ``block_words`` / 2 words, dealt by hash, so that a block has hardly ever more
    than ``block_words`` and PIECE_WORDS."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    rows = stage(_pieces(rows.where(F.col("text").isNotNull()), window), "decontam-items")
    words = rows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * words // block_words)) if words > block_words else 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for n in range(blocks if words else 0):
        yield rows.where(block == n).select("item", "text")


def _count_shingles(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often each shingle of the block occurs in the corpus; one row per shingle comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    empty = {size: len(known) for size, known in block.shingles.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(n, np.int64) for size, n in empty.items()}
        for batch in batches:
            for value in batch.column(0):
                shared.value.count(words_of(value.as_py()), totals)
        for size, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"size": pa.array(np.full(len(at), size), pa.int32()),
                                              "place": pa.array(at, pa.int64()), "n": pa.array(found[at], pa.int64())})

    totals = {size: np.zeros(n, np.int64) for size, n in empty.items()}
    counted = docs.mapInArrow(count, "size int, place long, n long").groupBy("size", "place").agg(F.sum("n").alias("n"))
    for row in counted.collect():
        totals[row["size"]][row["place"]] = row["n"]
    return totals


STATE = "n_words long, n_hit long, items array<string>, mask binary"


def _with_hits(spark: SparkSession, block: Block | None, content: Column, state: Column) -> Column:
    """STATE of each document with the hits of one more block; without a block, of its words alone."""
    shared = spark.sparkContext.broadcast(block)

    @F.arrow_udf(STATE)
    def add(texts: pa.Array, states: pa.Array) -> pa.Array:
        rows = []
        for value, old in zip(texts, states.to_pylist(), strict=True):
            words = words_of(value.as_py())
            mask, items = shared.value.hits(words) if shared.value else (np.zeros(len(words), bool), [])
            if old["mask"]:
                mask |= np.unpackbits(np.frombuffer(old["mask"], np.uint8))[:len(mask)].astype(bool)
            rows.append({"n_words": len(words), "n_hit": int(mask.sum()), "items": sorted({*old["items"], *items}),
                         "mask": np.packbits(mask).tobytes() if mask.any() else None})
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                                         ("mask", pa.binary())]))

    return add(content, state)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  block_words: int = BLOCK_WORDS, out: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, items (ids as sorted strings).

    Null and empty texts have no words and no hits. Items whose text is null or has no word have no window. Windows of an
    item without an id hit words like others, but it is in no list of items. Repeated items count once. Rows
    and all other columns pass through.
    """
    spark, content = docs.sparkSession, F.col(text).cast("binary")
    none = F.struct(F.lit(None).cast("binary").alias("mask"), F.array().cast("array<string>").alias("items"))
    state = none
    for items in _blocks(benchmark, item, item_text, window, block_words):
        block = Block([(r["item"], bytes(r["text"])) for r in items.collect()], window, shingle)
        if block.windows:
            block.order(_count_shingles(docs.select(content.alias("text")), block))
            state = _with_hits(spark, block, content, state)
    if state is none:
        state = _with_hits(spark, None, content, state)
    return docs.select("*", state.alias(out)).withColumn(out, F.col(out).dropFields("mask"))


def contaminated(found: Column, share: int = 20) -> Column:
    """Whether hit words are at least one in ``share`` of a document's words."""
    return (found["n_hit"] > 0) & (found["n_hit"] * share >= found["n_words"])


def digest_of_items(items: Column) -> Column:
    """SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    whole = docs.select(F.struct("*").alias("row"), F.col(options.pop("text", "text")).alias("text"))
    found = contamination(whole, benchmark, "text", **options)
    return found.where(~contaminated(F.col("contamination"), share)).select("row.*")


