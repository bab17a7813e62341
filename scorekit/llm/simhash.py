"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint is the bitwise majority of the XXH64 of its 3-word shingles. Documents link
when their fingerprints differ in at most DISTANCE bits; classes are the connected components.

The distance to a reference fingerprint (pivot) changes by no more than two fingerprints differ, so the
largest difference of their coordinates in a table of distances to many pivots bounds their distance
from below. The table is used twice. By bands: the bits fall into DISTANCE + 2 bands, each with pivots
of its own; fingerprints within DISTANCE agree in at least two whole bands, so in those bands their
distances to the pivots are equal, and an equi-join on the coordinates of each pair of bands loses no
link. As a whole: candidates whose largest difference over full-length pivots is above DISTANCE are
discarded, and the survivors are verified bit by bit.

Candidates that share a key are dealt into blocks of bounded size, and each pair of blocks is one group
of work; it returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import stage

SHINGLE = 3  # words
SEED = 42
BITS = 64
DISTANCE = 3
BAND_PIVOTS = 16
PIVOTS = 32
BLOCK = 1024
CHUNK = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes) -> int:
    """Fingerprint of a UTF-8 text; 0 without words. A-Z are lower-cased, blanks are those of ASCII."""
    words = text.lower().split()  # bytes: ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-SHINGLE]]).tolist()
    stops = (ends[SHINGLE - 1:] - 1).tolist()
    n, counts = len(starts), np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, CHUNK):
        hashed = b"".join([digest(line[a:b], SEED) for a, b in
                           zip(starts[at:at + CHUNK], stops[at:at + CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint_of(text: Column) -> Column:
    """Fingerprint as a signed 64-bit number; null and empty texts have 0."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
        return pa.array(found.view(np.int64))

    return fingerprints(text.cast("binary"))


def hex_of(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


class PivotTables:
    """Reference fingerprints, fixed by a seed, and the distances of fingerprints to them."""

    def __init__(self, distance: int = DISTANCE, seed: int = 7):
        random = np.random.default_rng(seed)
        self.distance = distance
        self.pivots = random.integers(0, 2 ** 64, PIVOTS, np.uint64)
        edges = np.linspace(0, BITS, distance + 3).astype(int)  # distance + 2 bands
        self.bands = [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.tables = []
        for _, width in self.bands:  # coordinates of every value of a band, packed
            values = np.arange(1 << width, dtype=np.uint64)
            packed = np.zeros(len(values), np.uint64)
            for _ in range(BAND_PIVOTS):
                pivot = np.uint64(random.integers(0, 1 << width))
                packed = packed * np.uint64(16) + np.bitwise_count(values ^ pivot).astype(np.uint64)
            self.tables.append(packed)

    def coordinates(self, values: np.ndarray) -> np.ndarray:
        """Distances to the full-length pivots, a row per fingerprint."""
        return np.bitwise_count(values[:, None] ^ self.pivots[None, :]).astype(np.int8)

    def keys(self, values: np.ndarray) -> list[np.ndarray]:
        """For each pair of bands, one number per fingerprint for its coordinates in both."""
        part = [table[(values >> np.uint64(at)) & np.uint64((1 << width) - 1)]
                for (at, width), table in zip(self.bands, self.tables, strict=True)]
        mixed = []
        for number, (a, b) in enumerate(combinations(range(len(part)), 2)):
            x = (part[a] * np.uint64(0x9E3779B97F4A7C15)) ^ (part[b] * np.uint64(0xC2B2AE3D27D4EB4F))
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(number)
            mixed.append(x ^ (x >> np.uint64(32)))
        return mixed


def forest(values: np.ndarray, left: np.ndarray, tables: PivotTables) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints of ``left`` and others, as index pairs.

    ``left`` marks one side of two blocks; with all or none marked, every pair counts.
    """
    n = len(values)
    if n < 2:
        return []
    one_block = bool(left.all() or not left.any())
    rows = np.arange(n) if one_block else np.flatnonzero(left)
    columns = np.arange(n) if one_block else np.flatnonzero(~left)
    table = tables.coordinates(values)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in rows.tolist():
        others = columns[columns > i] if one_block else columns
        near = others
        for some in range(0, PIVOTS, 8):  # discard by the largest coordinate difference
            gap = np.abs(table[near, some:some + 8] - table[i, some:some + 8]).max(axis=1, initial=0)
            near = near[gap <= tables.distance]
            if len(near) <= 4:
                break
        near = near[np.bitwise_count(values[near] ^ values[i]) <= tables.distance]
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def links(fingerprints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that are within ``distance``.

    ``fingerprints`` has one distinct non-null fingerprint per row (column fp). Keys of a single
    fingerprint are dropped; a key of n fingerprints is dealt into n / block blocks.
    """
    tables = PivotTables(distance)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy(zero_copy_only=False)
            keys = tables.keys(signed.view(np.uint64))
            yield pa.RecordBatch.from_pydict({"key": np.concatenate(keys).view(np.int64), "fp": np.tile(signed, len(keys))})

    keyed = stage(fingerprints.select("fp").mapInArrow(spread, "key long, fp long"), "simhash-keys")
    shared = (keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
              .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = (keyed.join(shared, "key")
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("lower"), F.greatest("own", "other").alias("upper"),
                     (F.col("own") <= F.col("other")).alias("left"), "fp"))

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group may go on in the next batch."""
        held: list[np.ndarray] = []

        def solve(rows: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int]]:
            """Links of the groups that begin at ``cuts``; groups of two, the most, at once."""
            edges = np.concatenate([cuts, [len(rows)]])
            sizes = np.diff(edges)
            two = cuts[sizes == 2]
            x, y = rows[two, 4].view(np.uint64), rows[two + 1, 4].view(np.uint64)
            gap = np.abs(tables.coordinates(x) - tables.coordinates(y)).max(axis=1, initial=0)
            x, y = x[gap <= distance], y[gap <= distance]
            fit = np.bitwise_count(x ^ y) <= distance
            pairs = list(zip(x[fit].view(np.int64).tolist(), y[fit].view(np.int64).tolist(), strict=True))
            for at, size in zip(cuts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                group = rows[at:at + size]
                values = group[:, 4].copy()
                pairs += [(int(values[i]), int(values[j]))
                          for i, j in forest(values.view(np.uint64), group[:, 3].astype(bool), tables)]
            return pairs

        def batch_of(pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], schema=schema)

        for batch in batches:
            rows = np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False)
                             for c in ("key", "lower", "upper", "left", "fp")], axis=1)
            if not len(rows):
                continue
            if held:
                rows = np.concatenate([*held, rows])
            cuts = np.concatenate([[0], np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1])
            held = [rows[cuts[-1]:]]
            yield from batch_of(solve(rows[:cuts[-1]], cuts[:-1]))
        if held:
            yield from batch_of(solve(held[0], np.array([0])))

    group = ["key", "lower", "upper"]
    return (dealt.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(link, "a long, b long").distinct())


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for the nodes of ``pairs`` (a, b).

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours to the smallest. Both need only the minimum per node, which is
    combined before the shuffle; each step ends in a table in the shared folder.
    """
    edges = stage(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "component-edges")
    before = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("low"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("node"))
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct())
        large = stage(large, "component-large")
        low = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "node")
        small = large.join(low, F.col("u") == F.col("node"))
        small = stage(small.select(F.explode(F.array(F.struct("u", F.col("low").alias("v")),
                                                     F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
                      .select("e.*").where("u <> v").distinct(), "component-small")
        state = small.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        edges = small
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per input row: key, digest (of the text), fp (signed 64 bits), component: the smallest key
    of the class.

    Null and empty texts have fingerprint 0 and link like any other. Null keys are members of their
    class but never its name, unless it has no other. Repeated rows stay repeated. Only the two columns
    are read; an empty table gives no rows.
    """
    rows = stage(docs.select(F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"),
                             fingerprint_of(F.col(text)).alias("fp")), "simhash-rows")
    members = stage(rows.groupBy("fp").agg(F.min("key").alias("first")), "simhash-fingerprints")
    roots = components(links(members, distance))
    named = (members.join(roots, F.col("fp") == F.col("node"), "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    return rows.join(named.join(names, "root").select("fp", "component", "root"), "fp")


def one_of_each(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """One row of each class, with all columns: that with the smallest key, nulls last; of rows that share
    it, the one whose text digest, and then whose whole row, comes first."""
    order = F.struct(F.col("key").isNull().alias("none"), "key", "digest")
    kept = members.groupBy("root").agg(F.min(order).alias("kept")).select("kept.*")
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    d = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), digest.alias("digest")).alias("d")
    met = d.join(kept.alias("k"), F.col("d.key").eqNullSafe(F.col("k.key")) & (F.col("d.digest") == F.col("k.digest")))
    first = F.row_number().over(Window.partitionBy("d.key", "d.digest").orderBy(F.xxhash64("row")))
    return met.withColumn("place", first).where("place = 1").select("row.*")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row of each class, as ``one_of_each`` chooses it."""
    return one_of_each(docs, classes(docs, key, text, distance), key, text)
