"""Near copies by the exact Jaccard similarity of word shingles.

Texts are near copies when the sets of their 5-word shingles have a Jaccard similarity of at least 0.8;
classes are the connected components. About ten bits of two SimHash fingerprints differ at that
similarity, which bands of pivots cannot carry, so candidates come from MinHash: texts share a key where
ROWS minima of one of BANDS bands agree. A pair of similarity s is missed with probability
(1 - s^ROWS)^BANDS: 7e-5 at 0.8, 5e-10 at 0.9. Every link is confirmed on the shingle sets themselves.

Keys that hold the same texts count once. Keys of many texts are dealt into blocks of bounded size. A first
round, over FIRST bands, compares inside the blocks only, which joins most of a large class in linear
work; a second takes the keys whose texts are not of one component yet, and sends only the texts
outside the largest component to all blocks of their key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import stage
from scorekit.llm.simhash import SEED, components, one_of_each
from scorekit.session import small_table

SHINGLE = 5  # words
SIMILARITY = 0.8
BANDS, ROWS, FIRST = 24, 5, 4
BLOCK = 512  # texts of a block
BLOCK_SHINGLES = 1 << 20
CHUNK = 1 << 10  # shingles whose minima are taken at a time
SKETCH = "fp long, size long, keys array<long>"
_random = np.random.default_rng(11)
_XOR, _TIMES = _random.integers(0, 2 ** 64, (2, BANDS * ROWS, 1), np.uint64)
_TIMES |= np.uint64(1)
_MIX = _random.integers(0, 2 ** 64, ROWS, np.uint64) | np.uint64(1)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a UTF-8 text, sorted; a shorter text is one shingle. A-Z are
    lower-cased, blanks are those of ASCII."""
    words = text.lower().split()  # bytes: ASCII only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    stops = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A number for the minima of each band; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    minima = np.full(BANDS * ROWS, 2 ** 64 - 1, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        minima = np.minimum(minima, ((hashes[at:at + CHUNK] ^ _XOR) * _TIMES).min(axis=1))
    minima ^= minima >> np.uint64(31)
    mixed = (minima.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.arange(BANDS, dtype=np.uint64)
    return mixed.view(np.int64)


def _sketch_of(text: Column, size: int) -> Column:
    """A number that stands for the shingle set (64 bits of a hash), its size, and its keys."""

    @F.arrow_udf(SKETCH)
    def sketches(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            hashes = shingles(t.as_py() or b"", size)
            rows.append({"fp": int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64)),
                         "size": len(hashes), "keys": band_keys(hashes)})
        return pa.array(rows, pa.struct([("fp", pa.int64()), ("size", pa.int64()), ("keys", pa.list_(pa.int64()))]))

    return sketches(text.cast("binary"))


def forest(sets: list[np.ndarray], own: np.ndarray, component: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between sets that are similar and not of one component yet, as index pairs that connect all
    such. Two sets are compared if one at least is the block's ``own``."""
    label, links = component.copy(), []
    size = np.array([len(s) for s in sets])
    edges = np.concatenate([[0], np.cumsum(size)])
    known, number = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(known), bool)
    for i in range(len(sets) - 1):
        rest = slice(i + 1, None)
        fits = (label[rest] != label[i]) & (np.minimum(size[rest], size[i]) >= similarity * np.maximum(size[rest], size[i]) - 1e-6)
        if not own[i]:
            fits &= own[rest]
        others = np.flatnonzero(fits) + i + 1
        if not len(others):
            continue
        mark[number[edges[i]:edges[i + 1]]] = True
        for j in others.tolist():
            if label[j] == label[i]:
                continue
            shared = np.count_nonzero(mark[number[edges[j]:edges[j + 1]]])
            if shared / (size[i] + size[j] - shared) >= similarity:
                links.append((i, j))
                label[label == label[j]] = label[i]
        mark[number[edges[i]:edges[i + 1]]] = False
    return links


def _links(dealt: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) inside the blocks of ``dealt`` (key, block, own, component, fp)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block; a block may go on in the next batch."""
        current, rows = None, []

        def solve() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            own, component, fp, content = zip(*rows, strict=True)
            found = forest([np.frombuffer(c, np.uint64) for c in content], np.array(own), np.array(component, np.int64), similarity)
            return [(fp[i], fp[j]) for i, j in found]

        def batch_of(pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], schema=schema)

        for batch in batches:
            pairs = []
            columns = [batch.column(c).to_pylist() for c in ("key", "block", "own", "component", "fp", "content")]
            for key, block, *row in zip(*columns, strict=True):
                if (key, block) != current:
                    pairs += solve()
                    current, rows = (key, block), []
                rows.append(row)
            yield from batch_of(pairs)
        yield from batch_of(solve())

    return (dealt.join(sets, "fp").select("key", "block", "own", "component", "fp", "content")
            .repartition("key", "block").sortWithinPartitions("key", "block")
            .mapInArrow(link, "a long, b long").distinct())


def _own_block() -> Column:
    return F.pmod(F.xxhash64("fp", "key"), F.col("blocks")).cast("int")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            similarity: float = SIMILARITY, block: int = BLOCK, candidates: DataFrame | None = None) -> DataFrame:
    """One row per input row: key, digest (of the text), fp (stands for the shingle set), component: the
    smallest key of the class, root.

    Texts without words are of one class. Null keys are members of their class but never its name, unless
    it has no other. Repeated rows stay repeated. Only the two columns are read; an empty table gives no
    rows. MinHash is laid out for a similarity of 0.8 or more. ``candidates`` (digest, root) are classes of
    another method: texts of one root are compared too, and link if their sets are similar.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = stage(docs.select(F.col(key).alias("key"), F.md5(content).alias("digest"), _sketch_of(F.col(text), shingle).alias("s"))
                 .select("key", "digest", "s.*"), "near-rows")
    members = stage(rows.groupBy("fp").agg(F.min("key").alias("first"), F.min(F.struct("key", "digest")).alias("one"),
                                           F.first("size").alias("size"), F.first("keys").alias("keys")), "near-members")
    keyed = members.select("fp", "size", F.posexplode("keys").alias("band", "key"))
    if candidates is not None:
        other = candidates.select("digest", F.xxhash64(F.lit("class"), "root").alias("key")).distinct()
        keyed = keyed.unionByName(rows.select("digest", "fp", "size").distinct().join(other, "digest")
                                  .select("fp", "size", F.lit(BANDS).alias("band"), "key").distinct())
    shared = (keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("band").alias("band"), F.sum("size").alias("total"),
                                       F.min("fp").alias("least"), F.bit_xor(F.xxhash64("fp")).alias("who")).where("n > 1"))
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("total") / BLOCK_SHINGLES)).cast("int")
    chosen = (shared.groupBy("n", "total", "least", "who").agg(F.min(F.struct("band", "key")).alias("k"))
              .select("k.key", "k.band", blocks.alias("blocks")))
    buckets = stage(keyed.select("key", "fp").join(chosen, "key"), "near-buckets")

    asked = members.join(buckets.select("fp").distinct(), "fp", "left_semi").select("one.*")
    few = small_table(asked)  # few are sent to the texts
    asked = (asked if few is None else F.broadcast(few)).alias("o")
    d = docs.select(F.col(key).alias("key"), F.md5(content).alias("digest"), content.alias("content")).alias("d")
    texts = d.join(asked, F.col("d.key").eqNullSafe(F.col("o.key")) & (F.col("d.digest") == F.col("o.digest"))).select("content")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle).tobytes() for t in batch.column(0)]
            fp = np.array([xxhash.xxh3_64_intdigest(f) for f in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"fp": pa.array(fp, pa.int64()), "content": pa.array(found, pa.binary())})

    sets = stage(texts.mapInArrow(shingled, "fp long, content binary").dropDuplicates(["fp"]), "near-sets")

    start = buckets.where(F.col("band") < FIRST).select(
        "key", _own_block().alias("block"), F.lit(True).alias("own"), F.col("fp").alias("component"), "fp")
    first = stage(_links(start, sets, similarity), "near-links")
    named = stage(buckets.join(components(first), F.col("fp") == F.col("node"), "left").select(
        "key", "fp", "band", "blocks", F.coalesce("root", "fp").alias("component")), "near-named")
    mixed = stage(named.where((F.col("band") >= FIRST) | (F.col("blocks") > 1)).groupBy("key", "component").agg(F.count("*").alias("n"))
             .groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("largest"))
             .where("parts > 1").select("key", "largest"), "near-mixed")
    visits = F.when(F.col("component") == F.col("largest"), F.array(_own_block())).otherwise(
        F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (named.join(mixed, "key").withColumn("block", F.explode(visits))
             .select("key", "block", (F.col("block") == _own_block()).alias("own"), "component", "fp"))
    second = _links(dealt, sets, similarity)
    roots = components(first.union(second))
    named = (members.join(roots, F.col("fp") == F.col("node"), "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    return rows.select("key", "digest", "fp").join(named.join(names, "root").select("fp", "component", "root"), "fp")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, with all columns, chosen as by ``simhash.deduplicate``."""
    return one_of_each(docs, classes(docs, key, text, **options), key, text)
