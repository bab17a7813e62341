"""SimHash classes, benchmark contamination and top-k search."""

import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from brute import LONG, edge_docs, empty_docs, fingerprint, letter_words, roots
from pyspark.sql import functions as F

from scorekit.llm import decontam, nearcopies, simhash, topk

# near-duplicates --------------------------------------------------------------------------------


def test_fingerprints():
    texts = ["", "  \n", "One", "one two", "One two three", "a b c d", "a  b\tc\nd A b C D", "é É ß ü漢 字 x y z",
             LONG[:9000], "x\x1cy z\x85w q r s t u", "the the the the the"]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == fingerprint(t), t[:30]


def test_fingerprints_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    text = " ".join(str(i % 13) for i in range(200))
    assert simhash.fingerprint(text.encode()) == fingerprint(text)


def near_values(seed):
    """Singles, pairs, chains and balls of fingerprints."""
    random.seed(seed)
    flip = lambda v, n: v ^ sum(1 << b for b in random.sample(range(64), n))
    values = [random.getrandbits(64) for _ in range(200)]
    values += [flip(v, random.randint(1, 5)) for v in values[:120]]
    chain = [random.getrandbits(64)]
    for _ in range(60):
        chain.append(flip(chain[-1], 3))
    center = random.getrandbits(64)
    return list(dict.fromkeys([*values, *chain, 0, 1, 2 ** 64 - 1, *[flip(center, random.randint(1, 3)) for _ in range(150)]]))


@pytest.mark.parametrize("block", [8, 64, 1024])
def test_links_connect_what_is_near(spark, block):
    values = near_values(block)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    found = simhash.links(table, block=block)
    for r in found.collect():
        assert ((r["a"] ^ r["b"]) & (2 ** 64 - 1)).bit_count() <= 3
    root = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    expected = roots(values)
    named = [root.get(v, v) for v in signed]
    assert len(set(named)) == len(set(expected))
    assert len(set(zip(named, expected, strict=True))) == len(set(expected))


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 201)} == {0} and {got[1000 + i] for i in range(1, 60)} == {1000} and got[5001] == 5000


def texts_with_copies():
    random.seed(11)
    base = [" ".join(random.choice("abcdefghij") * random.randint(1, 3) + str(random.randint(0, 40)) for _ in range(300)) for _ in range(25)]
    near = [b.replace(b.split()[150], "changed", 1) for b in base[:15]]
    return base + near + base[:5] * 3 + ["", None, " "]


def test_classes_and_deduplication(spark):
    texts = texts_with_copies()
    docs = spark.createDataFrame([(i, t, "component", 1) for i, t in enumerate(texts)], "doc_id long, text string, root string, fp long")
    got = {r["key"]: (r["fp"] & (2 ** 64 - 1), r["component"]) for r in simhash.classes(docs.repartition(5)).collect()}
    prints = [fingerprint(t) for t in texts]
    expected = roots(prints)
    assert got == {i: (prints[i], expected[i]) for i in range(len(texts))}
    assert len(set(expected)) < len(set(prints))  # there are near copies
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))


def test_near_copy_edges(spark):
    docs = edge_docs(spark)
    got = simhash.classes(docs).collect()
    assert len(got) == docs.count()
    kept = simhash.deduplicate(docs)
    assert kept.count() == len({r["root"] for r in got}) == 7
    assert simhash.classes(empty_docs(spark)).count() == 0 and simhash.deduplicate(empty_docs(spark)).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("all the same text").alias("text"))
    assert {r["component"] for r in simhash.classes(hot).collect()} == {0}
    assert simhash.deduplicate(hot).collect()[0]["doc_id"] == 0


def word_shingles(text, size=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def similar_roots(texts, similarity=0.8):
    sets, root = [word_shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and jaccard(sets[i], sets[j]) >= similarity:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def edited_texts():
    """Texts of 12 to 400 words, each with copies that differ in more and more words, and a hot passage."""
    random.seed(5)
    word = lambda: "w" + str(random.randint(0, 3000))
    out = []
    for size in (12, 30, 60, 100, 200, 400):
        for _ in range(8):
            base = [word() for _ in range(size)]
            out.append(" ".join(base))
            for edits in (1, 2, size // 40 + 1, size // 20):
                copy = list(base)
                for at in random.sample(range(size), edits):
                    copy[at] = word()
                out.append(" ".join(copy))
    common = [word() for _ in range(60)]
    return out + [" ".join([*common, *[word() for _ in range(n)]]) for n in [5, 8, 12, 20, 60] * 12] + ["", None, "One two", "one  TWO"]


@pytest.mark.parametrize("block", [4, 512])
def test_near_copies_of_any_length(spark, block):
    texts = edited_texts()
    expected = similar_roots(texts)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, fp long, root int")
    got = {r["key"]: r["component"] for r in nearcopies.classes(docs.repartition(4), block=block).collect()}
    assert got == dict(enumerate(expected))
    kept = nearcopies.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))
    assert len(set(expected)) < len(set(roots([fingerprint(t) for t in texts])))  # three bits lose many


def test_pipeline_drops_near_copies_of_any_length(spark):
    texts = edited_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(similar_roots(texts)))


# contamination ----------------------------------------------------------------------------------

def contamination_of(text, items, window=13):
    words = letter_words(text)
    hit, found = [False] * len(words), set()
    for item, content in items:
        own = letter_words(content)
        size = min(window, len(own))
        for k in range(len(own) - size + 1) if size else ():
            for at in range(len(words) - size + 1):
                if words[at:at + size] == own[k:k + size]:
                    hit[at:at + size] = [True] * size
                    found |= {str(item)} - {"None"}
    return len(words), sum(hit), sorted(found)


@pytest.mark.parametrize(("block_words", "shingle", "pieces"), [(1_000_000, 4, 10_000), (100, 4, 10_000), (200, 1, 10_000),
                                                                (1_000_000, 13, 7), (1_000_000, 4, 1)])
def test_contamination(spark, monkeypatch, block_words, shingle, pieces):
    random.seed(block_words + shingle)
    word = lambda: random.choice(["the", "of", "Über", "ÜBER", "x1", "9", "漢字", "it"])
    run = lambda n: " ".join(word() for _ in range(n))
    items = [(i, run(random.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(8, 24)] + [(30, "the, of-the!"), (31, "the of THE"), (32, " .,"), (33, None),
             (None, "9 漢字 9 of"), (34, ",".join(run(200).split()))]
    texts = [run(40) + ". " + (random.choice(items)[1] or "").upper() + ", " + run(20) for _ in range(60)]
    texts += [None, "", "?!", "the", items[0][1], items[1][1], run(5) + " " + items[2][1] * 2]
    docs = spark.createDataFrame([(i, t, "q", 3) for i, t in enumerate(texts)], "doc_id long, text string, items string, n_words long")
    bench = spark.createDataFrame([*items, items[0], (None, None)], "item_id long, text string")
    monkeypatch.setattr(decontam, "PIECE_WORDS", pieces)
    got = decontam.contamination(docs.repartition(3), bench, shingle=shingle, block_words=block_words).collect()
    clean = []
    for r in got:
        c = r["contamination"]
        expected = contamination_of(texts[r["doc_id"]], items)
        assert (c["n_words"], c["n_hit"], list(c["items"])) == expected, texts[r["doc_id"]]
        if not (expected[1] > 0 and 20 * expected[1] >= expected[0]):
            clean.append(r["doc_id"])
    kept = decontam.decontaminate(docs, bench, shingle=shingle, block_words=block_words)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(clean)


def test_contamination_edges(spark):
    docs, none = edge_docs(spark), spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, none).count() == docs.count()
    bench = spark.createDataFrame([(1, "consectetur"), (2, "alpha BETA gamma delta"), (3, LONG[:300])], "item_id long, text string")
    got = {r["text"]: r["contamination"] for r in decontam.contamination(docs, bench).collect()}
    assert got["alpha beta gamma delta"]["n_hit"] == 4 and got[LONG]["n_hit"] == len(letter_words(LONG))
    assert got[None]["n_words"] == 0 and got[""]["items"] == []
    assert decontam.contamination(empty_docs(spark), bench).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert spark.range(1).select(decontam.digest_of_items(F.array().cast("array<string>"))).first()[0] == empty


# top-k ------------------------------------------------------------------------------------------

def best_of(rows, k, every):
    """Contract rows for (id, vector) rows, repeated ids included."""
    quantized = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    lists = {}
    for q, x in quantized:
        if q % every == 0:
            lists.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y, strict=True)), c)
                                           for c, y in quantized if c != q and len(y) == len(x))
    return sorted((q, rank, c, -s) for q, found in lists.items() for rank, (s, c) in enumerate(sorted(found)[:k], 1))


@pytest.mark.parametrize(("parts", "dim"), [(1, 6), (2, 6), (3, 5), (4, 3)])
def test_search_is_exact(spark, monkeypatch, parts, dim):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 50)
    random.seed(parts)
    rows = {i: [random.gauss(0, 1) for _ in range(dim)] for i in range(150)}
    rows |= {i: rows[20] for i in range(150, 190)} | {i: [random.choice([-1.0, 0.0, 1.0]) for _ in range(dim)] for i in range(190, 260)}
    repeated = [(i, rows[j]) for i in (0, 10, 33) for j in (i, i, 40, 41, 42, 150, 3)]  # ids with several rows, queries among them
    table = spark.createDataFrame([(i, v, 0, "x", "y", [1.0], 2) for i, v in [*rows.items(), *repeated]],
                                  "vec_id long, embedding array<float>, rank int, id string, class string, vector array<double>, part int").repartition(4)
    got = topk.search(table, F.col("id") % 10 == 0, 5, parts=parts)
    exact = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert sorted(tuple(r) for r in got.collect()) == best_of(exact, 5, 10)


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [1.0, None]), (5, []), (6, [3.0]),
            (10, [1.0, 2.0]), (11, [-1.0, -2.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]), (30, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    got = topk.search(table, F.col("id") % 10 == 0, 5)
    assert sorted(tuple(r) for r in got.collect()) == best_of(exact, 5, 10)
    assert topk.search(table.where("vec_id < 0"), F.col("id") % 10 == 0, 5).count() == 0


def test_search_over_long_vectors_is_exact(spark):
    random.seed(5)
    rows = [(i, [random.choice([3e5, -3e5, 2.0 ** 19, 1.0]) + random.randint(0, 3) / 256 for _ in range(16)]) for i in range(60)]
    rows += [(100, [2.0 ** 40] * 16), (110, [1e300] * 16)]  # inner products beyond a long
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(table, F.col("id") % 10 == 0, 5)
    assert sorted(tuple(r) for r in got.collect()) == best_of(rows[:60], 5, 10)


def test_candidates_of_another_method_are_confirmed(spark):
    """At a similarity that MinHash is not laid out for, pairs are found if another method names them, and no others."""
    random.seed(9)
    texts = []
    for n in range(12):
        base = [f"b{n}x{i}" for i in range(40)]
        texts += [" ".join(base), " ".join([*base[:26], *[f"c{n}x{i}" for i in range(14)]]), " ".join(f"d{n}x{i}" for i in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named = docs.selectExpr("md5(cast(text as binary)) AS digest", "doc_id div 3 AS root")
    at = lambda **more: {r["key"]: r["component"] for r in nearcopies.classes(docs, similarity=0.4, **more).collect()}
    assert at(candidates=named) == dict(enumerate(similar_roots(texts, 0.4)))
    assert at() != at(candidates=named)


def test_pipeline_asks_the_pivot_tables(spark, monkeypatch):
    asked, real = [], simhash.classes
    monkeypatch.setattr(simhash, "classes", lambda *a: asked.append(a) or real(*a))
    docs = spark.createDataFrame([(1, "one two three"), (2, "one  TWO three"), (3, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]
    assert len(asked) == 1
