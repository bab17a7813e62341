"""Quality classifier and language identification."""

import random
import tracemalloc

import numpy as np
import pytest
from brute import LONG, edge_docs, empty_docs
from conftest import SF
from pyspark.sql import functions as F

from scorekit.llm import langid, quality
from scorekit.llm.common import held_out, load
from scorekit.llm.queries import training_labels


def test_shape_marks_runs_and_repeats():
    shape = lambda t: bytes(quality._shape(np.frombuffer(t.encode(), np.uint8)))
    assert shape("Abc def!!  x9") == b"Aa a! a9"
    assert shape("the the them the") == b"a \x01 a a"
    assert shape("  ab ab") == b" a \x01" and shape("é") == b"a" and shape(" ") == b" "


def test_features_are_indicators():
    assert len(quality.features(b"")) == 0
    once, many = quality.features(b"abc def ghi "), quality.features(b"abc def ghi " * 50)
    assert len(np.unique(many)) == len(many) and set(once) <= set(many)
    assert len(quality.features(b"a")) == 0 and len(quality.features("é".encode())) > 0


def test_descent_solves_the_dual():
    random = np.random.default_rng(4)
    n, dim, cost = 60, 8, 0.7
    x = np.concatenate([random.normal(size=(n, dim)), np.ones((n, 1))], axis=1)
    y = np.where(x[:, 0] + 0.3 * random.normal(size=n) > 0, 1.0, -1.0)
    rows, values = [np.arange(dim + 1)] * n, list(x)
    weights = quality.descend(rows, values, y, np.full(n, cost), dim + 1, passes=3000)
    value = lambda w: 0.5 * w @ w + cost * np.maximum(0, 1 - y * (x @ w)).sum()
    best = value(weights)
    assert best < value(np.zeros(dim + 1))
    for _ in range(300):  # the primal has no lower point near
        assert value(weights + random.normal(size=dim + 1) * 0.02) > best - 1e-3


def junk(random_, n):
    words = ["".join(random_.choice("aeioubcdfg") for _ in range(random_.randint(2, 6))) for _ in range(n)]
    return random_.choice([" ".join(w.upper() + "!!" for w in words), " ".join(words[0] for _ in words), "*** ".join(words)])


def prose(random_, n):
    return " ".join("".join(random_.choice("aeioubcdfg") for _ in range(random_.randint(2, 6))) for _ in range(n)) + "."


def test_quality_separates_and_is_calibrated(spark):
    random_ = random.Random(2)
    rows = [(i, junk(random_, 40) if i % 4 == 0 else prose(random_, random_.randint(3, 80))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (401, None, 0), (402, 0, 0), (402, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in docs.select("doc_id", quality.scored(model, docs, F.col("text")).alias("score")).collect()}
    new = [i for i in range(410, 600)]
    assert np.mean([(got[i] >= 0.3) == (i % 4 != 0) for i in new]) > 0.97
    again = quality.fit(docs.repartition(5), labels.repartition(3))
    assert np.allclose(again.weights, model.weights) and again.slope == pytest.approx(model.slope)


def test_quality_edges(spark):
    docs = edge_docs(spark)
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    none = one.where("doc_id < 0")
    for labels in (one, none):
        model = quality.fit(docs, labels)
        scores = [r[0] for r in docs.select(quality.scored(model, docs, F.col("text"))).collect()]
        assert len(set(scores)) == 1 and 0 < scores[0] < 1
    model = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int"))
    scores = [r[0] for r in docs.select(quality.scored(model, docs, F.col("text"))).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    empty = empty_docs(spark)
    assert empty.select(quality.scored(quality.fit(empty, none), empty, F.col("text"))).count() == 0


def test_quality_on_held_out_labels(spark):
    folder = SF.replace("sf0.001", "sf0.01")  # the smallest tables have too few bad documents to learn from
    docs = load(spark, folder, "documents")
    model = quality.fit(docs, training_labels(spark, folder))
    found = (docs.join(load(spark, folder, "labels"), "doc_id").where(held_out(F.col("doc_id"), 5, 0))
             .select("quality", quality.scored(model, docs, F.col("text")).alias("score")).collect())
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in found]) >= 0.95


# languages --------------------------------------------------------------------------------------

def code_length(train, text, least=1):
    """Bits of ``text`` by prediction by partial matching, byte by byte."""
    counts = {}
    for t in train:
        padded = [256] * langid.ORDER + list(t)
        for i in range(langid.ORDER, len(padded)):
            for n in range(langid.ORDER + 1):
                own = counts.setdefault(tuple(padded[i - n:i]), {})
                own[padded[i]] = own.get(padded[i], 0) + 1
    padded, bits = [256] * langid.ORDER + list(text), 0.0
    for i in range(langid.ORDER, len(padded)):
        for n in range(langid.ORDER, -1, -1):
            own = counts.get(tuple(padded[i - n:i]), {})
            if not own or n == langid.ORDER and sum(own.values()) < least:
                continue
            total, distinct = sum(own.values()), len(own)
            if padded[i] in own:
                bits -= np.log2(own[padded[i]] / (total + distinct))
                break
            bits -= np.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("chunk", [5, 1 << 19])
def test_code_lengths_are_exact(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    train = {"a": [b"abracadabra", b"cadabra abra", b"x"], "b": ["äöü über".encode(), b"abba"], "c": [b"zzz"]}
    counts = {lang: np.unique(langid._grams(texts), return_counts=True) for lang, texts in train.items()}
    tables = langid.Tables(counts, least=1)
    texts = [b"abra", b"abba cad", "ü qq \U0001f600".encode(), b"z", b"abracadabra" * 4, b"\x00\xff"]
    got = tables.lengths(texts)
    for i, text in enumerate(texts):
        for j, lang in enumerate(tables.languages):
            assert got[i, j] == pytest.approx(code_length(train[lang], text), rel=1e-5), (text, lang)


def test_languages_on_held_out_documents(spark):
    docs = load(spark, SF, "documents")
    tables = langid.fit(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    found = docs.where(held_out(F.col("doc_id"), 3, 1)).select("lang", langid.predicted(tables, docs, F.col("text")).alias("p")).collect()
    assert np.mean([r["lang"] == r["p"]["lang_pred"] for r in found]) >= 0.98
    assert all(0 <= r["p"]["score"] <= 1 for r in found)


def test_language_edges(spark):
    docs = edge_docs(spark)
    tables = langid.fit(docs)
    got = {r["text"]: r["p"] for r in docs.select("text", langid.predicted(tables, docs, F.col("text")).alias("p")).collect()}
    for text in (None, "", "  \t\n "):
        assert tuple(got[text]) == ("und", 0.0)
    assert got[LONG]["lang_pred"] == "en" and got["ÄÖÜ ß é 漢字 \U0001f600"]["lang_pred"] == "de"
    empty = empty_docs(spark)
    assert langid.fit(empty) is None
    assert docs.select(langid.predicted(None, docs, F.col("text")).alias("p")).where("p.lang_pred = 'und'").count() == docs.count()
    assert empty.select(langid.predicted(tables, empty, F.col("text"))).count() == 0
    again = langid.fit(docs.repartition(4))
    assert again.languages == tables.languages and np.array_equal(again.bits, tables.bits)


def test_numbers_and_marks_are_no_letters():
    for text in ("½ ²", "①", "Ⅷ", "\u0301", "😀 🇩🇪", "12 _", "٣", "-"):
        assert not langid.has_letter(text), text
    for text in ("a", "½ ② x", "ª", "漢", "ʰ", "ß", "_é"):
        assert langid.has_letter(text), text


def test_quality_fit_holds_little_beside_its_rows():
    """Rows as long as those of large texts: neither their places nor their values may be kept a second time."""
    random_ = np.random.default_rng(3)
    rows = [np.sort(random_.permutation(1 << quality.BITS)[:20_000]).astype(quality.NUMBER) for _ in range(200)]
    tracemalloc.start()
    model = quality.fit_rows(rows, np.arange(200) % 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(model.weights).all()
    assert most < 2 * sum(at.nbytes for at in rows)
