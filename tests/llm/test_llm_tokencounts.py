"""Token counts against the library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece
from brute import edge_docs, empty_docs
from conftest import SF
from pyspark.sql import functions as F

from scorekit.llm import queries, tokencounts
from scorekit.llm.common import load, python_workers

PATH = public_tokenizers.path(queries.PIECES)
ALPHABETS = ["ab", "theangr ", "▁ ab\t\n\r", "éèñ漢字\U0001f600x ", "0123456789.,;:!?(){}<>/ \r\n\t=-_", "abcdefghijklmnopqrstuvwxyz",
             "  　\x00́e", "<s></s><unk><0x0A>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_texts(library, alphabet):
    random.seed(len(alphabet))
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(1500)]
    assert tokencounts.model(PATH).counts(texts) == [len(library.encode(t)) for t in texts]


def test_repeats_and_long_texts(library):
    texts = [" " * k + w for k in range(70) for w in ("", "a", "the", "\n", "漢")]
    texts += [w * k for w in ("a", "the", "ab", "▁x", "é") for k in (*range(60), 20_000)] + [" " * 100_001, "▁" * 99_999 + "of"]
    assert tokencounts.model(PATH).counts(texts) == [len(library.encode(t)) for t in texts]


def test_batches_and_memory_do_not_change_counts(library, monkeypatch):
    monkeypatch.setattr(tokencounts, "BATCH_SYMBOLS", 7)
    monkeypatch.setattr(tokencounts, "KNOWN", 3)
    monkeypatch.setattr(tokencounts, "KNOWN_LENGTH", 4)
    counter = tokencounts.Merges(PATH)
    texts = ["one two three", "", None, "two three four " * 5, "extraordinarily long-worded"]
    for _ in range(2):
        assert counter.counts(texts) == [len(library.encode(t or "")) for t in texts]
        assert len(counter.known) <= 3 and all(len(w) <= 4 for w in counter.known)


def test_runs_of_blanks_without_blocks(library):
    counter = tokencounts.Merges(PATH)
    counter.blanks = 0
    texts = [" " * k + "x" for k in range(60)]
    assert counter.counts(texts) == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("docs", [edge_docs, empty_docs])
def test_edge_rows(spark, library, docs):
    python_workers(spark)
    rows = docs(spark).select("text", tokencounts.token_count(F.col("text"), PATH).alias("n")).collect()
    assert [r["n"] for r in rows] == [len(library.encode(r["text"] or "")) for r in rows]


def test_query(spark, library):
    got = queries.op13_token_counts(spark, SF).toPandas().set_index("doc_id")
    docs = load(spark, SF, "documents").toPandas()
    assert len(got) == len(docs) and list(got.columns) == ["n_bytes", "n_tokens", "over_limit"]
    for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
        n = len(library.encode(text))
        assert tuple(got.loc[doc_id]) == (len(text.encode()), n, n > 4096)
