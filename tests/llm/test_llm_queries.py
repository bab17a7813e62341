"""The registered queries on the smallest tables, and the pipeline."""

import base64
import hashlib
import zlib

import corpus_pipeline
import duckdb
import pytest
from brute import LONG, edge_docs, empty_docs, fingerprint, letter_words, roots
from conftest import SF
from test_llm_pairs import contamination_of

import __spark_entry__
from scorekit.llm import queries
from scorekit.llm.common import load

BY_NAME = {q.name: q for q in queries.QUERIES}


def table(spark, name):
    return load(spark, SF, name).toPandas()


@pytest.mark.parametrize("name", [q.name for q in queries.QUERIES if q.sql])
def test_queries_match_sql(spark, name):
    got = BY_NAME[name].run(spark, SF).toArrow()
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = connection.execute(BY_NAME[name].sql).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(got.column_names) == columns
    sort = lambda table: sorted(str([row[c] for c in columns]) for row in table.to_pylist())
    assert sort(got) == sort(expected)


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {q.name for q in queries.QUERIES} | {"pipeline"} <= set(names)
    assert {n for n in __spark_entry__.oracle_sql() if n.startswith("op")} == {q.name for q in queries.QUERIES if q.sql}


def test_op1(spark):
    pages = table(spark, "pages").sort_values("page_id")
    got = BY_NAME["op1_warc"].run(spark, SF).toPandas().set_index("page_id")
    first = {}
    for page, html in zip(pages["page_id"], pages["html"], strict=True):
        payload = html.encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row = got.loc[page]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), digest)
        assert row["record_type"] == ("revisit" if digest in first else "response")
        first.setdefault(digest, page)
    assert len(got) == len(pages)


def test_op6(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    items = list(zip(bench["item_id"], bench["text"], strict=True))
    windows = {tuple(w[k:k + 13]) for _, t in items for w in [letter_words(t)] for k in range(max(1, len(w) - 12))}
    got = BY_NAME["op6_decontam"].run(spark, SF).toPandas().set_index("doc_id")
    hits = 0
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        words = letter_words(text)
        row = got.loc[doc]
        assert row["n_words"] == len(words)
        if any(tuple(words[k:k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words))):
            n, hit, found = contamination_of(text, items)
            hits += 1
            assert (row["n_hit"], row["n_items"]) == (hit, len(found))
            assert row["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert row["contaminated"] == (20 * hit >= n)
        else:
            assert (row["n_hit"], row["contaminated"]) == (0, False)
    assert hits


def test_op7(spark):
    docs = table(spark, "documents").sort_values("doc_id")
    got = BY_NAME["op7_simhash"].run(spark, SF).toPandas().set_index("doc_id")
    prints, ids = [fingerprint(t) for t in docs["text"]], docs["doc_id"].tolist()
    assert [got.loc[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got.loc[i]["component_id"] for i in ids] == [ids[r] for r in roots(prints)]


def test_held_out_flags(spark):
    for name, modulus, rest in (("op4_quality", 5, 0), ("op10_langid", 3, 1)):
        got = BY_NAME[name].run(spark, SF).toPandas()
        assert len(got) == len(table(spark, "documents"))
        assert all(h == (zlib.crc32(str(i).encode()) % modulus == rest) for i, h in zip(got["doc_id"], got["held_out"], strict=True))


def test_pipeline_stages(spark):
    docs = load(spark, SF, "documents")
    columns, kept = docs.columns, docs
    counts = [docs.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stage(function(spark, kept, SF), f"test-{name}")
        assert kept.columns == columns
        counts.append(kept.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3]
    rows = kept.toPandas()
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF).toPandas()
    assert sorted(last["doc_id"]) == sorted(rows["doc_id"])
    # what is left has neither near copies nor contamination
    unique = rows.drop_duplicates("doc_id")
    prints = [fingerprint(t) for t in unique["text"]]
    assert len(set(roots(prints))) == len(prints)
    whole = corpus_pipeline.run(spark, SF).toPandas()
    sort = lambda df: df.sort_values(["start"]).reset_index(drop=True)
    assert sort(whole).equals(sort(last))


def test_stages_on_edge_tables(spark):
    for name, function in corpus_pipeline.STAGES:
        docs = edge_docs(spark)
        got = function(spark, docs, SF)
        if name != "tokens":
            assert got.columns == docs.columns
        assert got.count() <= 2 * docs.count()
        assert function(spark, empty_docs(spark), SF).count() == 0
    assert len(LONG) > 500_000
