"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from brute import edge_docs, empty_docs

from scorekit.llm import spelling
from scorekit.llm.common import python_workers

WORDS = "word string, n long, form string, id long, prefix long"


def words_of(docs, damage=97, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= min_count}


def variants_of(counts):
    """Every word tried against every deletion, and against every replacement by a mask."""
    masks = {}
    for w in counts:
        for i in range(len(w)):
            masks.setdefault((i, w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for (_, head, tail), found in masks.items():
        for w in found:
            near[w] |= found - {w}
            if head + tail in counts:
                near[w].add(head + tail)
                near[head + tail].add(w)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows)


def run(spark, counts):
    rows = [(w, n, "x", 1, 2) for w, n in counts.items()]
    found = spelling.spelling_variants(spark.createDataFrame(rows, WORDS).repartition(3)).collect()
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found)


@pytest.fixture
def many_ranges(spark):
    """Words in seven ranges however few they are."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("letters,longest", [("ab", 9), ("abcé", 7), ("abcdefghijklmnopqrstuvwxyzàÿ", 6)])
def test_against_all_pairs(many_ranges, letters, longest):
    random.seed(longest)
    counts = {"".join(random.choices(letters, k=random.randint(5, longest))): int(3 + 200 * random.random() ** 4) for _ in range(700)}
    assert run(many_ranges, counts) == variants_of(counts)


def test_ranges_share_nodes(many_ranges):
    words = [f"prefix{a}{b}suffix" for a in "abcdefgh" for b in "abcdefgh"] + ["prefix", "prefixasuffix", "suffix", "prefixprefix"]
    nodes, same = spelling.number_nodes(many_ranges.createDataFrame([(w,) for w in words], "word string"), "word", "nodes")
    number = {}
    for row in nodes.collect():
        for i, x in enumerate(row["nodes"]):
            assert number.setdefault(row["word"][:i], same.get(x, x)) == same.get(x, x)
    assert same and len(set(number.values())) == len(number)
    whole = {w: number[w] for w in words}
    assert sorted(whole, key=whole.get) == sorted(words)


def test_chains_ties_and_repeated_letters(spark):
    counts = {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "baaaaaa": 15, "aaaaaaaa": 31, "zzzzz": 5, "zzzzy": 9, "zzzzx": 10, "zzzzw": 10, "lonely": 4}
    got = run(spark, counts)
    assert got == variants_of(counts)
    assert {r[0]: r[2] for r in got}["aaaaa"] == "aaaaaaaa" and {r[0]: r[1] for r in got}["zzzzz"] == "zzzzw"


def test_long_words(spark):
    long = "abcdefghij" * 5_000
    counts = {long: 10, long + "x": 4, long[:70] + "q" + long[71:]: 5, long[1:]: 3, long * 2: 3}
    assert run(spark, counts) == variants_of(counts)


def test_no_words(spark):
    assert run(spark, {}) == []
    nothing = spelling.spelling_variants(spark.createDataFrame([(None, 5, "x", 1, 2)], WORDS))
    assert nothing.count() == 0 and nothing.columns == ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("docs", [edge_docs, empty_docs])
@pytest.mark.parametrize("damage,min_count", [(97, 3), (2, 1), (None, 2)])
def test_words_of_edge_rows(spark, docs, damage, min_count):
    python_workers(spark)
    table = docs(spark)
    found = spelling.count_words(table, damage=damage, min_count=min_count).collect()
    assert {r["word"]: r["n"] for r in found} == words_of([(r["doc_id"], r["text"]) for r in table.collect()], damage, min_count)


def test_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_LETTERS", 20)
    test_words_of_edge_rows(spark, edge_docs, 2, 1)
