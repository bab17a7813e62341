"""URL filter, mixing and sharding."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from brute import LONG, blank_words, capacity, edge_docs, empty_docs
from pyspark.sql import functions as F

from scorekit.llm import mixing, sharding, urls
from scorekit.llm.queries import URL_RULES, url_rules

PAGES = "page_id long, url string, html string, host string, rule string"


def judged(spark, addresses, rules=None):
    pages = spark.createDataFrame([(i, u, None, "x", "y") for i, u in enumerate(addresses)], PAGES)
    rows = urls.filter_urls(pages, rules or url_rules(spark)).orderBy("page_id").collect()
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


def test_hosts_paths_and_precedence(spark):
    got = judged(spark, ["http://a.example.net/en/1", "http://example.net/fr/", "https://NET/", "http://x.net", "http://xnet/",
                         "https://b.example.com/de/x?y#z", "http://example.com/", "ftp://a.org/fr/?q", "http://a.org/fr",
                         None, "", "no scheme.net/", "http://a.net?x=/", "http://a.net#/", "http://://net/", "http:///net/",
                         "http://a.net/\n/en/", "http://Ä.NET/Ü"])
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/fr/", "net/", "block"), ("net", "/", "net/", "block"),
        ("x.net", "", None, "allow"), ("xnet", "/", None, "allow"), ("b.example.com", "/de/x", "example.com/de/", "block"),
        ("example.com", "/", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"), ("a.org", "/fr", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "", None, "allow"),
        ("a.net", "", None, "allow"), (":", "//net/", None, "allow"), ("", "/net/", None, "allow"),
        ("a.net", "/\n/en/", "net/", "block"), ("Ä.net", "/Ü", "net/", "block")]


def test_any_rules_against_plain_matching(spark):
    random.seed(3)
    label = lambda: random.choice(["a", "b", "c"])
    rules = {(".".join(label() for _ in range(random.randint(1, 3))), "/" + "".join(random.choice("xy/") for _ in range(random.randint(0, 3)))):
             random.choice(["allow", "block"]) for _ in range(25)}
    addresses = ["http://" + ".".join(label() for _ in range(random.randint(1, 5))) + "/" + "".join(random.choice("xy/") for _ in range(4))
                 for _ in range(300)]
    table = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block")], "host string, path string, verdict string")
    for address, (host, path, rule, verdict) in zip(addresses, judged(spark, addresses, table), strict=True):
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items()
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (rule, verdict) == best[2:], address


def test_many_forms_of_rules(spark):
    random.seed(4)
    names = ["a", "bb", "co", "net", "x1"]
    rules = {(".".join(random.choices(names, k=random.randint(1, 6))), "/" + "p" * random.randint(0, 60)): random.choice(["allow", "block"])
             for _ in range(400)}
    table = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()], "host string, path string, verdict string")
    rows = [(i, f"http://{'.'.join(random.choices(names, k=random.randint(1, 8)))}/{'p' * random.randint(0, 70)}?q") for i in range(200)]
    found = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), table)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 40_000
    for r in found.collect():
        host, path = r["url"][7:-2].split("/", 1)
        fits = [(len(h + p), len(h), h + p) for h, p in rules if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        assert r["rule"] == (max(fits)[2] if fits else None)


def test_url_edge_tables(spark):
    empty = spark.createDataFrame([], PAGES)
    assert urls.filter_urls(empty, url_rules(spark)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert judged(spark, ["http://a.net/"], none) == [("a.net", "/", None, "allow")]
    long = "http://" + "a." * 5000 + "net/" + "p/" * 50_000
    assert judged(spark, [long, long])[1][2:] == ("net/", "block")
    assert len(URL_RULES) == 4


def targets_by_rounds(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, rest = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= set(over)
        rest -= sum(most * sizes[s] for s in over)


def test_targets_and_mix(spark):
    random.seed(5)
    rows = [(i, "w " * random.randint(0, 60), None, random.choice(["a", "a", "a", "b", "c", "ü", None]), 0, 0, None, 0, 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, edge_docs(spark).schema)
    plan = mixing.plan_mix(docs).collect()
    sizes, taken, words = Counter(), Counter(), {}
    for r in rows:
        sizes[r[3]] += len(blank_words(r[1]))
        words[r[0]] = len(blank_words(r[1]))
    expected = targets_by_rounds(sizes)
    for p in plan:
        assert (p["size"], p["source_size"]) == (words[p["key"]], sizes[p["source"]])
        assert p["target"] == pytest.approx(expected[p["source"]])
        assert 0 <= p["copies"] <= 2
        taken[p["source"]] += p["copies"] * p["size"]
    assert len(plan) == 3000
    assert all(abs(taken[s] - expected[s]) <= 150 for s in sizes)
    # the rows of the mix are those of the plan, whole
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {p["key"]: p["copies"] for p in plan if p["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
    assert sorted(mixing.plan_mix(docs.repartition(7)).collect(), key=str) == sorted(plan, key=str)


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    plan = mixing.plan_mix(docs)
    assert plan.count() == docs.count()
    copies = plan.agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs).count() == copies
    assert plan.where("size > 1000").select("size").first()[0] == len(blank_words(LONG))
    assert mixing.plan_mix(empty_docs(spark)).count() == 0
    assert mixing.mix(empty_docs(spark)).count() == 0
    none = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [tuple(r)[2:6] for r in mixing.plan_mix(none).collect()] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize(("grid", "shards"), [(4, 5), (50, 24), (8192, 3)])
def test_shards_are_minimax(spark, grid, shards):
    random.seed(grid)
    texts = [None, ""] + [str(random.randint(0, 150)) * random.randint(1, 40) for _ in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sharding.assign_shards(docs, shards, grid=grid).collect()
    sizes, where, slots, load = defaultdict(int), defaultdict(set), defaultdict(list), Counter()
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 8
        sizes[text] += r["size"]
        where[text].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert len(got) == len(texts) and all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = sorted(sizes, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    best = capacity([sizes[t] for t in order], shards)
    assert max(load.values()) <= best
    assert [min(where[t]) for t in order] == sorted(min(where[t]) for t in order)


def test_skewed_groups_bring_few_sums_to_the_driver(spark, monkeypatch):
    random.seed(9)
    sizes = [random.randint(50, 150) for _ in range(100_000)]
    mean = sum(sizes) / 0.9625 / 24
    sizes.insert(int(10.3 * mean / 100), int(0.9 * mean))  # one group of copies
    upto = [0]
    for size in sizes:
        upto.append(upto[-1] + size)
    sums = spark.createDataFrame([(u, n, s) for n, (u, s) in enumerate(zip(upto[1:], sizes, strict=True), 1)], "upto long, number long, size long")
    held, even = [], sharding._even_cuts
    monkeypatch.setattr(sharding, "_even_cuts", lambda bounds, *rest: held.append(len(bounds)) or even(bounds, *rest))
    cuts = sharding.minimax_cuts(sums.repartition(4), 24, grid=512)
    assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) == capacity(sizes, 24) > 1.01 * sum(sizes) / 24
    assert set(cuts) <= set(upto) and held[0] < 10_000


def test_sharding_edges(spark):
    docs = edge_docs(spark)
    got = sharding.assign_shards(docs, 24)
    assert got.count() == docs.count() and got.agg(F.max("shard")).first()[0] < 24
    assert sharding.assign_shards(empty_docs(spark), 24).count() == 0
    same = spark.createDataFrame([(i, "same") for i in range(50)], "doc_id long, text string")
    got = sharding.assign_shards(same, 4).collect()
    assert len({r["shard"] for r in got}) == 1 and sorted(r["slot"] for r in got) == list(range(50))
