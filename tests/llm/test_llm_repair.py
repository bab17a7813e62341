"""Conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from scorekit.llm import repair
from scorekit.llm.common import python_workers

TABLE = "conv_id long, turn long, role string, text string, conv string, copies string, part int, piece long, audit string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "p", ("p", "u"): "u"}


def cheapest(rows):
    """Least (cost, audit) for (initial, must go, truncated) rows, and the roles of what stays: from the right, over all edits."""
    @cache
    def rest(n, state, inserted):
        found = []
        if n == len(rows) and state in ("", "p"):
            found.append((0, "", ()))
        if inserted < 3:
            for r in "ua":
                if (state, r) in NEXT:
                    cost, audit, roles = rest(n, NEXT[state, r], inserted + 1)
                    found.append((cost + 5, "I" + audit, ((None, r), *roles)))
        if n < len(rows):
            initial, must, truncated = rows[n]
            cost, audit, roles = rest(n + 1, state, 0)
            found.append((cost + 2, "D" + audit, roles))
            for r, price, letter in () if must else ((initial, 0, "K"), ("u", 1, "R"), ("a", 1, "R")):
                if (state, r) in NEXT:
                    cost, audit, roles = rest(n + 1, NEXT[state, r], 0)
                    found.append((cost + price + 5 * truncated, letter + audit, ((n, "" if letter == "K" else r), *roles)))
        return min(found, key=lambda f: f[:2], default=(10 ** 9, "", ()))

    for n in reversed(range(len(rows))):  # so that no call goes deep
        for state in ("", "s", "u", "p"):
            rest(n, state, 0)
    return rest(0, "", 0)


def expected(rows):
    """Contract rows of a table of (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        part = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        kept += [(turn, "user" if part == 4 else role, text)] * (0 if part == 0 else 2 if part == 3 else 1)
    found = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            solid = re.findall("[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, roles = cheapest(tuple((r[1][:1] or "-", f in ("blank", "duplicate"), f == "truncated") for r, f in zip(kept, faults, strict=True)))
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names.get(r) or kept[n][1]}:{'' if n is None else kept[n][2]}" for n, r in roles]
        turns = [t for t, *_ in kept if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        found[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                       faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def got(spark, rows):
    python_workers(spark)
    table = spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], TABLE).repartition(3)
    found = repair.summary(repair.repair(repair.damage(table))).collect()
    assert len({r["conv"] for r in found}) == len(found)
    return {r["conv"]: tuple(r[c] for c in (*repair.TOTALS, "audit", "sha256")) for r in found}


def conversation(conv, n, roles=("user", "assistant", "system", "tool", "", None), texts=("Yes.", "No!", "So", "", " \n", None, "é?\t", "cut off")):
    return [(conv, random.choice((k, k, k, k + 3, None)), random.choice(roles), random.choice((random.choice(texts), f"Turn {k}.", f"turn {k}"))) for k in range(n)]


def test_parser_against_all_edits():
    random.seed(3)
    parse = repair.RoleParser()
    for _ in range(1500):
        rows = [(random.choice("suauat"), random.random() < .2, random.random() < .3) for _ in range(random.randint(0, 9))]
        states = [repair.MUST_GO if must else repair.TRUNCATED if cut else repair.FINE for _, must, cut in rows]
        frontier, trace = parse.read([(r[0], state, 1) for r, state in zip(rows, states, strict=True)], parse.start())
        cost, place = parse.finish(frontier)
        edits = parse.follow(trace, place)
        assert (cost, "".join(a for a, _ in edits) + parse.ends[frontier[place][0]][1]) == cheapest(tuple(rows))[:2]


def test_stacks_stay_few_and_other_grammars():
    parse = repair.RoleParser()
    parse.read([(r, repair.FINE, 1) for r in "uas" * 5000], parse.start())
    assert len(parse.steps) < 100
    alternating = repair.RoleParser((("S", ("u",)), ("S", ("S", "a", "u"))))
    frontier, _ = alternating.read([("u", repair.FINE, 1), ("u", repair.FINE, 1)], alternating.start())
    assert alternating.finish(frontier)[0] == 2
    with pytest.raises(ValueError):
        repair.RoleParser((("S", ("u", "S", "a")), ("S", ())))


@pytest.mark.parametrize("partitions,segment", [(1, 4096), (7, 4096), (7, 3), (5, 1)])
def test_random_conversations(spark, monkeypatch, partitions, segment):
    random.seed(partitions * segment)
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rows = [r for conv in [None, *range(60)] for r in conversation(conv, random.choice((1, 2, 5, 9)))]
    rows += conversation(100, 250) + conversation(101, 40, ("user",), ("Same.",))  # most of the rows in one conversation
    rows += [(102, 5, "user", "Again and again.")] * 60 + [(103, k, "assistant", "Hello.") for k in range(80)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spark, rows) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_tables(spark):
    assert got(spark, []) == {}
    dropped = next(k for k in range(1000) if zlib.crc32(f"7:{k}".encode()) % 20 == 0)
    for rows in ([(7, dropped, "user", "Hi.")], [(None, None, None, None)], [(1, None, "user", "A."), (1, None, "assistant", "B.")],
                 [(2, 1, "user", "x" * 3_000_000), (2, 2, "assistant", "y" * 3_000_000 + "."), (2, 3, "user", "z" * 3_000_000)]):
        assert got(spark, rows) == expected(rows)
    assert got(spark, [(7, dropped, "user", "Hi.")]) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_pieces_hold_the_repaired_turns(spark):
    python_workers(spark)
    rows = spark.createDataFrame([("c", 0, "assistant", "Hello.", 1), ("c", 1, "user", "Hi?", 1), ("c", 2, "user", "", 1)],
                                 "conv string, turn long, role string, text string, copies long")
    piece = repair.repair(rows).collect()
    assert [tuple(t) for p in piece for t in p["turns"]] == [("user", "Hello."), ("assistant", "Hi?")]
    assert [(p["cost"], p["audit"], p["blank"]) for p in piece] == [(4, "RRD", 1)]
