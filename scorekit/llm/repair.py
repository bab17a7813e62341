"""Repair of conversation structure: generalised LR parsing with weighted edits.

A conversation is in order if its roles are a sentence of the role grammar. The repair reads the rows once and
keeps, in a graph-structured stack, all stacks of the LR automaton that some edits of the rows so far lead to:
keep, rerole or delete a row, insert a turn before it. Stacks are nodes linked to what lies below them, so
equal stacks are one node, and of the edits that lead to one node the least by (cost, audit) stays. A stack
that another one can follow at a lower price, whatever comes, is left out.

Rows are sorted over ranges of (conversation, turn, role, text). A conversation that lies inside a range and
is not long is repaired there and then. Others are repaired in segments, each parsed from every stack it could
be entered with; their tables (entry, exit, cost, order of audits) are chained per conversation, and each
segment then writes its part of the repair. So a conversation may hold any share of all rows.

Audit: the initials of keep, rerole, delete and insert in order. Equal costs are decided by the smallest audit
in ASCII, and then there is just one repair, as an audit and the grammar determine the roles. Audits of equal
rows before equal positions end with an edit of a row, so none is the beginning of another and they can be
compared as they grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import stage

#: Role initials ``(s?(ua)+)?``; the first rule's head is the start symbol.
GRAMMAR = (("S", ()), ("S", ("P",)), ("S", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}  # roles that a turn can be given
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5  # costs; CUT_OFF is added to truncated rows that stay
FINE, MUST_GO, TRUNCATED = range(3)  # state of a row
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 4 << 20
SPACES = " \t\n\x0b\x0c\r"
MOST_STACKS = 1000
KNOWN_STEPS = 100_000
TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Frontier = tuple[tuple[int, int, int], ...]  # (stack, cost, rank of its audit) of the tops, by rank


class RoleParser:
    """LR automaton of a role grammar whose stacks are bounded, with the weighted edits of a row."""

    def __init__(self, grammar=GRAMMAR, given: str = "".join(ROLES)):
        self.rules = [("", (grammar[0][0],)), *grammar]
        self.heads = {head for head, _ in self.rules}
        self.terminals = sorted({x for _, body in grammar for x in body} - self.heads)
        self.given = given
        self.nodes: list[tuple] = []
        self.number: dict[tuple, int] = {}
        for node in self._settled((self._closed({(0, 0)}), None)):
            self._numbered(node)
        self.entries = list(range(len(self.nodes)))
        self.shifts: list[dict[str, list[int]]] = []
        for node in self.nodes:  # grows while it is read
            self.shifts.append({t: [self._numbered(n) for n in self._shifted(node, t)] for t in self.terminals})
        self.accepts = [any(self._accepted(n) for n in self._reduced(node)) for node in self.nodes]
        self.inserts = [self._insertions(s) for s in range(len(self.nodes))]
        self.ends = [min(((INSERT * len(r), "I" * len(r), r) for t, r in self.inserts[s].items() if self.accepts[t]), default=None)
                     for s in range(len(self.nodes))]
        self.worse = self._dominance()
        self.steps: dict[tuple[Frontier, str, int], tuple] = {}

    # The automaton: a node is (items of its state, node below)

    def _closed(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body):
                for n, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (n, 0) not in items:
                        items.add((n, 0))
                        todo.append((n, 0))
        return frozenset(items)

    def _after(self, state: frozenset, symbol: str) -> frozenset:
        return self._closed({(r, d + 1) for r, d in state if self.rules[r][1][d:d + 1] == (symbol,)})

    def _accepted(self, node) -> bool:
        return (0, 1) in node[0]

    def _reduced(self, node) -> list:
        """The node and all that reductions make of it."""
        found = [node]
        for node in found:
            for rule, dot in sorted(node[0]):
                head, body = self.rules[rule]
                if rule and dot == len(body):
                    below = node
                    for _ in body:
                        below = below[1]
                    new = (self._after(below[0], head), below)
                    if new not in found:
                        found.append(new)
        return found

    def _settled(self, node) -> list:
        """What reductions make of a node, as far as it can go on; the node itself if it can only end."""
        found = self._reduced(node)
        going = [n for n in found if any(self._after(n[0], t) for t in self.terminals)]
        return going or ([node] if any(map(self._accepted, found)) else [])

    def _shifted(self, node, terminal: str) -> list:
        state = self._after(node[0], terminal)
        return self._settled((state, node)) if state else []

    def _numbered(self, node) -> int:
        if node not in self.number:
            if len(self.nodes) == MOST_STACKS:
                raise ValueError("the stacks of this grammar are not bounded")
            self.number[node] = len(self.nodes)
            self.nodes.append(node)
        return self.number[node]

    # Edits

    def _insertions(self, stack: int) -> dict[int, str]:
        """Stacks that inserted turns lead to, with the fewest roles."""
        found = {stack: ""}
        for s in (todo := [stack]):
            for t in self.given:
                for n in self.shifts[s].get(t, []):
                    if n not in found:
                        found[n] = found[s] + t
                        todo.append(n)
        return found

    @cache  # noqa: B019 - one parser per worker
    def edits(self, stack: int, initial: str, state: int) -> list[tuple[int, int, str, str]]:
        """(next stack, cost, audit, roles) of the edits of a row; ``=`` stands for its own role. Insertions before
        a deletion are left out: behind it they cost the same and D comes before I."""
        found = {stack: (DELETE, "D", "")}
        if state != MUST_GO:
            extra = CUT_OFF if state == TRUNCATED else 0
            for s, roles in self.inserts[stack].items():
                n = len(roles)
                moves = [(t, INSERT * n + extra, "I" * n + "K", roles + "=") for t in self.shifts[s].get(initial, [])]
                moves += [(t, INSERT * n + RENAME + extra, "I" * n + "R", roles + g) for g in self.given for t in self.shifts[s].get(g, [])]
                for t, *move in moves:
                    found[t] = min(found.get(t, tuple(move)), tuple(move))
        return [(t, *move) for t, move in found.items()]

    def _dominance(self) -> list[list[float]]:
        """``worse[x][y]``: by how much more than the cheapest repair from stack x the cheapest one from y
        can cost, whatever rows follow; infinite if there is no such bound."""
        kinds = [(i, FINE) for i in (*self.terminals, "")] + [(i, TRUNCATED) for i in (*self.terminals, "")] + [("", MUST_GO)]
        n, never = range(len(self.nodes)), float("inf")
        end = [e[0] if e else never for e in self.ends]
        worse = [[0 if end[x] == never else end[y] - end[x] for y in n] for x in n]
        while True:
            new = [[max([worse[x][y]] + [min(v - c + worse[s][t] for t, v, *_ in self.edits(y, *kind)) for kind in kinds
                                         for s, c, *_ in self.edits(x, *kind)]) for y in n] for x in n]
            new = [[v if v < 100 else never for v in row] for row in new]
            if new == worse:
                return worse
            worse = new

    def start(self) -> Frontier:
        return tuple((s, 0, 0) for s in self.entries)

    def step(self, frontier: Frontier, initial: str, state: int) -> tuple[Frontier, int, tuple]:
        """The tops behind a row, the cost taken out of all of them, and for each top where it came from:
        (place in the frontier before, audit, roles)."""
        initial = initial if initial in self.terminals else ""
        key = (frontier, initial, state)
        if key not in self.steps:
            if len(self.steps) >= KNOWN_STEPS:
                self.steps.clear()
            self.steps[key] = self._step(*key)
        return self.steps[key]

    def _step(self, frontier, initial, state):
        best: dict[int, tuple] = {}
        for place, (stack, cost, rank) in enumerate(frontier):
            for target, more, audit, roles in self.edits(stack, initial, state):
                way = (cost + more, rank, audit, roles, place)
                best[target] = min(best.get(target, way), way)
        tops = sorted(((way[1:3], stack, way) for stack, way in best.items()
                       if not any(way[0] > w[0] + self.worse[stack][s] for s, w in best.items())))
        ranks = {order: r for r, order in enumerate(dict.fromkeys(order for order, *_ in tops))}
        least = min(way[0] for *_, way in tops)
        return (tuple((stack, way[0] - least, ranks[order]) for order, stack, way in tops), least,
                tuple((way[4], way[2], way[3]) for *_, way in tops))

    def read(self, rows: Iterable[tuple[str, int, int]], frontier: Frontier) -> tuple[Frontier, list[tuple]]:
        """Tops behind the rows (initial, state, copies) with whole costs, and a trace: (ways back, copies) per row. Copies
        beyond the first are deleted."""
        total, trace = 0, []
        for initial, state, copies in rows:
            frontier, cost, ways = self.step(frontier, initial, state)
            total += cost + DELETE * (copies - 1)
            trace.append((ways, copies))
        return tuple((s, c + total, r) for s, c, r in frontier), trace

    def finish(self, frontier: Frontier) -> tuple[int, int]:
        """Cost and place of the best top once turns are inserted up to the end of a sentence."""
        cost, *_, place = min((cost + end[0], rank, end[1], place) for place, (stack, cost, rank) in enumerate(frontier) if (end := self.ends[stack]))
        return cost, place

    @staticmethod
    def follow(trace: Sequence[tuple], place: int) -> list[tuple[str, str]]:
        """Audit and roles of every row, following the trace back from a top."""
        found = []
        for ways, copies in reversed(trace):
            place, audit, roles = ways[place]
            found.append((audit + "D" * (copies - 1), roles))
        return found[::-1]


@cache
def parser() -> RoleParser:
    """The worker's parser, kept between tasks."""
    return RoleParser()


# Rows


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults, for trials: conv, turn, role, text, copies. By crc32 of ``<conv>:<turn>`` modulo
    20 a row is dropped (0: no copies), emptied (1), loses its ``.!?`` (2), is repeated (3) or gets the role user
    (4). Nulls count as one space, but a null turn stays one. Other columns are not read."""
    blank = F.lit(" ")
    part = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in (conv, turn)]).cast("binary")) % 20
    content = F.coalesce(F.col(text), blank)
    return conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(part == 4, "user").otherwise(F.coalesce(F.col(role), blank)).alias("role"),
        F.when(part == 1, "").when(part == 2, F.translate(content, ".!?", "")).otherwise(content).alias("text"),
        F.when(part == 0, 0).when(part == 3, 2).otherwise(1).cast("long").alias("copies"))


def fault_of(text: Column) -> Column:
    """blank, truncated or null: what is wrong with a text on its own."""
    trimmed = F.rtrim(text, F.lit(SPACES))
    return F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")


class _Segment:
    """Rows of one conversation that stand together."""

    def __init__(self):
        self.turns, self.roles, self.texts, self.faults, self.copies, self.bytes = [], [], [], [], [], 0

    def add(self, turn, role, text, fault, copies) -> None:
        for values, value in zip((self.turns, self.roles, self.texts, self.faults, self.copies), (turn, role, text, fault, copies), strict=True):
            values.append(value)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.turns) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def firsts(self) -> list[bool]:
        """Whether role and text are new, row by row."""
        seen: set[tuple[str, str]] = set()
        return [(k not in seen, seen.add(k))[0] for k in zip(self.roles, self.texts, strict=True)]


def _states(faults: Sequence[str | None], firsts: Sequence[bool]) -> list[int]:
    return [MUST_GO if fault == "blank" or not first else TRUNCATED if fault else FINE for fault, first in zip(faults, firsts, strict=True)]


def _initials(roles: Sequence[str]) -> list[str]:
    return [r[:1] for r in roles]


def _tally(turns, roles, faults, copies, firsts) -> dict:
    """Counts of a run of rows, and of its ends what is needed to add those of the next run."""
    count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0)
    known = [t for t in turns if t is not None]
    count["distinct"] = len(set(known))
    for fault, n, first in zip(faults, copies, firsts, strict=True):
        if fault == "blank":
            count["blank"] += n
        else:
            count["duplicate"] += n - first
            count["truncated"] += bool(first and fault)
    initials = _initials(roles)
    count["illegal"] = sum(n - 1 for n in copies) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return count | {"turns": (known[0], known[-1]) if known else None, "initials": (initials[0], initials[-1]) if initials else None}


LEGAL = ("su", "ua", "au")  # initials that may follow one another


def _add(a: dict, b: dict) -> dict:
    both = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "distinct")}
    if a["initials"] and b["initials"]:
        both["illegal"] += a["initials"][1] + b["initials"][0] not in LEGAL
    if a["turns"] and b["turns"]:
        both["distinct"] -= a["turns"][1] == b["turns"][0]
    for ends in ("turns", "initials"):
        both[ends] = (a[ends][0], b[ends][1]) if a[ends] and b[ends] else a[ends] or b[ends]
    return both


def _totals(tally: dict, cost: int) -> dict:
    low, high = tally["turns"] or (0, -1)
    return {"gaps": high - low + 1 - tally["distinct"], **{k: tally[k] for k in TOTALS[1:5]}, "cost": cost}


def _turns(edits: Iterable[tuple[str, str]], roles: Sequence[str], texts: Sequence[str], closing: str = "") -> list[dict]:
    """The repaired turns that edits make of rows."""
    found = []
    for (_, new), role, text in zip(edits, roles, texts, strict=True):
        for r in new[:-1]:
            found.append({"role": ROLES[r], "text": ""})
        if new:
            found.append({"role": role if new[-1] == "=" else ROLES[new[-1]], "text": text})
    return found + [{"role": ROLES[r], "text": ""} for r in closing]


PIECE = [("piece", "long"), ("pieces", "long"), *[(t, "long") for t in TOTALS], ("audit", "string"), ("turns", "array<struct<role string, text string>>")]
SEGMENT = [("part", "int"), ("seg", "int"), ("at", "array<long>"), ("roles", "array<string>"), ("texts", "array<string>"),
           ("faults", "array<string>"), ("copies", "array<long>"), ("digests", "array<binary>")]
LISTS = {"at": pa.int64(), "roles": pa.string(), "texts": pa.string(), "faults": pa.string(), "copies": pa.int64(), "digests": pa.binary()}
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
         PIECE[-1][1]: pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))} | {
             f"array<{k}>": pa.list_(t) for k, t in (("long", pa.int64()), ("string", pa.string()), ("binary", pa.binary()), ("int", pa.int32()))}


def _ddl(columns) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)


def _batches(rows: Iterator[dict], columns, conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Record batches of some rows, held back until they hold many texts."""
    schema = pa.schema([("conv", conv), *[(n, ARROW[k]) for n, k in columns]])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(t["text"]) for t in row.get("turns") or ()) + sum(map(len, row.get("texts") or ()))
        if size > SEGMENT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def _repaired(segment: _Segment) -> dict:
    """A whole conversation's piece."""
    parse, firsts = parser(), segment.firsts()
    rows = zip(_initials(segment.roles), _states(segment.faults, firsts), segment.copies, strict=True)
    frontier, trace = parse.read(rows, parse.start())
    cost, place = parse.finish(frontier)
    edits = parse.follow(trace, place)
    _, inserted, roles = parse.ends[frontier[place][0]]
    tally = _tally(segment.turns, segment.roles, segment.faults, segment.copies, firsts)
    return {"piece": 0, "pieces": 1, **_totals(tally, cost), "audit": "".join(a for a, _ in edits) + inserted,
            "turns": _turns(edits, segment.roles, segment.texts, roles)}


def _parse_range(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Pieces of the conversations that lie inside a range of sorted rows, segments of the others."""
    part, number, segment, conv = TaskContext.get().partitionId(), 0, None, None
    cut = True  # the first conversation may have begun in the range before

    def stored() -> dict:
        s = segment
        return {"conv": conv, "part": part, "seg": number, "at": s.turns, "roles": s.roles, "texts": s.texts, "faults": s.faults,
                "copies": s.copies, "digests": [hashlib.md5(t.encode()).digest() for t in s.texts]}

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment is None:
                segment, conv = _Segment(), row[0]
            elif row[0] != conv:
                yield stored() if cut else {"conv": conv, **_repaired(segment)}
                number += cut
                segment, conv, cut = _Segment(), row[0], False
            elif segment.full():
                yield stored()
                number, segment, cut = number + 1, _Segment(), True
            if row[5]:
                segment.add(*row[1:])
    if segment is not None:
        yield stored()


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per segment, exits with cost and rank for every stack it could be entered with, and its tally."""
    parse = parser()
    for batch in batches:
        for s in batch.to_pylist():
            new = set(s["firsts"] or ())
            firsts = [n in new for n in range(len(s["at"]))]
            rows = list(zip(_initials(s["roles"]), _states(s["faults"], firsts), s["copies"], strict=True))
            table = []
            for entry in range(len(parse.nodes)):
                for stack, cost, rank in parse.read(rows, ((entry, 0, 0),))[0]:
                    table += [entry, stack, cost, rank]
            tally = _tally(s["at"], s["roles"], s["faults"], s["copies"], firsts)
            yield {"conv": s["conv"], "part": s["part"], "seg": s["seg"], "firsts": sorted(new), "table": table,
                   **{k: tally[k] for k in ("blank", "duplicate", "truncated", "illegal", "distinct")},
                   "turn_ends": list(tally["turns"] or ()), "initial_ends": list(tally["initials"] or ())}


TABLE = [("part", "int"), ("seg", "int"), ("firsts", "array<long>"), ("table", "array<long>"), ("blank", "long"), ("duplicate", "long"),
         ("truncated", "long"), ("illegal", "long"), ("distinct", "long"), ("turn_ends", "array<long>"), ("initial_ends", "array<string>")]
CHAIN = [("part", "int"), ("seg", "int"), ("firsts", "array<long>"), ("piece", "long"), ("pieces", "long"), *[(t, "long") for t in TOTALS],
         ("entry", "int"), ("exit", "int")]


def _chained(segments: list[dict]) -> Iterator[dict]:
    """The way of the best repair through the segments of one conversation."""
    parse, frontier, back, tally = parser(), parser().start(), [], None
    for s in segments:
        exits: dict[int, list[tuple]] = {}
        numbers = iter(s["table"])
        for entry, stack, cost, rank in zip(numbers, numbers, numbers, numbers, strict=True):
            exits.setdefault(entry, []).append((stack, cost, rank))
        best: dict[int, tuple] = {}
        for stack, cost, rank in frontier:
            for target, more, inner in exits.get(stack, ()):
                way = (cost + more, rank, inner, stack)
                best[target] = min(best.get(target, way), way)
        tops = sorted((way[1:3], stack, way) for stack, way in best.items())
        ranks = {order: r for r, order in enumerate(dict.fromkeys(order for order, *_ in tops))}
        frontier = tuple((stack, way[0], ranks[order]) for order, stack, way in tops)
        back.append({stack: way[3] for stack, way in best.items()})
        mine = {**s, "turns": s["turn_ends"] or None, "initials": s["initial_ends"] or None}
        tally = mine if tally is None else _add(tally, mine)
    cost, place = parse.finish(frontier)
    totals, at, found = _totals(tally, cost), frontier[place][0], []
    for n in reversed(range(len(segments))):
        s = segments[n]
        found.append({"conv": s["conv"], "part": s["part"], "seg": s["seg"], "firsts": s["firsts"], "piece": n, "pieces": len(segments),
                      **totals, "entry": back[n][at], "exit": at})
        at = back[n][at]
    yield from found


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Sorted segment tables; holds those of one conversation."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                yield from _chained(held)
                held = []
            held.append(row)
    if held:
        yield from _chained(held)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Pieces of segments whose entry and exit are known."""
    parse = parser()
    for batch in batches:
        for s in batch.to_pylist():
            new = set(s["firsts"] or ())
            firsts = [n in new for n in range(len(s["at"]))]
            rows = zip(_initials(s["roles"]), _states(s["faults"], firsts), s["copies"], strict=True)
            frontier, trace = parse.read(rows, ((s["entry"], 0, 0),))
            edits = parse.follow(trace, next(n for n, top in enumerate(frontier) if top[0] == s["exit"]))
            _, inserted, roles = parse.ends[s["exit"]] if s["piece"] == s["pieces"] - 1 else (0, "", "")
            yield {**{k: s[k] for k in ("conv", "piece", "pieces", *TOTALS)}, "audit": "".join(a for a, _ in edits) + inserted,
                   "turns": _turns(edits, s["roles"], s["texts"], roles)}


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations, in pieces: conv, piece (from 0), pieces (of the conversation), its totals gaps, blank,
    duplicate, truncated, illegal and cost, and the piece's audit and turns (array of role, text).

    ``rows`` has conv (integral or taken as text), turn (long), role, text and copies (adjacent repetitions; 0: the conversation exists, but not the row); other columns are
    not read. They are taken by turn, nulls first, equal turns by role and text. A null role or text counts as
    one space. A row is blank, or else a duplicate of a row with equal role and text before it, or else truncated if its last character
    that is no white space is none of ``.!?``. Blank rows and duplicates have to go. A role without a place in the grammar, like an
    empty one, can be given another or be deleted. A conversation of which no row is left has no turns,
    zeros and an empty audit; a null conv is a conversation like others. An empty table gives an empty one. Most conversations
    are one piece; long ones, and those that lie across two ranges of the sorted rows, are several. No task holds more
    of a conversation's rows than a segment, and besides only a short table for each of its segments.
    """
    kind = rows.schema["conv"].dataType
    id_type = "long" if kind.simpleString() in ("tinyint", "smallint", "int", "bigint") else "string"
    conv = ARROW[id_type]
    present = F.col("copies") > 0
    distinct = (rows.select(F.col("conv").cast(id_type).alias("conv"), F.when(present, F.col("turn")).alias("turn"),
                            F.when(present, F.coalesce("role", F.lit(" "))).alias("role"),
                            F.when(present, F.coalesce("text", F.lit(" "))).alias("text"), "copies")
                .groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    ranged = (distinct.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv", "turn", "role", "text", fault_of(F.col("text")).alias("fault"), "copies"))

    def mapped(df: DataFrame, function, columns) -> DataFrame:
        return df.mapInArrow(lambda batches: _batches(function(batches), columns, conv), f"conv {id_type}, {_ddl(columns)}")

    parsed = stage(mapped(ranged, _parse_range, PIECE + SEGMENT), "repair-parsed")
    names = ["conv", *[n for n, _ in PIECE]]
    segments = parsed.where(F.col("part").isNotNull()).select("conv", *[n for n, _ in SEGMENT])
    narrow = segments.drop("texts")
    places = narrow.select("conv", "part", "seg", F.posexplode(F.arrays_zip("roles", "digests")).alias("pos", "row"))
    firsts = (places.groupBy("conv", "row.roles", "row.digests").agg(F.min(F.struct("part", "seg", "pos")).alias("first"))
              .groupBy("first.part", "first.seg").agg(F.collect_list(F.col("first.pos").cast("long")).alias("firsts")))
    tables = mapped(narrow.drop("digests").join(firsts, ["part", "seg"], "left").select("conv", *narrow.columns[1:-1], "firsts"), _tables, TABLE)
    by_place = [F.col("conv").asc_nulls_first(), "part", "seg"]
    chain = stage(mapped(tables.repartition("conv").sortWithinPartitions(*by_place), _chain, CHAIN), "repair-chain")
    pieces = mapped(segments.drop("digests").join(chain.drop("conv"), ["part", "seg"]).select(
        "conv", "at", "roles", "texts", "faults", "copies", "firsts", "piece", "pieces", *TOTALS, "entry", "exit"), _written, PIECE)
    return parsed.where(F.col("part").isNull()).select(*names).unionByName(pieces.select(*names))


def _lines(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def summary(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv, the totals, the whole audit, and sha256 of the repaired turns as lines
    ``role:text``. A digest is sequential by nature, so the lines of a conversation in several pieces pass
    through one task, piece by piece; the pieces themselves are made elsewhere."""
    lines = pieces.withColumn("lines", F.when(F.size("turns") > 0, _lines(F.col("turns"))).cast("binary")).drop("turns")
    one = lines.where(F.col("pieces") == 1)
    columns = ["conv", *TOTALS, "audit"]
    conv = pa.int64() if dict(pieces.dtypes)["conv"] == "bigint" else pa.string()
    out = [*[(t, "long") for t in TOTALS], ("audit", "string"), ("sha256", "string")]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last, digest, audit, begun = None, None, [], False
        for batch in batches:
            for row in batch.to_pylist():
                if row["piece"] == 0:
                    if last is not None:
                        yield {**last, "audit": "".join(audit), "sha256": digest.hexdigest()}
                    last, digest, audit, begun = {k: row[k] for k in ("conv", *TOTALS)}, hashlib.sha256(), [], False
                if row["lines"] is not None:
                    digest.update((b"\n" if begun else b"") + row["lines"])
                    begun = True
                audit.append(row["audit"])
        if last is not None:
            yield {**last, "audit": "".join(audit), "sha256": digest.hexdigest()}

    several = (lines.where(F.col("pieces") > 1).select("conv", "piece", *TOTALS, "audit", "lines").repartition("conv")
               .sortWithinPartitions(F.col("conv").asc_nulls_first(), "piece"))
    several = several.mapInArrow(lambda batches: _batches(joined(batches), out, conv), f"conv {dict(pieces.dtypes)['conv']}, {_ddl(out)}")
    return one.select(*columns, F.sha2(F.coalesce("lines", F.lit(b"")), 256).alias("sha256")).unionByName(several)
