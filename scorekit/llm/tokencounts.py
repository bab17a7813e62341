"""Token counts of whole texts: rank-synchronous merging of ragged arrays.

For byte-pair models in the sentencepiece format. Normalized texts fall apart into pre-tokens where no
vocabulary piece can lie across. A batch of them is held as ragged numpy arrays, the symbols of all pre-tokens
one after another plus the pre-token each belongs to. In every step each pre-token applies its best-ranked
pair, all pre-tokens at once; finished ones leave the arrays and the symbols they are left with are counted.

A pair is applied at all its places in the pre-token, from the left and without overlap, but only up to a
place where the new symbol forms a pair that ranks as well or better with a neighbour: that one goes first.
So the order of merges, and with it the count, is always the library's.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"  # how normalized texts spell a blank
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values of the model format, as is BPE
BPE = 2
KNOWN = 300_000  # pre-tokens whose counts a worker remembers
KNOWN_LENGTH = 64  # longest of them
BATCH_SYMBOLS = 1 << 20  # symbols merged at once
NEVER = np.int64(1) << 40  # rank of symbols that do not merge


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 0x80:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            length = {1: 8, 5: 4}.get(tag & 7) or number()
            at += length
            yield tag >> 3, data[at - length:at]


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) of each id of a byte-pair model that falls back to bytes."""
    with open(path, "rb") as file:
        message = list(_fields(file.read()))
    trainer = dict(_fields(next(v for k, v in message if k == 2)))
    pieces = [dict(_fields(v)) for k, v in message if k == 1]
    found = [(p[1].decode(), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)) for p in pieces]
    if trainer.get(3) != BPE or not trainer.get(35) or {t for *_, t in found} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("only byte-pair models with byte fallback and without user-defined or unused pieces are supported")
    return found


class Merges:
    """The pairs of a model as arrays, and the counting."""

    def __init__(self, path: str):
        import sentencepiece

        self.normalize = sentencepiece.SentencePieceProcessor(model_file=path).normalize
        scores = {p: s for p, s, kind in read_model(path) if kind == NORMAL}
        order = sorted({-s for s in scores.values()})
        place = {s: r for r, s in enumerate(order)}
        rank = {p: place[-s] for p, s in scores.items()}  # smaller merges first; equal scores share a rank
        letters = sorted({c for p in scores for c in p})
        symbols = {s: i for i, s in enumerate([*letters, *[p for p in scores if len(p) > 1]])}
        self.width = len(symbols) + 1  # the last number stands for all other characters
        self.points = np.array([ord(c) for c in letters])
        self.weight = np.array([1 if s in scores else len(s.encode()) for s in symbols] + [0])
        pairs = sorted((symbols[p[:k]] * self.width + symbols[p[k:]], rank[p], symbols[p])
                       for p in scores for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.pair, self.rank, self.merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        enters = np.full(self.width, NEVER)  # best rank of the pairs that a symbol can enter
        for side in (self.pair // self.width, self.pair % self.width):
            np.minimum.at(enters, side, self.rank)
        self.settled = self.rank < enters[self.merged]  # places of such a pair do not disturb one another
        self.inside = np.array(sorted({ord(a) << 21 | ord(b) for p in scores for a, b in zip(p, p[1:], strict=False)}))
        self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if not any(SPACE in p.lstrip(SPACE) for p in scores) else r"(?s).+")
        self.known: dict[str, int] = {}
        self.blanks = 0
        self.blanks = self._longest_run(scores, rank)

    def _longest_run(self, scores, rank) -> int:
        """Length of the longest piece of blanks, if runs of blanks fall apart into such pieces from the left.

        That is so when blanks stand side by side in no other pieces and these merge last, with equal scores:
        then they grow from the left until none is longer. Else 0, and runs are merged like other text."""
        runs = [p for p in scores if SPACE * 2 in p]
        longest = max(map(len, runs), default=0)
        worst = max(rank.values())
        last = [p for p in scores if rank[p] == worst and len(p) > 1]
        if not longest or sorted(runs) != sorted(last) or any(p.strip(SPACE) for p in runs):
            return 0
        n = self.merge([SPACE * k for k in range(1, 4 * longest)]).tolist()
        return longest if all(n[k - 1] == 1 + n[k - longest - 1] for k in range(longest + 1, 4 * longest)) and n[longest - 1] == 1 else 0

    def _ragged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, sequence and weight of each character; sequences are the words, cut where no piece lies across."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words])
        first = np.zeros(len(points), bool)
        first[np.cumsum(lengths) - lengths] = True
        key = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.inside, key), len(self.inside) - 1)
        first[1:] |= self.inside[at] != key
        if self.blanks:  # a run of blanks is cut into blocks from its left
            blank = points == ord(SPACE)
            start = blank & (first | ~np.concatenate([[False], blank[:-1]]))
            index = np.arange(len(points))
            first |= blank & ((index - np.maximum.accumulate(np.where(start, index, 0))) % self.blanks == 0) & ~start
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        symbols = np.where(self.points[at] == points, at, self.width - 1)
        size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        weight = np.where(symbols == self.width - 1, size, self.weight[symbols])
        return symbols, np.cumsum(first) - 1, weight

    def _ranks(self, symbols: np.ndarray, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that starts at each symbol, and its number in the arrays of pairs."""
        key = symbols[:-1] * self.width + symbols[1:]
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        rank = np.where((self.pair[at] == key) & (sequence[:-1] == sequence[1:]), self.rank[at], NEVER)
        return np.append(rank, NEVER), np.append(at, 0)

    def _places(self, symbols, sequence, rank, number, chosen: np.ndarray) -> np.ndarray:
        """Those of the places ``chosen`` (best rank in their sequence, ascending) that merge in this step:
        every second one of overlapping places, up to the first in its sequence after which a pair with the
        new symbol comes before the places that are left."""
        row = np.concatenate([[True], (chosen[1:] != chosen[:-1] + 1) | (sequence[chosen[1:]] != sequence[chosen[:-1]])])
        index = np.arange(len(chosen))
        chosen = chosen[(index - np.maximum.accumulate(np.where(row, index, 0))) % 2 == 0]
        new, group = self.merged[number[chosen]], sequence[chosen]
        stops = np.zeros(len(chosen), bool)
        check = np.flatnonzero(~self.settled[number[chosen]])
        if len(check):
            at, made = chosen[check], new[check]
            bounded = np.concatenate([[-1], sequence, [-1, -1]])  # by place + 1
            padded = np.concatenate([[0], symbols, [0, 0]])
            left = padded[at]
            beside = np.concatenate([[False], chosen[1:] == chosen[:-1] + 2])[check]  # the place before merges right here
            left = np.where(beside, np.concatenate([[0], new[:-1]])[check], left)
            pairs = ((left, made, bounded[at] == group[check]), (made, padded[at + 3], bounded[at + 3] == group[check]))
            for a, b, joined in pairs:
                key = a * self.width + b
                found = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
                stops[check] |= joined & (self.pair[found] == key) & (self.rank[found] <= rank[at])
        first = np.concatenate([[True], group[1:] != group[:-1]])
        before = np.cumsum(stops) - stops  # stops before each place; those of earlier sequences do not count
        return chosen[before == np.maximum.accumulate(np.where(first, before, 0))]

    def merge(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each word."""
        symbols, sequence, weight = self._ragged(words)
        counts = np.zeros(int(sequence[-1]) + 1, np.int64)
        ends = np.cumsum([len(w) for w in words])
        last = sequence[ends - 1] + 1  # sequences up to each word's end
        while len(symbols):
            rank, number = self._ranks(symbols, sequence)
            starts = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
            lengths = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            done = best == NEVER
            if done.any():
                counts[sequence[starts[done]]] = np.add.reduceat(weight, starts)[done]
                keep = np.repeat(~done, lengths)
                symbols, sequence, weight, rank, number = symbols[keep], sequence[keep], weight[keep], rank[keep], number[keep]
                best, lengths = best[~done], lengths[~done]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            chosen = np.flatnonzero(rank == np.repeat(best, lengths))
            at = self._places(symbols, sequence, rank, number, np.flatnonzero(rank == np.repeat(best, lengths)))
            symbols[at] = self.merged[number[at]]
            weight[at] = self.weight[symbols[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, sequence, weight = symbols[keep], sequence[keep], weight[keep]
        before = np.concatenate([[0], np.cumsum(counts)])
        return before[last] - before[np.concatenate([[0], last[:-1]])]

    def counts(self, texts: list[str | None]) -> list[int]:
        """Number of tokens of each text; a null text has none."""
        known = self.known
        split = [self.split.findall(self.normalize(t)) if t else [] for t in texts]
        new = list(set().union(*split) - known.keys())
        begin = held = 0
        for end, word in enumerate(new, 1):
            held += len(word)
            if held >= BATCH_SYMBOLS or end == len(new):
                known.update(zip(new[begin:end], self.merge(new[begin:end]).tolist(), strict=True))
                begin, held = end, 0
        total = [sum(map(known.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > KNOWN_LENGTH:
                del known[word]
        if len(known) > KNOWN:
            known.clear()
        return total


_models: dict[str, Merges] = {}


def model(path: str) -> Merges:
    """The worker's model, kept between tasks."""
    if path not in _models:
        _models[path] = Merges(path)
    return _models[path]


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a whole text under the model at ``path`` (a file that all executors have), without
    begin and end tokens. Null and empty texts have none. The text alone counts: repeated rows have equal
    counts and other columns are not read. A text's pre-tokens are held in memory, not those of other rows
    beyond its Arrow batch.
    """
    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(model(path).counts(texts.to_pylist()), pa.int64())

    return count(text)
