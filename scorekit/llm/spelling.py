"""Spelling variants of a corpus's words: a trie-node pair dictionary.

The nodes of the trie of all words, and of the trie of the reversed words, are numbered. A word then has a
node for each of its prefixes and one for each of its suffixes. It enters the dictionary under the pairs
(prefix node, suffix node) that leave out one letter, and under those that leave out none. Words that share
a pair with a letter left out differ by a replacement there; a word whose left-out letter gives the pair that
another has without leaving one out differs from it by a deletion. No candidates have to be verified.

Tries are numbered along the sorted words: a word shares the nodes of the prefix that it has in common with
the word before, its other nodes are new. Tasks take ranges of the sorted words; of each only the first and
the last word come to the driver, which tells the nodes that ranges share. A pair has no more words than
there are letters, so no group is large, and every word of a group is compared with the best of it only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.functions.skew import spread_join
from scorekit.llm.common import stage

RUNS = re.compile("[a-zÀ-ÿ]+")  # in texts whose A-Z are lower-cased
HELD_LETTERS = 8 << 20  # letters of the words that a task counts before it passes the counts on
PART = 40  # bits of a node's number inside its range of words
BATCH = 1 << 16  # array elements in an Arrow batch


def damaged(word: str, prefix_crc: int, modulus: int) -> str:
    """``word`` without one letter if the crc32 of a prefix and it is divisible by ``modulus``."""
    h = zlib.crc32(word.encode(), prefix_crc)
    if h % modulus:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 5, min_count: int = 3,
                damage: int | None = 97) -> DataFrame:
    """Words of whole texts (word, n): runs of letters, A-Z lower-cased, with at least ``min_letters`` letters
    and ``min_count`` occurrences. With ``damage`` a run loses a letter in every row where that number divides
    the crc32 of ``<key>:<run>``; a null key is an empty text there. Null texts have no words, repeated rows
    count like others, other columns are not read.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = Counter(), 0

        def counted():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_key, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not content.is_valid:
                    continue
                runs = Counter(RUNS.findall(content.as_py().lower().decode()))
                crc = zlib.crc32(f"{'' if doc_key is None else doc_key}:".encode())
                for run, n in runs.items():
                    if len(run) < min_letters:
                        continue
                    word = damaged(run, crc, damage) if damage else run
                    if len(word) >= min_letters:
                        held[word] += n
                        letters += len(word) if held[word] == n else 0
                if letters > HELD_LETTERS:
                    yield counted()
                    held, letters = Counter(), 0
        yield counted()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("binary").alias("text"))
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _number_range(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[dict, list[int], bool]]:
    """Rows of one range of sorted words with the numbers of their prefixes' nodes, as if the range stood alone,
    and whether the row is the first or last."""
    number = (TaskContext.get().partitionId() << PART) + 1
    word, path, waiting = "", [0], None
    for batch in batches:
        for row in batch.to_pylist():
            before, word = word, row[name]
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            path = path[:shared + 1] + list(range(number, number + len(word) - shared))
            number += len(word) - shared
            if waiting:
                yield waiting
            waiting = (row, path, waiting is None)
    if waiting:
        yield (*waiting[:2], True)


def number_nodes(words: DataFrame, name: str, nodes: str) -> tuple[DataFrame, dict[int, int]]:
    """``words`` with the column ``nodes``, numbers of the trie nodes of all prefixes of column ``name``, the
    empty one first; and by which number to replace those that another range of words has numbered too.

    Words are distinct. Numbers of whole words ascend in code-point order. The driver gets two words of each range.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row, path, edge in _number_range(batches, name):
            rows.append({**row, nodes: path, "part": path[-1] >> PART, "edge": edge})
            size += len(path)
            if size >= BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    columns = [*words.dtypes, (nodes, "array<bigint>"), ("part", "bigint"), ("edge", "boolean")]
    schema = pa.schema([(c, kinds.get(t, pa.bool_())) for c, t in columns])
    staged = stage(words.repartitionByRange(name).sortWithinPartitions(name)
                   .mapInArrow(number, ", ".join(f"`{c}` {t}" for c, t in columns)), "spelling-nodes")
    edges = staged.where("edge").select("part", name, nodes).orderBy("part", name).collect()
    same: dict[int, int] = {}
    before, path = "", [0]  # last word of the ranges so far
    for k, row in enumerate(edges):
        word = row[name]
        if k == 0 or row["part"] != edges[k - 1]["part"]:
            shared = next((i for i, (a, b) in enumerate(zip(before, word, strict=False)) if a != b), min(len(before), len(word)))
            same.update(zip(row[nodes][1:shared + 1], path[1:shared + 1], strict=True))
        before, path = word, [same.get(x, x) for x in row[nodes]]
    return staged.drop("part", "edge"), same


def _replacing(same: dict[int, int]):
    olds = np.array(sorted(same), np.int64)
    news = np.array([same[x] for x in sorted(same)], np.int64)

    def replace(numbers: np.ndarray) -> np.ndarray:
        if not len(olds):
            return numbers
        at = np.minimum(np.searchsorted(olds, numbers), len(olds) - 1)
        return np.where(olds[at] == numbers, news[at], numbers)

    return replace


PAIRS = "prefix long, suffix long, whole boolean, deletes boolean, id long, n long"


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary of ``words`` (word, n), and the words with their numbers (id, word, n).

    A row of the dictionary is a prefix node, the suffix node behind it, ``whole`` (no letter is left out),
    ``deletes`` (leaving this letter out is how a deletion is written: of equal letters in a row only the
    first is), and the word's number and count.
    """
    forward, same_prefix = number_nodes(words.select("word", "n"), "word", "prefixes")
    backward = forward.select(F.reverse("word").alias("reversed"), "n", "prefixes")
    both, same_suffix = number_nodes(backward, "reversed", "suffixes")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix_of, suffix_of = _replacing(same_prefix), _replacing(same_suffix)
        for batch in batches:
            held, size = [], 0
            for row in zip(*(batch.column(c) for c in ("reversed", "n", "prefixes", "suffixes")), strict=True):
                word, n = row[0].as_py()[::-1], row[1].as_py()
                prefixes = prefix_of(row[2].values.to_numpy())
                suffixes = suffix_of(row[3].values.to_numpy())[::-1]
                letters, length = np.frombuffer(word.encode("utf-32-le"), np.uint32), len(word)
                held.append((np.concatenate([prefixes[:-1], prefixes]), np.concatenate([suffixes[1:], suffixes]),
                             np.arange(2 * length + 1) >= length,
                             np.concatenate([[True], letters[1:] != letters[:-1], np.zeros(length + 1, bool)]),
                             np.full(2 * length + 1, prefixes[-1]), np.full(2 * length + 1, n)))
                size += 2 * length + 1
                if size >= BATCH:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

    def packed(held):
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["prefix", "suffix", "whole", "deletes", "id", "n"])

    numbered = both.select("reversed", "n", "prefixes", "suffixes").mapInArrow(pairs, PAIRS)
    return numbered, forward.select(F.element_at("prefixes", -1).alias("id"), "word", "n")


def _found(of: Column, n: Column, best: Column) -> Column:
    """What a word learns from one pair: number of near words, and the best of them."""
    return F.struct(of["id"].alias("id"), n.cast("long").alias("near"), best["minus_n"].alias("minus_n"), best["id"].alias("best"))


def near_words(pairs: DataFrame) -> DataFrame:
    """Per word that has near ones: id, n_near, and best_n and best_id of the most frequent, ties to the
    smallest in code-point order. A group holds at most one word per letter and one more."""
    entry = F.struct((-F.col("n")).alias("minus_n"), "id", "whole", "deletes")
    groups = (pairs.groupBy("prefix", "suffix").agg(F.array_sort(F.collect_list(entry)).alias("all"))
              .where(F.size("all") > 1)
              .select(F.filter("all", lambda m: ~m["whole"]).alias("shorter"), F.filter("all", lambda m: m["whole"]).alias("whole"))
              .withColumn("longer", F.filter("shorter", lambda m: m["deletes"])))
    shorter, whole, longer = F.col("shorter"), F.col("whole"), F.col("longer")
    none = F.struct(F.lit(None).cast("long").alias("minus_n"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("boolean").alias("whole"),
                    F.lit(None).cast("boolean").alias("deletes"))

    def other(m):  # best of the words with another letter
        return F.when(F.size(shorter) < 2, none).when(shorter[0]["id"] == m["id"], F.get(shorter, F.lit(1))).otherwise(shorter[0])

    replaced = F.when(F.size(shorter) > 1, F.transform(shorter, lambda m: _found(m, F.size(shorter) - 1, other(m))))
    deleted = F.when(F.size(whole) > 0, F.transform(longer, lambda m: _found(m, F.lit(1), F.get(whole, F.lit(0)))))
    inserted = F.when(F.size(longer) > 0, F.transform(whole, lambda m: _found(m, F.size(longer), F.get(longer, F.lit(0)))))
    found = groups.select(F.explode(F.concat(*[F.coalesce(x, F.array()) for x in (replaced, deleted, inserted)])).alias("f")).select("f.*")
    return (found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min(F.struct("minus_n", "best")).alias("b"))
            .select("id", "n_near", (-F.col("b.minus_n")).alias("best_n"), F.col("b.best").alias("best_id")))


def last_of(forms: DataFrame) -> DataFrame:
    """Per word with a form (id, form): where following forms ends (id, root), by pointer jumping. Chains get
    twice as frequent with each step, so they are short and without circles."""
    reached = stage(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("further"))
        jumped = stage(spread_join(reached, ahead, ["root"]), "spelling-roots")
        reached = jumped.select("id", F.coalesce("further", "root").alias("root"))
        if jumped.where("further IS NOT NULL").isEmpty():
            return reached


def spelling_variants(words: DataFrame, ratio: float = 2) -> DataFrame:
    """Per distinct word of ``words`` (word, n; other columns are not read): word, form, root, n, n_near, form_n.

    Words are near if they differ by one inserted, deleted or replaced code point. A word's form is its most
    frequent near word (ties: smallest in code-point order) if that is at least ``ratio`` times as frequent,
    ``ratio`` being over 1; root is where following forms ends, the word itself without a form. Null words are left
    out, an empty table gives an empty one, a word may be of any length.
    """
    pairs, numbered = node_pairs(words.where(F.col("word").isNotNull()))
    numbered = stage(numbered, "spelling-words")
    near = near_words(pairs)
    has_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    known = stage(numbered.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best_id")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "spelling-near")
    roots = last_of(known.where(F.col("form").isNotNull()))
    joined = known.withColumnRenamed("form", "form_id").join(roots.withColumnRenamed("root", "root_id"), "id", "left")
    for name in ("form", "root"):
        joined = spread_join(joined, numbered.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name)), [f"{name}_id"])
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
