"""Plain Python versions of the operators, and tables full of edge cases."""

import re

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, key long, shard int"
LONG = "Lorem ipsum, dolor sit amet. " * 20_000


def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and columns whose names the
    operators use themselves."""
    extra = (7, "x", 8, 9)
    rows = [(1, "alpha beta gamma delta", "en", "a", 22, *extra), (1, "alpha beta gamma delta", "en", "a", 22, *extra),
            (2, "alpha beta gamma delta", "en", "a", 22, *extra), (3, "", "en", "b", 0, *extra),
            (4, None, "de", "b", None, None, None, None, None), (5, LONG, "en", "a", len(LONG), *extra),
            (6, "  \t\n ", "fr", None, 5, *extra), (None, "no id here", None, None, 10, *extra),
            (7, "ÄÖÜ ß é 漢字 \U0001f600", "de", "c", 10, *extra), (7, "another text of id seven", "en", "c", 10, *extra),
            (None, None, None, None, None, None, None, None, None), (8, "one", "en", "c", 3, *extra)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def blank_words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def letter_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fingerprint(text):
    words = blank_words(lower(text))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(values, distance=3):
    """Index of the first member of each value's component."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= distance) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def capacity(sizes, shards):
    """Smallest shard capacity for ordered sizes."""
    def fits(limit):
        used, held = 1, 0
        for s in sizes:
            if s > limit:
                return False
            if held + s > limit:
                used, held = used + 1, 0
            held += s
        return used <= shards

    low, high = 1, max(1, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low
