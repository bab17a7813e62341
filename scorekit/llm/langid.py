"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to ORDER bytes, counted on a bounded sample and then
frozen. A byte is coded in the longest context the tree has; if it has not been seen there, an escape is
coded and the next shorter context tried, down to a uniform code over all bytes (method C: a context with n
occurrences of q distinct bytes gives a byte seen m times m / (n + q) and the escape q / (n + q)). A text
belongs to the language that codes it in the fewest bits; the score is the probability that equal priors
give it.

As statistics are frozen, the code length of a byte depends on the ORDER bytes before it alone. So all
escapes are resolved beforehand into one table (context, byte, language), and a text is scored by looking
up each of its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import hash_share
from scorekit.session import lookup_join

ORDER = 3
FIT_DOCS = 600  # documents per language
LEAST = 2  # occurrences that a context of ORDER bytes needs to enter the tree
START = 256  # stands for what is before a text; it is part of contexts but never coded
UNDETERMINED = "und"
CHUNK = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")  # also matches numbers like ½ and Ⅷ


def _grams(texts: list[bytes]) -> np.ndarray:
    """Every byte of the texts with the ORDER bytes before it, as one number."""
    parts = [np.full(ORDER, START, np.int64)]
    for t in texts:
        parts += [np.frombuffer(t, np.uint8).astype(np.int64), np.full(ORDER, START, np.int64)]
    flat = np.concatenate(parts)
    n = len(flat) - ORDER
    gram = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        gram = gram * 257 + flat[k:k + n]
    return gram[gram % 257 != START]


class Tables:
    """Code lengths in bits of each byte class after each context, for all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], least: int = LEAST):
        """``counts``: per language, numbers of ``_grams`` and how often each occurs."""
        self.languages = sorted(counts)
        digits = {lang: np.stack([grams // 257 ** (ORDER - k) % 257 for k in range(ORDER + 1)])
                  for lang, (grams, _) in counts.items()}
        seen = np.unique(np.concatenate([d[-1] for d in digits.values()]))
        # bytes that no sample has act alike in every context and share a class
        self.classes = len(seen) + 2
        other, start = self.classes - 2, self.classes - 1
        self.class_of = np.full(257, other, np.int64)
        self.class_of[seen] = np.arange(len(seen))
        self.class_of[START] = start
        size = self.classes
        mapped = {lang: self.class_of[d] for lang, d in digits.items()}
        context = {lang: (d[0] * size + d[1]) * size + d[2] for lang, d in mapped.items()}
        long = np.unique(np.concatenate([self._frequent(context[lang], counts[lang][1], least) for lang in counts]))
        self.row_of = np.tile(np.arange(size * size), size).astype(np.int32)  # the last two bytes
        self.row_of[long] = size * size + np.arange(len(long))
        bits = np.empty((size * size + len(long), size, len(self.languages)), np.float32)
        for number, lang in enumerate(self.languages):
            symbol, times = mapped[lang][-1], counts[lang][1]
            none = np.zeros(len(symbol), np.int64)
            order0 = self._extend(np.full((1, size), 8.0), none, symbol, times)
            order1 = self._extend(np.tile(order0, (size, 1)), mapped[lang][2], symbol, times)
            pair = mapped[lang][1] * size + mapped[lang][2]
            order2 = self._extend(np.tile(order1, (size, 1)), pair, symbol, times)
            at = np.searchsorted(long, context[lang])
            kept = np.flatnonzero((at < len(long)) & (long[np.minimum(at, len(long) - 1)] == context[lang])
                                  if len(long) else none > 0)
            order3 = self._extend(order2[long % (size * size)], at[kept], symbol[kept], times[kept])
            bits[:, :, number] = np.concatenate([order2, order3])
        self.bits = bits.reshape(-1, len(self.languages))

    @staticmethod
    def _frequent(contexts: np.ndarray, times: np.ndarray, least: int) -> np.ndarray:
        found, at = np.unique(contexts, return_inverse=True)
        return found[np.bincount(at, times, len(found)) >= least]

    @staticmethod
    def _extend(shorter: np.ndarray, context: np.ndarray, symbol: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Code lengths in contexts (rows) one byte longer than those of ``shorter``, which has the row of
        each context without its first byte. A context never seen costs nothing to leave."""
        rows, size = shorter.shape
        n = np.bincount(context * size + symbol, times, rows * size).reshape(rows, size)
        total, distinct = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        whole = np.maximum(total + distinct, 1)
        escape = np.log2(whole / np.maximum(distinct, 1))
        coded = np.log2(whole / np.maximum(n, 1))
        return np.where(n > 0, coded, shorter + escape)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each text takes in each language."""
        out, held, size = np.zeros((len(texts), len(self.languages))), 0, self.classes
        part: list[np.ndarray] = []
        owner: list[int] = []
        lead = np.full(ORDER, self.classes - 1, np.int64)

        def flush() -> None:
            if part:
                flat = np.concatenate(part)
                ends = np.cumsum([len(p) for p in part])
                n = len(flat) - ORDER
                context = (flat[:n] * size + flat[1:n + 1]) * size + flat[2:n + 2]
                bits = self.bits[self.row_of[context].astype(np.int64) * size + flat[ORDER:]]
                bits = np.concatenate([np.zeros((ORDER, bits.shape[1]), np.float32), bits])
                for number, end, p in zip(owner, ends.tolist(), part, strict=True):
                    out[number] += bits[end - len(p) + ORDER:end].sum(axis=0, dtype=np.float64)
                part.clear()
                owner.clear()

        for number, text in enumerate(texts):
            codes = self.class_of[np.frombuffer(text, np.uint8)]
            before = lead
            for at in range(0, len(codes), CHUNK):  # the bytes before a piece go with it
                piece = codes[at:at + CHUNK]
                part.append(np.concatenate([before, piece]))
                owner.append(number)
                before = np.concatenate([before, piece])[-ORDER:]
                held += len(piece)
                if held >= CHUNK:
                    flush()
                    held = 0
        flush()
        return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        fit_docs: int = FIT_DOCS, least: int = LEAST) -> Tables | None:
    """Tables of the languages in ``lang``, from the ``fit_docs`` documents of each whose ids hash smallest.

    Null texts, languages and ids are not learned from, nor are texts without bytes. Documents that share
    id and language count once, with the smallest text. None if nothing can be learned. The driver gets the
    summed counts of the sample, at most one per byte of it.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    filled = rows.where(F.octet_length("text") > 0).select("key", "lang")
    counts = filled.groupBy("lang").agg(F.count("*").alias("n"))
    by_hash = Window.partitionBy("lang").orderBy(hash_share("key"), "key")
    chosen = (lookup_join(filled, counts, "lang", "inner").where(hash_share("key") * F.col("n") < 4 * fit_docs)
              .select("key", "lang").distinct()
              .withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= fit_docs).drop("place"))
    sample = lookup_join(rows, chosen, ["key", "lang"], "inner").groupBy("key", "lang").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for name in sorted(set(langs)):
                grams, n = np.unique(_grams([texts[i] for i in np.flatnonzero(langs == name)]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(grams), "gram": grams, "n": n})

    found = (sample.select("lang", F.col("text").cast("binary").alias("text"))
             .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))).toArrow()
    names = found.column("lang").to_numpy(zero_copy_only=False)
    grams, times = found.column("gram").to_numpy(), found.column("n").to_numpy()
    if not len(names):
        return None
    return Tables({str(name): (grams[names == name], times[names == name]) for name in sorted(set(names))}, least)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def predicted(tables: Tables | None, docs: DataFrame, text: Column) -> Column:
    """Struct (lang_pred, score) of each text; ``und`` and 0 for a null text, one without a letter, or when
    nothing was learned. Of equally good languages the first by name."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        model, values = shared.value, texts.to_pylist()
        langs, scores = [UNDETERMINED] * len(values), [0.0] * len(values)
        known = [i for i, v in enumerate(values) if v and model and has_letter(v)]
        if known:
            bits = model.lengths([values[i].encode("utf-8", "surrogatepass") for i in known])
            best = bits.argmin(axis=1)
            chance = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
            for i, b, c in zip(known, best.tolist(), chance.tolist(), strict=True):
                langs[i], scores[i] = model.languages[b], c
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                          ["lang_pred", "score"])

    return predict(text)
