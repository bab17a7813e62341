"""Token files: zstandard frames that can be read one document at a time.

A file holds the ids of consecutive documents. Each document is cut into frames of at most FRAME_IDS
ids, little-endian, two bytes each where the vocabulary allows it, else four; every frame is an
independent zstandard frame. Behind them stand two skippable frames, so that plain zstandard tools read
the ids of the whole file: an index (documents, their ids and numbers of ids) and the seek table of the
zstandard seekable format, with compressed size, decompressed size and a checksum (low 32 bits of XXH64)
per frame. A reader of some documents reads index and table, then decompresses only their frames.

    frame ... frame | 0x184D2A50, size, index | 0x184D2A5E, size, entries, frames, flags, 0x8F92EAB1
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import filesystem, make_folder, stage

# fixed values of the seekable format
INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_IDS = 1 << 20
TEXT_BYTES = 32 << 20  # text per file
KNOWN_WORDS = 300_000  # words of a generation; a worker remembers two
CONTENTS = "part int, file string, documents long, ids long, bytes long"
DOCUMENTS = "doc_id long, first long, n_tokens long, ids_crc32 long, ids array<int>"


class Encoder:
    """Encodes whole texts word by word and remembers the ids of words.

    This is exact for tokenizers that lower-case and never join text across white space or between a letter
    and a point; ``exact_by_word`` tells whether a tokenizer's own description says so. Texts that could hold
    a special token, or a mark that composes with a letter before it, are encoded as they are, and so is every
    text with other tokenizers.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = exact_by_word(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.whole = [t.content.lower().encode() for t in added] + [b"\xcc", b"\xcd"]  # U+0300 to U+037F
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the newer generation lacks. Those of letters are one piece, which the model takes as it is but for
        the spelling of bytes beyond ASCII."""
        learned, others = {}, []
        tokenize, older, code = self.model.tokenize, self.older, self.dtype.char
        for word in words:
            if word in older:
                learned[word] = older[word]
            elif word.isalpha():
                learned[word] = array(code, [t.id for t in tokenize(word.decode())]).tobytes()
            elif _LETTERS.fullmatch(word):
                learned[word] = array(code, [t.id for t in tokenize(word.decode().lower().encode().decode("latin-1").translate(BYTE_LETTERS))]).tobytes()
            else:
                others.append(word)
        if others:
            learned.update(zip(others, self._ids([w.decode() for w in others]), strict=True))
        return learned

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as bytes."""
        lower = text.lower()  # bytes: ASCII only
        if not self.by_word or any(part in lower for part in self.whole):
            return self._ids([text.decode()])[0]
        pieces, words = _POINT.sub(rb" \g<0>", lower).split(), self.words
        missing = set(pieces).difference(words)
        if missing:
            words.update(self._learn(missing))
        ids = b"".join(map(words.__getitem__, pieces))
        if len(words) > KNOWN_WORDS:
            self.words, self.older = {}, words
        return ids


_LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"  # of ASCII and Latin-1, where lower case is one letter for one
_LETTERS = re.compile(_LETTER + rb"+")
_POINT = re.compile(rb"[.,;:!?](?=[ \n]|$)(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")  # alone between a letter and a blank
# How byte-level models spell bytes: the printable ones of Latin-1 as they are, the others from U+0100 on
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in _PRINTED)}


def exact_by_word(path: str) -> bool:
    """Whether a tokenizer lower-cases, drops all white space and splits letters from other signs, so
    that a text has the ids of its words one after another."""
    import json

    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    steps = (kind.get("normalizer") or {}).get("normalizers", [])
    splits = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = splits[0] if splits else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and first.get("behavior") == "Removed"
            and first.get("invert") is True and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and not any(s.get("use_regex") or s.get("add_prefix_space") for s in splits[1:])
            and not any(" " in t["content"] for t in kind["added_tokens"]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class FileWriter:
    """Writes one file; ``add`` takes a document's ids as bytes."""

    def __init__(self, out, dtype: np.dtype, level: int = 3):
        self.out, self.dtype, self.bytes = out, dtype, 0
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.documents: list[int | None] = []
        self.counts: list[int] = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        step = FRAME_IDS * self.dtype.itemsize
        for at in range(0, len(ids), step):
            frame = ids[at:at + step]
            packed = self.compressor.compress(frame)
            self._write(packed)
            self.frames.append((len(packed), len(frame), xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF))
        self.documents.append(doc_id)
        self.counts.append(len(ids) // self.dtype.itemsize)

    def finish(self) -> None:
        missing = np.array([d is None for d in self.documents], np.uint8)
        index = self.compressor.compress(
            struct.pack("<BIQ", self.dtype.itemsize, FRAME_IDS, len(self.documents)) + missing.tobytes()
            + np.array([d or 0 for d in self.documents], "<i8").tobytes() + np.array(self.counts, "<u8").tobytes())
        self._write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = np.array(self.frames, "<u4").tobytes()
        self._write(struct.pack("<II", TABLE_MAGIC, len(entries) + 9) + entries
                    + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE_MAGIC))


class Document(NamedTuple):
    doc_id: int | None
    first: int  # ids of the file before it
    ids: np.ndarray


class FileReader:
    """Reads index and seek table of a file; documents are decompressed on demand."""

    def __init__(self, source):
        self.source, size = source, source.size()
        self.unpack = zstandard.ZstdDecompressor().decompress
        tail = self._at(size - 9, 9)
        frames, flags, magic = struct.unpack("<IBI", tail)
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a token file")
        table = size - 9 - 12 * frames - 8
        self.entries = np.frombuffer(self._at(table + 8, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        place = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(place, 8))
        if magic != INDEX_MAGIC or place + 8 + length != table:
            raise ValueError("damaged token file")
        index = self.unpack(self._at(place + 8, length))
        width, self.frame_ids, n = struct.unpack_from("<BIQ", index)
        self.dtype, at = np.dtype(f"<u{width}"), 13
        missing = np.frombuffer(index, np.uint8, n, at)
        ids = np.frombuffer(index, "<i8", n, at + n).tolist()
        self.documents = [None if gone else d for d, gone in zip(ids, missing.tolist(), strict=True)]
        self.counts = np.frombuffer(index, "<u8", n, at + 9 * n).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.frame = np.concatenate([[0], np.cumsum(-(-self.counts // self.frame_ids))])

    def _at(self, place: int, length: int) -> bytes:
        self.source.seek(place)
        return self.source.read(length)

    def read(self, number: int) -> Document:
        """The ``number``-th document of the file, its frames checked against their checksums."""
        a, b = int(self.frame[number]), int(self.frame[number + 1])
        packed = self._at(int(self.starts[a]), int(self.starts[b] - self.starts[a]))
        parts, at = [], 0
        for size, length, checksum in self.entries[a:b].tolist():
            part = self.unpack(packed[at:at + size], max_output_size=length)
            if len(part) != length or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame of document {self.documents[number]} is damaged")
            parts.append(part)
            at += size
        return Document(self.documents[number], int(self.first[number]), np.frombuffer(b"".join(parts), self.dtype))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id",
                      text: str = "text", text_bytes: int = TEXT_BYTES) -> DataFrame:
    """Encode whole texts (null: empty), append ``end_id`` and write files in ascending order of the key,
    nulls last, equal keys in the order of their texts' hashes. Returns the table of contents (part, file,
    documents, ids, bytes), where the order of ``part`` is that of the ids. ``tokenizer`` is the path of a
    tokenizer file that all executors have. Only the two columns are read; an empty table writes nothing.
    """
    make_folder(folder)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("key"), content.cast("binary").alias("text"),
                       F.xxhash64(content).alias("tie"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("key").asc_nulls_last(), F.col("tie").asc()]
    parts = max(1, -(-total // text_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, writer, part = encoder(tokenizer), None, TaskContext.get().partitionId()
        last = np.array([end_id], code.dtype).tobytes()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for doc_id, value in zip(keys, batch.column("text"), strict=True):
                if writer is None:
                    system, inner = filesystem(folder)
                    name = f"{part:06d}-{uuid.uuid4().hex}.tok.zst"
                    out = system.open_output_stream(f"{inner}/{name}", compression=None)
                    writer = FileWriter(out, code.dtype)
                writer.add(doc_id, code.encode(value.as_py()) + last)
        if writer is not None:
            writer.finish()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"], "documents": [len(writer.counts)],
                "ids": [sum(writer.counts)], "bytes": [writer.bytes]})

    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")
    return stage(sorted_rows.mapInArrow(write, CONTENTS), "token-contents")


def read_token_files(contents: DataFrame, wanted: Sequence[int] | None = None, ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, first (ids of all documents before it), n_tokens, ids_crc32 (of the
    ids as unsigned 32-bit little-endian), ids (null if not asked for). ``wanted`` limits this to some doc
    ids, and then only their frames are read and decompressed."""
    before = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = contents.select("file", F.coalesce(before, F.lit(0)).alias("base"))  # one row per file
    chosen = None if wanted is None else frozenset(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            for file in batch.to_pylist():
                system, inner = filesystem(file["file"])
                with system.open_input_file(inner) as source:
                    reader, rows = FileReader(source), []
                    for number, doc_id in enumerate(reader.documents):
                        if chosen is not None and doc_id not in chosen:
                            continue
                        found = reader.read(number)
                        wide = found.ids.astype("<u4")
                        rows.append({"doc_id": doc_id, "first": file["base"] + found.first, "n_tokens": len(wide),
                                     "ids_crc32": zlib.crc32(wide.tobytes()), "ids": wide.tolist() if ids else None})
                        if len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = max(1, contents.count())
    return placed.repartition(files, "file").mapInArrow(read, DOCUMENTS)
