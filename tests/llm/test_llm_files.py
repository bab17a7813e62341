"""WARC archives and token files."""

import io
import zlib

import numpy as np
import pytest
import zstandard
from brute import edge_docs, empty_docs
from tokenizers import Tokenizer

from scorekit.llm import tokens, warc
from scorekit.llm.queries import END_ID, tokenizer_path

PAGES = "page_id long, url string, html string, digest string, key long, file string"


def fake(length, then=""):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: {length}\r\n\r\n{then}"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, "f") for i, u, h in rows], PAGES).repartition(3)


def check_pages(rows, got):
    first = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        first[payload] = i if payload not in first or first[payload] is None else first[payload] if i is None else min(i, first[payload])
    expected = sorted((str(i), len(p := (h or "").encode()), warc.digest_of(p), "response" if i == first[p] else "revisit",
                       None if i == first[p] else first[p]) for i, _, h in rows)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected


@pytest.mark.parametrize("range_bytes", [200, 1000, 4 << 20])
def test_round_trip_with_false_records(spark, tmp_path, range_bytes):
    inner = fake(5, "hello\r\n\r\n")
    rows = [(1, "http://a/", "plain"), (2, None, "plain"), (3, "u\r\nWARC-Type: revisit", inner * 20), (4, "u", fake(0)),
            (5, "u", "x" + fake(3, "abc\r\n\r\n") + fake(10 ** 9)), (6, "u", None), (7, "u", ""), (8, "u" * 300, "é漢\U0001f600" * 900),
            (None, "u", "plain"), (None, None, "only here"), (9, "u", "WARC/1.1\r\n" * 400), (10, "u", inner * 20)]
    folder = f"{tmp_path}/archive"
    got = warc.archive_pages(pages_of(spark, rows), folder, range_bytes, file_bytes=20_000).collect()
    check_pages(rows, got)
    assert {r["url"] for r in got if r["page_id"] == 3} == {"u%0D%0AWARC-Type: revisit"}


@pytest.mark.parametrize("range_bytes", [60, 500, 4 << 20])
def test_archives_from_elsewhere(spark, tmp_path, range_bytes):
    def record(block, *fields, version="1.0"):
        return f"WARC/{version}\r\n{''.join(f + chr(13) + chr(10) for f in fields)}Content-Length:{len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    inner = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + b"WARC/1.1\r\n" * 2000
    parts = [record(b"software: s\r\n", "WARC-Type: warcinfo"), record(b"GET / HTTP/1.1\r\n\r\n", "WARC-Type:request", "X-Page-ID: seven"),
             record(http + inner, "WARC-Type: response", "WARC-Target-URI: http://a/", version="1.1"), record(b"no blank line", "WARC-Type: response"),
             record(b"", "WARC-Type: revisit", "WARC-Payload-Digest: sha1:ABC"), record(b"", "WARC-Type: revisit"), record(b"k: v", "X-Page-ID: 12")]
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc").write_bytes(parts[0] + parts[2][:300])
    (tmp_path / "empty.warc").write_bytes(b"")
    got = warc.read_archives(warc.list_archives(spark, f"{tmp_path}/*.warc"), range_bytes, payloads=True).collect()
    rows = sorted((r["file"][-6], r["at"], r["record_type"], r["page_id"], r["url"], r["digest"], r["payload"]) for r in got)
    starts = [sum(map(len, parts[:k])) for k in range(len(parts))]
    content = [b"software: s\r\n", b"GET / HTTP/1.1\r\n\r\n", inner, b"no blank line", None, None, b"k: v"]
    kinds = ["warcinfo", "request", "response", "response", "revisit", "revisit", None]
    digests = [warc.digest_of(c) if c is not None else None for c in content]
    digests[4] = "ABC"
    expected = [("a", at, kind, 12 if kind is None else None, "http://a/" if k == 2 else None, digests[k], content[k])
                for k, (at, kind) in enumerate(zip(starts, kinds, strict=True))]
    assert rows == [*expected, ("b", 0, "warcinfo", None, None, digests[0], content[0])]


def test_short_payloads_do_not_revisit(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = warc.archive_pages(pages_of(spark, rows), f"{tmp_path}/archive", revisit_from=3).collect()
    assert {r["page_id"]: r["record_type"] for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "u", "a")]
    got = warc.archive_pages(pages_of(spark, rows), f"{tmp_path}/archive").collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response"), (1, "response"), (2, "revisit")]
    assert warc.archive_pages(pages_of(spark, rows).where("page_id < 0"), f"{tmp_path}/none").count() == 0


def test_long_header_and_damage(spark, tmp_path):
    rows = [(i, "u" * 200_000 if i == 3 else "u", f"payload {i} " * 50) for i in range(8)]
    contents = warc.write_archives(pages_of(spark, rows).coalesce(1), f"{tmp_path}/archive")
    assert warc.read_archives(contents, 1000).count() == 8
    whole = contents.first()
    data = open(whole["file"], "rb").read()
    with open(f"{tmp_path}/cut.warc", "wb") as f:
        f.write(data[:-100])
    cut = spark.createDataFrame([(f"{tmp_path}/cut.warc", len(data) - 100, 8)], warc.CONTENTS)
    assert warc.read_archives(cut, 1000).count() == 7
    records = warc.read_archives(contents, 1000, payloads=True).collect()
    assert {r["page_id"]: r["payload"].decode() for r in records} == {i: h for i, _, h in rows}


def test_damage_costs_no_record_before_it(spark, tmp_path):
    rows = [(i, "u", f"payload {i} " * 50 + fake(5, "x")) for i in range(8)]
    contents = warc.write_archives(pages_of(spark, rows).coalesce(1), f"{tmp_path}/archive")
    data = open(contents.first()["file"], "rb").read()
    starts = sorted(r["at"] for r in warc.read_archives(contents).collect())
    broken = data[:starts[5]] + b"?" * 40 + data[starts[5] + 40:]
    for name, content in (("payload", data[:-100]), ("header", data[:starts[7] + 20]), ("middle", broken)):
        with open(f"{tmp_path}/{name}.warc", "wb") as f:
            f.write(content)
    files = spark.createDataFrame([(f"{tmp_path}/payload.warc", len(data) - 100, 8), (f"{tmp_path}/header.warc", starts[7] + 20, 8),
                                   (f"{tmp_path}/middle.warc", len(data), 8)], warc.CONTENTS)
    for range_bytes in (2000, warc.RANGE_BYTES):
        got = sorted((r["file"].split("/")[-1], r["at"]) for r in warc.read_archives(files, range_bytes).collect())
        assert got == sorted([("payload.warc", a) for a in starts[:7]] + [("header.warc", a) for a in starts[:7]]
                             + [("middle.warc", a) for a in starts[:5]])


def expected_documents(docs):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return {key: tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID] for key, text in docs}


def test_token_files_round_trip(spark, tmp_path):
    texts = ["It's the dog's; they'll've gone!", "a\tb\x0bc\x1cd e f\n\n g", "é ́x Å ΑΣ ΑΣ. İ K", "<|endoftext|> x<|ENDOFTEXT|>y",
             "", None, "  ", "word. Word, WORD;word:word!?word...", "1234 ½ ２ 漢字かな \U0001f600!", "don't DON'T 're 'RE it'S", "abc" * 3000, "J\u030c j\u030c T\u0308! I\u0307", "end.", "a.b c,, d.\" e.\r\nf.\tg. \xa0h.\x85i", "x\x1c.y z."]
    docs = [(i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    contents = tokens.write_token_files(table, f"{tmp_path}/t", tokenizer_path(), END_ID, text_bytes=3000)
    assert contents.count() > 1
    got = tokens.read_token_files(contents).orderBy("doc_id").collect()
    start = 0
    for r, (key, ids) in zip(got, expected_documents(docs).items(), strict=True):
        assert (r["doc_id"], r["first"], r["n_tokens"], r["ids"]) == (key, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = tokens.read_token_files(contents, wanted=[3, 7]).collect()
    assert {r["doc_id"]: r["ids"] for r in some} == {k: v for k, v in expected_documents(docs).items() if k in (3, 7)}


def test_frames_checksums_and_plain_zstandard():
    out = io.BytesIO()
    writer = tokens.FileWriter(out, np.dtype("<u2"))
    documents = [np.arange(n, dtype="<u2") for n in (1, 0, 5000)]
    for i, ids in enumerate(documents):
        writer.add(i if i else None, ids.tobytes())
    writer.finish()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = tokens.FileReader(Source(out.getvalue()))
    assert reader.documents == [None, 1, 2]
    assert [reader.read(i).ids.tolist() for i in range(3)] == [d.tolist() for d in documents]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(d.tobytes() for d in documents)
    # a changed checksum is noticed
    data = bytearray(out.getvalue())
    data[-9 - 4] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        tokens.FileReader(Source(bytes(data))).read(2)


def test_long_documents_span_frames(monkeypatch):
    monkeypatch.setattr(tokens, "FRAME_IDS", 100)
    out = io.BytesIO()
    writer = tokens.FileWriter(out, np.dtype("<u4"))
    writer.add(1, np.arange(250, dtype="<u4").tobytes())
    writer.finish()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = tokens.FileReader(Source(out.getvalue()))
    assert len(reader.entries) == 3 and reader.read(0).ids.tolist() == list(range(250))


def test_token_edges(spark, tmp_path):
    docs = edge_docs(spark)
    got = tokens.read_token_files(tokens.write_token_files(docs, f"{tmp_path}/e", tokenizer_path(), END_ID)).orderBy("first").collect()
    keys = [r["doc_id"] for r in got]
    assert keys == sorted((k for k in keys if k is not None)) + [None, None]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    counts = sorted(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sorted(r["n_tokens"] for r in got) == counts
    contents = tokens.write_token_files(empty_docs(spark), f"{tmp_path}/none", tokenizer_path(), END_ID)
    assert tokens.read_token_files(contents).count() == 0


def test_word_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 3)
    code = tokens.Encoder(tokenizer_path())
    text = "one two three four five six seven eight. Nine! one two TEN ten, ten"
    expected = np.array(code.tokenizer.encode(text, add_special_tokens=False).ids, code.dtype).tobytes()
    assert code.by_word and all(code.encode(text.encode()) == expected for _ in range(3))
