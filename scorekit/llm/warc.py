"""WARC archives: writing with revisit records, and reading in parallel ranges.

Archives carry no index, and a range of one may start inside a payload that itself holds the magic of
a record. Tasks therefore read ranges of bytes and emit every candidate: an offset with a parsable
header, and the offset of its successor that the header implies. Inside a task the successors are
followed to the end of the range; across ranges, pointer jumping from the start of the file doubles
the hops of each join and keeps only what is reachable. Records are then read from the reachable
offsets on.

Archive names are unique to the attempt that wrote them, and only the table of contents that Spark
commits is read, so repeated tasks and lost executors leave no false archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm.common import filesystem, make_folder, shared_path, stage
from scorekit.session import lookup_join

MAGIC = b"WARC/1.1\r\n"
MAGICS = (MAGIC, b"WARC/1.0\r\n")
ANY_MAGIC = re.compile(b"WARC/1[.][01]\r\n")
END = b"\r\n\r\n"
HEADER_BYTES = 64 << 10  # read for a header at first; longer ones are read whole
FILE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENTS = "file string, bytes long, records long"
CANDIDATES = "file string, at long, to long, range_end long"
RECORDS = "file string, at long, page_id long, url string, record_type string, digest string, " \
          "refers_to long, payload_bytes long, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, digest: str, refers_to: int | None, revisit: bool,
            payload: bytes) -> bytes:
    """One record; URLs keep their text except for line ends, which are percent-encoded."""
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to)))
        block = b""
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                 + str(len(payload)).encode() + END + payload)
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return MAGIC + head.encode() + b"\r\n" + block + END


def parse_header(data: bytes, at: int = 0) -> tuple[dict[str, str], int] | tuple[()] | None:
    """Fields and length of the header at ``at``, an empty tuple if ``data`` ends in it, or None where no record can
    start. Nothing behind the first line that is no field is looked at."""
    if not data.startswith(MAGICS, at):
        return () if len(data) - at < len(MAGIC) else None
    fields, line = {}, at + len(MAGIC)
    while True:
        end = data.find(b"\r\n", line)
        if end < 0:
            return ()
        if end == line:
            break
        name, colon, value = data[line:end].partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").lower()] = value.decode("utf-8", "replace").strip()
        line = end + 2
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    return fields, end + 2 - at


def header_at(source, at: int, size: int) -> tuple[dict[str, str], int] | None:
    """The header at ``at`` of an open file, however long."""
    length = HEADER_BYTES
    while True:
        source.seek(at)
        head = parse_header(source.read(min(length, size - at)))
        if head != () or at + length >= size:
            return head or None
        length *= 4


def _number(field: str | None) -> int | None:
    return int(field) if field and re.fullmatch("-?[0-9]{1,18}", field) else None


def _payload(kind: str | None, block: bytes) -> bytes | None:
    """Payload of a record's block: of responses what follows the HTTP header, or all if it has none; revisits hold
    none; of other records the block."""
    if kind == "revisit":
        return None
    _, blank, body = block.partition(END) if kind == "response" else (block, b"", b"")
    return body if blank else block


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Table of contents of uncompressed archives in a folder or under a pattern, without the numbers of records."""
    return (spark.read.format("binaryFile").load(path).where("length > 0")
            .select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.lit(None).cast("long").alias("records")))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   revisit_from: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row and return the table of contents (file, bytes, records).

    The payload is the text in UTF-8, empty for null. Of the rows whose payloads are equal and have at
    least ``revisit_from`` bytes, the one with the smallest key is a response and the others revisit
    it. Rows that share key and payload are all responses if that key is the smallest; a null key comes
    after all others, and is a response where a payload has no other. Shorter payloads are responses.
    Only the three named columns are read. An empty table writes nothing.
    """
    make_folder(folder)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("sha1"))
    shared = (rows.where(F.octet_length("payload") >= revisit_from).groupBy("sha1")
              .agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1").select("sha1", "first"))
    dealt = lookup_join(rows, shared, "sha1", "left")
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = filesystem(folder)
        out = None
        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "sha1", "first", "revisit", "payload")]
            for i in range(batch.num_rows):
                page_id, address, sha1, first, again, content = (c[i].as_py() for c in columns)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc"
                    out, size, records = system.open_output_stream(f"{inner}/{name}", compression=None), 0, 0
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = _record(page_id, address, digest, first, again, content)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "bytes": [size], "records": [records]})
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "bytes": [size], "records": [records]})

    ready = dealt.select("key", "url", "sha1", "first", revisit.alias("revisit"), "payload")
    return stage(ready.mapInArrow(write, CONTENTS), "warc-contents")


def _ranges(contents: DataFrame, range_bytes: int) -> DataFrame:
    count = F.ceil(F.col("bytes") / range_bytes).cast("long")
    return (contents.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("part"))
            .select("file", "bytes", (F.col("part") * range_bytes).alias("start"),
                    F.least("bytes", (F.col("part") + 1) * range_bytes).alias("range_end")))


def _tasks(contents: DataFrame) -> int:
    """Tasks that read archives, one for each FILE_BYTES of them and for each archive."""
    files, size = contents.agg(F.count("*"), F.sum("bytes")).first()
    return max(1, files, (size or 0) // FILE_BYTES)


def candidates(contents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every offset at which a record may start, with the offset to which its successors lead at or
    after the end of the range (file, at, to, range_end). A chain that breaks inside its range has no
    successor (null): it enters no other range, but its records before the break are read."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                system, inner = filesystem(task["file"])
                start, end = task["start"], task["range_end"]
                with system.open_input_file(inner) as source:
                    source.seek(start)
                    # a header that starts in the range may end behind it
                    data = source.read(min(task["bytes"], end + HEADER_BYTES) - start)
                    found = {}
                    for magic in ANY_MAGIC.finditer(data):
                        at = magic.start()
                        if at >= end - start:
                            break
                        head = parse_header(data, at)
                        if head == ():
                            head = header_at(source, start + at, task["bytes"])
                        if head:
                            found[start + at] = start + at + head[1] + int(head[0]["content-length"]) + len(END)
                exits = {}
                for at in sorted(found, reverse=True):
                    to = found[at]
                    if to < end:
                        to = exits.get(to)
                    exits[at] = to if to is not None and to <= task["bytes"] else None
                yield pa.RecordBatch.from_pydict(
                    {"file": [task["file"]] * len(exits), "at": list(exits), "to": list(exits.values()),
                     "range_end": [end] * len(exits)},
                    schema=pa.schema([("file", pa.string()), ("at", pa.int64()), ("to", pa.int64()),
                                      ("range_end", pa.int64())]))

    ranges = _ranges(contents, range_bytes)
    return ranges.repartition(_tasks(contents), "file", "start").mapInArrow(scan, CANDIDATES)


def reachable(found: DataFrame) -> DataFrame:
    """Of the candidates, those that a chain from offset 0 of their file enters a range at.

    Each round joins the pointers with themselves, so they span twice as many ranges, and adds what
    the reachable offsets point to; a file of n ranges takes log2(n) rounds.
    """
    found = stage(found, "warc-candidates")
    entered = found.where(F.col("to").isNotNull()).select("file", F.col("to").alias("at")).distinct()
    starts = found.where("at = 0").select("file", "at")
    pointers = stage(found.select("file", "at", "to").join(entered.union(starts).distinct(), ["file", "at"]),
                     "warc-pointers")
    reached = starts
    while True:
        onward = reached.alias("r").join(pointers.alias("p"), ["file", "at"]).select("file", F.col("to").alias("at")).dropna()
        reached = stage(reached.union(onward).distinct(), "warc-reached")
        pointers = stage(pointers.alias("p").join(pointers.alias("q"), (F.col("p.file") == F.col("q.file"))
                                                  & (F.col("p.to") == F.col("q.at")))
                         .select("p.file", "p.at", "q.to"), "warc-pointers")
        if pointers.isEmpty():
            break
    return found.join(reached, ["file", "at"])


def read_archives(contents: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = False) -> DataFrame:
    """The records of the archives, found without an index: file, at, page_id, url, record_type, digest
    (base32 SHA-1 of the payload read, for revisits that of the header), refers_to, payload_bytes (null
    for revisits), payload (null unless asked for).

    The archives may come from elsewhere: records of any type and of WARC 1.0 are read, and fields that a header lacks, or
    page ids that are no numbers, are null. The payload of a record that is no response is its block, as is that of a response without a blank line.

    A damaged archive yields the records before the damage. One record is held at a time.
    """
    entries = reachable(candidates(contents, range_bytes)).select("file", "at", "range_end")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = dict(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                                 pa.int64(), pa.int64(), pa.binary()], strict=True))
        schema = pa.schema(list(kinds.items()))
        for batch in batches:
            for entry in batch.to_pylist():
                system, inner = filesystem(entry["file"])
                rows, held = [], 0
                with system.open_input_file(inner) as source:
                    size, at = source.size(), entry["at"]
                    data, base = b"", 0
                    while at < entry["range_end"]:
                        head = parse_header(data, at - base) if at - base < len(data) else None
                        if not head:  # the buffer ended before or in this header
                            source.seek(at)
                            data, base = source.read(min(RANGE_BYTES, size - at)), at
                            head = parse_header(data) or header_at(source, at, size)
                        if head is None:
                            break
                        fields, length = head
                        start, n = at + length, int(fields["content-length"])
                        if start + n - base <= len(data):
                            block = data[start - base:start - base + n]
                        else:
                            source.seek(start)
                            block = source.read(n)
                        at = start + n + len(END)
                        if len(block) < n or at > size:
                            break
                        kind = fields.get("warc-type")
                        content, known = _payload(kind, block), fields.get("warc-payload-digest")
                        rows.append({
                            "file": entry["file"], "at": start - length, "page_id": _number(fields.get("x-page-id")),
                            "url": fields.get("warc-target-uri"), "record_type": kind,
                            "digest": digest_of(content) if content is not None else known and known.removeprefix("sha1:"),
                            "refers_to": _number(fields.get("x-refers-to-page-id")),
                            "payload_bytes": None if content is None else len(content),
                            "payload": content if payloads else None})
                        held += n if payloads else 0
                        if len(rows) >= 1000 or held > RANGE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return entries.repartition(_tasks(contents), "file", "at").mapInArrow(read, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES, **options) -> DataFrame:
    """Write ``pages`` and read the archives back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url. Lengths of revisits are those of the response that they refer to."""
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    records = stage(read_archives(write_archives(pages, folder, **options), range_bytes).drop("payload"), "warc-records")
    known = (records.where("record_type = 'response'").groupBy("digest")
             .agg(F.max("payload_bytes").alias("response_bytes")))
    twice = known.join(records.where("record_type = 'revisit'").select("digest").distinct(), "digest", "left_semi")
    return (lookup_join(records, twice, "digest", "left")
            .select("page_id", F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"),
                    F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url"))
