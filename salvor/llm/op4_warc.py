"""WARC archives: a writer of compressed records, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, new_path, staged, table

REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member without content. Spark's text writer puts it between records, where it stands
#: for nothing, so that what the writer makes on any file system is a plain multi-member file.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
MAGIC, VERSION = b"\x1f\x8b\x08", rb"WARC/\d\.\d+\r\n"
#: Where a record may begin; one search for both, so that a file is passed over once.
PLAIN, START = re.compile(VERSION), re.compile(re.escape(MAGIC) + b"|" + VERSION)
#: Compressed bytes of an archive file, but for its last record, and the largest file that is read.
FILE_BYTES, READ_BYTES = 32 << 20, (1 << 31) - (1 << 20)
#: Characters of a digest by its algorithm, in hex and in base32.
_DIGESTS = {"md5": (32, 26), "sha1": (40, 32), "sha256": (64, 52), "sha512": (128, 103)}


def sha1_field(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_hex(value: str) -> tuple[str, str] | None:
    """Algorithm and lower-case hex of a digest field such as ``sha1:...`` in hex or base32, in any
    case and with or without padding; None where it can't be read."""
    name, _, text = value.strip().partition(":")
    name, text = name.strip().lower().replace("-", ""), text.strip().rstrip("=")
    if name not in _DIGESTS or len(text) not in _DIGESTS[name]:
        return None
    try:
        if len(text) == _DIGESTS[name][0]:
            return name, bytes.fromhex(text).hex()
        return name, base64.b32decode(text.upper() + "=" * (-len(text) % 8)).hex()
    except ValueError:
        return None


def page_urn(page_id: int | None) -> str:
    return f"<urn:salvor:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else page_urn(page_id)[1:-1]
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": page_urn(page_id), "WARC-Date": date,
        "WARC-Target-URI": uri, "WARC-Payload-Digest": sha1_field(payload), "WARC-Block-Digest": sha1_field(block),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": page_urn(refers_to)}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


@dataclass
class Found:
    """A record, or a gap of bytes that no valid record covers. Offsets are in the file: those of a
    member's records are the member's, and its length is the first one's, 0 for the others."""

    offset: int
    length: int
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    gap: str | None = None


class Damaged(ValueError):
    pass


def header(data: bytes, start: int) -> tuple[dict[str, str], int]:
    """The fields from ``start`` on, names in lower case, and where the block begins. A line that
    begins with white space goes on with the field before it; of a field that stands twice, the
    last counts. A header may be of any length; its first line without a colon ends the try."""
    fields, name = {}, None  # name: of the field that a folded line goes on with
    while (end := data.find(b"\r\n", start)) != start:
        if end < 0:
            raise Damaged("header without end")
        line = data[start:end]
        if line[:1] in (b" ", b"\t") and name is not None:
            fields[name] = f"{fields[name]} {line.decode('utf-8', 'replace').strip()}".strip()
        else:
            left, mid, value = line.partition(b":")
            if not mid:
                raise Damaged("header line without colon")
            name = left.decode("latin-1").strip().lower()
            fields[name] = value.decode("utf-8", "replace").strip()
        start = end + 2
    return fields, start + 2


def whole_number(text: str | None) -> int | None:
    """A count of bytes that fits a signed 64-bit number, else None."""
    text = (text or "").strip()
    return int(text) if text.isascii() and text.isdigit() and len(text) < 19 else None


def parse(data: bytes, at: int) -> Found:
    """The uncompressed record at ``at``, of any version. Checks the version line, fields, length,
    end mark and block digest; a digest of unknown kind or form can't be checked and isn't."""
    m = PLAIN.match(data, at)
    if not m:
        raise Damaged("no version line")
    fields, start = header(data, m.end())
    length = whole_number(fields.get("content-length"))
    if length is None:
        raise Damaged("no length")
    stop = start + length
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("no end mark where the length ends")
    block = data[start:stop]
    known = digest_hex(fields.get("warc-block-digest", ""))
    if known and hashlib.new(known[0], block).hexdigest() != known[1]:
        raise Damaged("block digest differs")
    return Found(at, stop + 4 - at, fields, block)


def member(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and its length; its own checksum must hold."""
    run, out, pos = zlib.decompressobj(31), [], at
    try:
        while not run.eof:
            if pos >= len(data):
                raise Damaged("member without end")
            out.append(run.decompress(data[pos : pos + (1 << 16)]))
            pos += 1 << 16
    except zlib.error as e:
        raise Damaged(f"bad member: {e}") from None
    return b"".join(out), min(pos, len(data)) - len(run.unused_data) - at


def at_offset(data: bytes, at: int, packed: bool) -> tuple[list[Found], int]:
    """The records at ``at``, one of a plain file or all of a gzip member with the gaps between
    them, and how many bytes they take. A member may be without content, but not of gaps alone."""
    if packed and data.startswith(MAGIC, at):
        inner, length = member(memoryview(data), at)
        found = list(spans(inner, False))
        if inner and all(f.gap is not None for f in found):
            raise Damaged(found[0].gap)
        for k, f in enumerate(found):
            f.offset, f.length = at, 0 if k else length
        return found, length
    one = parse(data, at)
    return [one], one.length


def spans(data: bytes, packed: bool) -> Iterator[Found]:
    """``salvage``; without ``packed``, of plain records alone."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            found, length = at_offset(data, at, packed)
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            place = (START if packed else PLAIN).search(data, at + 1)
            at = place.start() if place else len(data)
            continue
        if gap is not None:
            yield Found(gap, at - gap, gap=why)
            gap = None
        yield from found
        at += length
    if gap is not None:
        yield Found(gap, len(data) - gap, gap=why)


def salvage(content: bytes) -> Iterator[Found]:
    """All valid records of a file, compressed or not, with the gaps between them.

    Where checks fail, the next place is sought at which a gzip member or a version line begins
    a valid record; the bytes passed over are reported as one gap. What a member holds is searched
    in the same way, so it may be the whole file; a member whose own checksum fails is a gap.
    """
    return spans(content, True)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for each row of ``pages(page_id, url, html)`` to compressed files in ``path``.

    Payload is the html in UTF-8 (null: empty). Of equal payloads of 1000 bytes or more, the row
    with the largest page_id is the response, and the others, a row alike to it excepted, refer
    to it. Equal payloads meet as digests and lengths only. Nulls in page_id and url, empty
    pages and repeated rows make records like any other; an empty table makes no records. A file
    ends with the record that brings it to FILE_BYTES.
    """
    arrow_batches(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    same = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    same = staged(same.where("n > 1").select("digest", "bytes", "first"), "payloads")
    rows = rows.join(same, ["digest", "bytes"], "left").select("page_id", "url", "payload", "first", (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = bytearray()
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if file:
                    file += EMPTY_MEMBER
                file += gzip.compress(record(*(c.as_py() for c in row)), 6, mtime=0)
                if len(file) >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(file)], pa.binary())], ["members"])
                    file.clear()
        if file:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(file)], pa.binary())], ["members"])

    files = rows.mapInArrow(run, "members binary").select(F.col("members").cast("string"))
    files.write.options(lineSep=EMPTY_MEMBER.decode("latin-1"), encoding="ISO-8859-1", maxRecordsPerFile=1).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every quarantined gap of the files in ``path``: file, offset, length, gap
    (why the bytes were passed over; null for a record), page_id, record_type, refers_to,
    payload_bytes, payload_digest (hex), url, payload (null for a revisit).

    Payload is what follows the HTTP header of an HTTP record, and the whole block of another. What
    a header lacks or says in a form that can't be read is null, and no header ends the job; ids of
    foreign records are null. An empty file or folder gives no rows. A file is read whole into one
    task, whose memory it must fit: the writer above bounds its own. One that is larger than Spark
    reads whole (READ_BYTES) is a gap from its first byte to its last.
    """
    arrow_batches(spark)
    names = ["file", "offset", "length", "gap", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "payload"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    schema = ", ".join(f"{n} {'binary' if n == 'payload' else 'long' if t == pa.int64() else 'string'}" for n, t in zip(names, types, strict=True))

    def page(urn: str) -> int | None:
        m = re.fullmatch(r"<urn:salvor:page:(-?)(\d{1,18})>", urn)
        return int(m[1] + m[2]) if m else None

    def row(file: str, f: Found) -> tuple:
        if f.gap is not None:
            return (file, f.offset, f.length, f.gap) + (None,) * 7
        kind = f.fields.get("warc-type", "")
        http = f.fields.get("content-type", "application/http").lower().startswith("application/http")
        head, _, body = f.block.partition(b"\r\n\r\n") if http else (b"", b"", f.block)
        if kind == "revisit":
            m = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head)
            known = digest_hex(f.fields.get("warc-payload-digest", ""))
            size, digest, payload = whole_number(m[1].decode() if m else None), known[1] if known else None, None
        else:
            size, digest, payload = len(body), hashlib.sha1(body).hexdigest(), body
        refers = page(f.fields.get("warc-refers-to", ""))
        return (file, f.offset, f.length, None, page(f.fields.get("warc-record-id", "")), kind, refers, size, digest, f.fields.get("warc-target-uri"), payload)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                rows = []
                for f in salvage(content.as_py()):
                    rows.append(row(file.as_py(), f))
                    if len(rows) == 256:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(path)
    read = files.where(F.col("length") <= READ_BYTES).select("path", "content").mapInArrow(run, schema)
    large = files.where(F.col("length") > READ_BYTES)
    passed = {"file": F.col("path"), "offset": F.lit(0), "length": F.col("length"), "gap": F.lit("file too large to be read whole")}
    return read.unionByName(large.select(*[passed.get(x.name, F.lit(None)).cast(x.dataType).alias(x.name) for x in read.schema]))


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    out = read_archives(spark, path).where("gap is null")
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM r
"""
