"""ARC archives (versions 1 and 2) converted to WARC, and WARC archives read back.

Archives are plain gzip files in the shared folder, written by Spark's text writer (a record ends where its declared
length says; the separator after it is the writer's line end) and read by Spark's binaryFile source, so any store that
Spark reaches will do. Inside a task a file is unpacked as a stream; at any time one record and a small batch are held.
"""
from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import delete, dropped, query, staged, table
from barloom.session import scratch_path

#: The record fields that the version block of an ARC file announces.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: revisit profile of the WARC 1.0 standard for identical payloads.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payloads below this many bytes are never written as revisits.
LEAST_REVISIT = 100
BATCH_BYTES = 4 << 20
#: Up to so many duplicated digests (40 bytes each) are sent to every executor; beyond, the records are shuffled.
BROADCAST_DIGESTS = 500_000

RECORD = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("ip", pa.string()), ("stamp", pa.string()),
                    ("content_type", pa.string()), ("status", pa.int32()), ("place", pa.string()), ("head", pa.binary()),
                    ("payload", pa.binary())])
RECORD_DDL = ("page_id long, uri string, ip string, stamp string, content_type string, status int, place string, "
              "head binary, payload binary")
NARROW_DDL = "page_id long, payload_bytes long, digest binary"
BACK = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("warc_date", pa.string()),
                  ("uri", pa.string())])
BACK_DDL = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "record_id string, warc_date string, uri string")


# --- small helpers that run inside tasks ------------------------------------------------------------------------------
class _Unpacked:
    """Bytes of a gzip file (one or many members, or plain) by line and by length, unpacked piece by piece."""

    def __init__(self, content: bytes):
        self.content, self.at, self.held, self.start = content, 0, b"", 0
        self.plain = content[:2] != b"\x1f\x8b"
        self.inflate = None if self.plain else zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.at >= len(self.content):
            return False
        piece = self.content[self.at:self.at + (1 << 18)]
        self.at += len(piece)
        if self.plain:
            fresh = piece
        else:
            fresh = self.inflate.decompress(piece)
            if self.inflate.eof:  # the next member begins in what was not used
                self.at -= len(self.inflate.unused_data)
                self.inflate = zlib.decompressobj(31)
        self.held = self.held[self.start:] + fresh
        self.start = 0
        return True

    def line(self) -> bytes | None:
        looked = self.start
        while (end := self.held.find(b"\n", looked)) < 0:
            looked = len(self.held) - self.start
            if not self._more():
                rest, self.start = self.held[self.start:], len(self.held)
                return rest or None
        out, self.start = self.held[self.start:end + 1], end + 1
        return out

    def take(self, n: int) -> bytes:
        if len(self.held) - self.start < n:
            parts, have = [self.held[self.start:]], len(self.held) - self.start
            while have < n:
                self.start = len(self.held)
                if not self._more():
                    raise ValueError("an archive ends inside a record")
                parts.append(self.held)
                have += len(self.held)
            whole = b"".join(parts)
            self.held, self.start = whole, n
            return whole[:n]
        out = self.held[self.start:self.start + n]
        self.start += n
        return out


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its empty line) and payload of a protocol response; without a head all is payload."""
    if block[:5] != b"HTTP/":
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def _field(head: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode() if m else None


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def arc_records(content: bytes, place: str) -> Iterator[dict]:
    """Records of an ARC file. The version block's second line names the version, which fixes the header's fields."""
    data, fields = _Unpacked(content), None
    n = 0
    while (line := data.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8").rstrip("\r\n").split(" ")
        block = data.take(int(parts[-1]))
        if parts[0].startswith("filedesc://"):
            fields = ARC_FIELDS[int(block.split(b"\n", 1)[0].split(b" ", 1)[0])].split(" ")
            continue
        if fields is None or len(parts) != len(fields):
            raise ValueError(f"{place}: a header of {len(parts)} fields")
        named = dict(zip(fields, parts, strict=True))
        head, payload = _http(block)
        status = named.get("Result-code") or (head[9:12].decode() if head else "")
        yield {"page_id": _number(_field(head, b"X-Page-Id")), "uri": named["URL"], "ip": named["IP-address"], "stamp": named["Archive-date"],
               "content_type": named["Content-type"], "status": int(status) if status.isdigit() else None,
               "place": f"{place}#{n}", "head": head, "payload": payload}
        n += 1


def warc_records(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record, by its declared Content-Length."""
    data = _Unpacked(content)
    while (line := data.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record must begin with its version")
        lines = [line]
        while (line := data.line()) not in (b"\r\n", b"\n", None):
            lines.append(line)
        header = b"".join(lines)
        yield header, data.take(int(_field(header, b"Content-Length")))


def _batches(rows: Iterator[dict], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _iso(stamp: str) -> str:
    """A 14-digit (or shorter, then filled up) ARC date as a WARC date."""
    full = stamp + "00000101000000"[len(stamp):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _page_uuid(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'urn:page:{page}')}>"


def _warc_record(r: dict) -> bytes:
    payload, head, first, page = r["payload"], r["head"], r["first_page"], r["page_id"]
    revisit = first is not None and page != first
    block = head if revisit else head + payload
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((r['uri'], r['stamp'], r['place'])))}>" if page is None else _page_uuid(page)
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {_iso(r['stamp'])}",
             f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha256:{r['digest'].hex()}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http; msgtype=response" if head else f"Content-Type: {r['content_type']}",
             f"X-Payload-Length: {len(payload)}"]
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_page_uuid(first)}", f"X-Refers-To-Page: {first}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


# --- writing and reading ----------------------------------------------------------------------------------------------
def write_arc(pages: DataFrame, path: str, stamp: str = "20000101000000", ip: str = "0.0.0.0") -> None:
    """A legacy archive of pages(page_id, url, html): one file a partition, versions 1 and 2 in turn.

    Null url: urn:page:none; blanks in an url are percent-encoded. Null html: an empty payload. Null page_id: no
    X-Page-Id line in the protocol head.
    """
    def pack(batches):
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        about = f"{version} 0 barloom\n{ARC_FIELDS[version]}\n"
        tail = f"200 - - 0 filedesc {len(about)}" if version == 2 else str(len(about))
        yield pa.RecordBatch.from_pydict({"value": pa.array([f"filedesc://part-{part}.arc {ip} {stamp} text/plain {tail}\n{about}".encode()], pa.binary())})
        n = 0
        for batch in batches:
            out = []
            for page, url, html in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
                payload = (html or "").encode()
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                target = re.sub(r"[\s\x00-\x20]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "urn:page:none")
                more = f"200 {zlib.crc32(payload):08x} - {n} part-{part}.arc " if version == 2 else ""
                out.append(f"{target} {ip} {stamp} text/html {more}{len(block)}\n".encode() + block)
                n += 1
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})
    pages.select("page_id", "url", "html").mapInArrow(pack, "value binary").select(F.col("value").cast("string")) \
        .write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Path and content of the archive files, about as many files a task as one split holds."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    def unpack(batches):
        for batch in batches:
            for place, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                yield from _batches(arc_records(content.as_py(), place.rsplit("/", 1)[-1]), RECORD, lambda r: len(r["payload"]) + 500)
    return _files(spark, path).mapInArrow(unpack, RECORD_DDL)


def arc_digests(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload bytes and SHA-256 of each ARC record, without the payload."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.binary())])

    def unpack(batches):
        for batch in batches:
            for place, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = ({"page_id": r["page_id"], "payload_bytes": len(r["payload"]), "digest": hashlib.sha256(r["payload"]).digest()}
                        for r in arc_records(content.as_py(), place))
                yield from _batches(rows, schema, lambda r: 500)
    return _files(spark, path).mapInArrow(unpack, NARROW_DDL)


def first_pages(digests: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(digest, first_page) of payloads of `least` bytes or more that several records have; sums combine before the shuffle.

    Records without a page id are never the first; where no record has one, all stay responses.
    """
    return digests.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n")) \
        .where("n > 1 AND first_page IS NOT NULL").select("digest", "first_page")


def convert(spark: SparkSession, arc: str, warc: str, least: int = LEAST_REVISIT) -> None:
    """WARC records for all records of the ARC files below `arc`, written below `warc`.

    From a record's header come WARC-Target-URI, WARC-IP-Address and WARC-Date (14 digits made ISO 8601); the identifier is
    a name-based UUID of the page id (without one: of uri, date, file and place), so a rerun gives the same; the type is response, or revisit where an
    equal payload has a smaller page id (rows that repeat the first page's id stay responses); digests are SHA-256.
    """
    firsts = staged(first_pages(arc_digests(spark, arc), least), "firsts")
    records = read_arc(spark, arc).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    side = F.broadcast(firsts) if firsts.count() <= BROADCAST_DIGESTS else firsts

    def write(batches):
        for batch in batches:
            rows = ({c: batch[c][i].as_py() for c in batch.schema.names} for i in range(batch.num_rows))
            yield from _batches(({"value": _warc_record(r)} for r in rows), pa.schema([("value", pa.binary())]), lambda r: len(r["value"]))
    records.join(side, "digest", "left").mapInArrow(write, "value binary").select(F.col("value").cast("string")) \
        .write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc)
    dropped(firsts)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """What each record says, checked against its block: digest and length of a response's payload are those of the bytes."""
    def unpack(batches):
        def rows(content):
            for header, block in warc_records(content):
                kind = _field(header, b"WARC-Type")
                size, digest = int(_field(header, b"X-Payload-Length")), _field(header, b"WARC-Payload-Digest").removeprefix("sha256:")
                if kind == "response":
                    payload = _http(block)[1] if b"application/http" in header else block
                    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError("a payload differs from its record's digest or length")
                yield {"page_id": _number(_field(header, b"X-Page-Id")), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
                       "refers_to": _number(_field(header, b"X-Refers-To-Page")), "record_id": _field(header, b"WARC-Record-ID")[1:-1],
                       "warc_date": _field(header, b"WARC-Date"), "uri": _field(header, b"WARC-Target-URI")}
        for batch in batches:
            for content in batch["content"]:
                yield from _batches(rows(content.as_py()), BACK, lambda r: 500)
    return _files(spark, path).mapInArrow(unpack, BACK_DDL)


SQL = """
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""


@query("op10_warc", SQL)
def op10_warc(spark, sf_dir):
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    convert(spark, arc, warc)
    delete(spark, arc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
