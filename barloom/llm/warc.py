"""WARC archives: a writer with payload deduplication and a reader that salvages damaged files.

Writing. Every page becomes a record in a gzip member of its own; Spark's text sink writes the members, about a
``CHUNK`` of bytes to a line and with an empty member as the line separator, so files go to any store Spark can write and
through its commit protocol. This relies on the sink writing a string's characters as single bytes in ISO-8859-1, with nothing
added; a test holds it to that for all 256 byte values. A file gets ``file_bytes // CHUNK`` lines, and a longer member is followed by as many
empty lines as it has chunks, so that a file has at most ``file_bytes`` and one member.
Of records with equal payloads of at least ``min_bytes`` the one with the largest id is a response and the
others revisit it, without the payload. Equal payloads are found by a grouped maximum on the digest, of those that
occur twice alone; where these are few enough to be broadcast, payloads are not shuffled, else the join can be split where
one payload is common.

Reading. A file is read member by member, or version line by version line where it is not compressed. A
record counts only if its member inflates to the end and passes its checksum, its length and end marks fit
and its digests match. After a failure the reader searches for the next member or version line at which a
valid record starts, goes on from there, and reports the bytes in between as a gap.

Bounds: a task holds one file at a time, in the JVM, in Arrow and in Python (files of other writers are taken as they
are, up to the 2 GiB that Spark reads of a file); a member that inflates beyond ``max_member`` is a gap. An archive that is known to be one's own can be
read without that bound.

Defined results: a null page is empty; a null id is written ``null`` and read as null, sorts below all ids,
and only refers to others; rows that repeat an id stay separate records and those with the largest id are
all responses; a null address is left out; other columns are ignored; an empty table writes no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import stage

MAX_MEMBER = 1 << 30
CHUNK = 1 << 20
STEP = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
ROWS = ("path string, kind string, offset long, length long, reason string, record_type string, record_id string, refers_to string, "
        "url string, payload_bytes long, payload_digest string, payload binary")


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(record_id: str, url: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record; with ``refers_to`` a revisit that leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to)]
    head += [("WARC-Payload-Digest", _digest(payload)), ("WARC-Block-Digest", _digest(block)),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 1000, level: int = 4, file_bytes: int = 64 << 20) -> None:
    """Write a record for every row below ``path``, in files of at most ``file_bytes`` and one member."""
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    given = given.withColumn("digest", F.sha1("payload"))
    common = stage(given.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "common-payloads")
    later = F.col("first_id").isNotNull() & F.coalesce(F.col("page_id") < F.col("first_id"), F.lit(True))
    judged = given.join(common, "digest", "left").select("page_id", "url", "payload", F.when(later, F.col("first_id")).alias("refers_to"))

    chunk, lines = min(CHUNK, file_bytes), max(1, file_bytes // CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(members: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["line"])

        held, size = [], 0
        for batch in batches:
            for r in (r for begin in range(0, batch.num_rows, 64) for r in batch.slice(begin, 64).to_pylist()):
                made = gzip.compress(record(page_urn(r["page_id"]), r["url"], r["payload"], None if r["refers_to"] is None else page_urn(r["refers_to"])),
                                     level, mtime=0)
                if held and size + len(made) > chunk:
                    yield line(held)
                    held, size = [], 0
                held.append(made)
                size += len(made)
                if size > chunk:
                    yield line(held)
                    for _ in range(min(-(-size // chunk), lines) - 1):
                        yield line([])
                    held, size = [], 0
        if held:
            yield line(held)

    written = judged.mapInArrow(run, "line binary").select(F.col("line").cast("string").alias("value"))
    (written.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", lines).text(path))


class Damaged(ValueError):
    """Bytes that are not a valid record."""


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and where it ends; :class:`Damaged` unless every check holds."""
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header does not end")
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("bad header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", size) or not head.get("warc-type") or not head.get("warc-record-id"):
        raise Damaged("header field missing or bad")
    begin, stop = end + 4, end + 4 + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("length does not fit")
    block = data[begin:stop]
    if head.get("warc-block-digest", "").startswith("sha1:") and head["warc-block-digest"] != _digest(block):
        raise Damaged("block digest differs")
    payload, length = None, None
    if head.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        declared = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", http)
        if head["warc-type"] == "response":
            payload, length = body, len(body)
            if head.get("warc-payload-digest", "").startswith("sha1:") and head["warc-payload-digest"] != _digest(body):
                raise Damaged("payload digest differs")
        elif declared:
            length = int(declared[1])
    elif head["warc-type"] != "revisit":
        payload, length = block, len(block)
    digest = head.get("warc-payload-digest", "")
    hexed = None
    if digest.startswith("sha1:"):
        try:
            hexed = base64.b32decode(digest[5:]).hex()
        except ValueError:
            raise Damaged("bad payload digest") from None
    elif payload is not None:
        hexed = hashlib.sha1(payload).hexdigest()
    return {"record_type": head["warc-type"], "record_id": head["warc-record-id"], "refers_to": head.get("warc-refers-to"),
            "url": head.get("warc-target-uri"), "payload_bytes": length, "payload_digest": hexed, "payload": payload}, stop + 4


def inflate(data: memoryview, at: int, max_member: int | None = MAX_MEMBER) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends."""
    unpack, out, size, fed = zlib.decompressobj(31), [], 0, at
    try:
        while not unpack.eof:
            if fed >= len(data):
                raise Damaged("member does not end")
            part = unpack.decompress(data[fed:fed + STEP], 0 if max_member is None else max_member - size + 1)
            fed = min(fed + STEP, len(data))
            out.append(part)
            size += len(part)
            if max_member is not None and size > max_member:
                raise Damaged("member too large")
    except zlib.error:
        raise Damaged("member does not inflate") from None
    return b"".join(out), fed - len(unpack.unused_data)


def _unit(data: bytes, view: memoryview, at: int, max_member: int | None) -> tuple[list[dict], int]:
    """The records of the member or the plain record at ``at``, and where they end."""
    if data.startswith(b"\x1f\x8b", at):
        content, end = inflate(view, at, max_member)
        found, inner = [], 0
        while inner < len(content):
            one, inner = parse_record(content, inner)
            found.append(one)
        return found, end
    one, end = parse_record(data, at)
    return [one], end


def _next_start(data: bytes, at: int) -> int:
    """The next place from ``at`` on that looks like a member or a version line; the end if there is none."""
    found = [i for i in (data.find(b"\x1f\x8b\x08", at), data.find(b"WARC/1.", at)) if i >= 0]
    return min(found, default=len(data))


def salvage(data: bytes, max_member: int | None = MAX_MEMBER) -> Iterator[dict]:
    """Records and gaps of one file, in order; every byte belongs to one of them."""
    view, at, gap, reason = memoryview(data), 0, None, ""
    while at < len(data):
        try:
            found, end = _unit(data, view, at, max_member)
        except Damaged as why:
            if gap is None:
                gap, reason = at, str(why)
            at = _next_start(data, at + 1)
            continue
        if gap is not None:
            yield {"kind": "gap", "offset": gap, "length": at - gap, "reason": reason}
            gap = None
        for one in found:
            yield {"kind": "record", "offset": at, "length": end - at} | one
        at = end
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(data) - gap, "reason": reason}


def read_archive(spark: SparkSession, path: str, with_payload: bool = True, max_member: int | None = MAX_MEMBER) -> DataFrame:
    """Records (``kind`` record) and quarantined bytes (``kind`` gap) of all files below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held: list[dict] = []
                for row in salvage(batch.column(1)[i].as_py(), max_member):
                    if not with_payload:
                        row["payload"] = None
                    held.append(row)
                    if len(held) == 512:
                        yield _as_batch(batch.column(0)[i].as_py(), held)
                        held = []
                yield _as_batch(batch.column(0)[i].as_py(), held)

    return files.mapInArrow(run, ROWS)


def _as_batch(path: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([path if name == "path" else r.get(name) for r in rows], kinds[kind]) for name, kind in fields], [f[0] for f in fields])


def page_id(urn):
    """The id inside a page's record id; null for others."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:x-page:(-?\d+)>$", 1), F.lit("")).cast("long")
