"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Each record is a gzip member of its own. Of pages with equal payloads, that with the largest id is
written as a response with its body, the others as revisits that name it. The reader takes members
one after the other; when one fails (a broken member, a wrong length, a wrong digest) it searches
for the next gzip member, or in plain files the next version line, that starts a valid record,
goes on from there, and logs the bytes between as a quarantined gap.

Defined cases: a null body is an empty payload; rows that repeat an id and a payload are all
responses if the id is the largest; a null id is smaller than any other; an empty table writes no
file. Headers and payloads have any length. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import get, saved, shared_dir, store

VERSION = b"WARC/1.1"
GZIP = b"\x1f\x8b\x08"
FILE_BYTES = 64 << 20  # an archive is closed at about this size
END = b"\r\n\r\n"
MARK = re.compile(rb"\x1f\x8b\x08|WARC/1\.")  # where a record can start
FIRST_SLICE, LAST_SLICE = 4 << 10, 1 << 20  # packed bytes given to the inflater at once


@dataclass(frozen=True)
class Record:
    """One record: where it began and ended in the file, its headers, and its block."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(END)[2] if self.headers.get("content-type", "").startswith("application/http") else self.block


@dataclass(frozen=True)
class Gap:
    """Bytes of a file that hold no valid record, and why the first of them failed."""

    start: int
    end: int
    reason: str


class Broken(ValueError):
    """A record that fails a check."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"\r\n".join([VERSION, *(f"{k}: {_one_line(v)}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()])
    return head + END + block + END


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member(data: bytes, level: int = 1) -> bytes:
    out = zlib.compressobj(level, zlib.DEFLATED, 31)
    return out.compress(data) + out.flush()


def page_record(page_id: str, url: str, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """A response, or a revisit without the body where `refers_to` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    kind = "response" if refers_to is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Target-URI", url), ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record_bytes(headers, http + payload * (refers_to is None))


def parse(data: bytes, at: int, start: int, end: int | None = None) -> Record:
    """The plain record at `data[at:]`; start and end are its place in the file."""
    stop = data.find(END, at)
    if not data.startswith(b"WARC/", at) or stop < 0:
        raise Broken("no version line")
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Broken("header line without a colon")
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise Broken("no content length")
    body = stop + 4
    block = data[body : body + int(size)]
    if len(block) < int(size) or data[body + int(size) : body + int(size) + 4] != END:
        raise Broken("block shorter or longer than its length")
    done = body + int(size) + 4
    found = Record(start, done if end is None else end, headers, block)
    said = headers.get("warc-payload-digest", "")
    if said.startswith("sha1:") and headers.get("warc-type") == "response" and said[5:] != digest(found.payload):
        raise Broken("wrong payload digest")
    if end is not None and done != len(data):
        raise Broken("bytes after the record in its member")
    return found


def inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member that starts at `at`, and where it ends. The inflater gets
    slices that grow with the member, so a short one costs little however much follows it."""
    inflate, parts, view, step = zlib.decompressobj(31), [], memoryview(data), FIRST_SLICE
    try:
        while not inflate.eof and at < len(data):
            parts.append(inflate.decompress(view[at : at + step]))
            at, step = min(at + step, len(data)), min(2 * step, LAST_SLICE)
    except zlib.error as e:
        raise Broken(f"member: {e}") from None
    if not inflate.eof:
        raise Broken("member without its end")
    return b"".join(parts), at - len(inflate.unused_data)


def _at(data: bytes, at: int) -> Record:
    """The record that starts at `at`, packed or plain."""
    if data.startswith(GZIP, at):
        plain, end = inflated(data, at)
        return parse(plain, 0, at, end)
    return parse(data, at, at)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of a file, in order; they cover every byte of it."""
    at = 0
    while at < len(data):
        try:
            found = _at(data, at)
        except Broken as e:
            found, reason, to = None, str(e), at + 1
            while found is None and (mark := MARK.search(data, to)):
                try:
                    found = _at(data, mark.start())
                except Broken:
                    to = mark.start() + 1
            yield Gap(at, found.start if found else len(data), reason)
        if found is None:
            return
        yield found
        at = found.end


def with_types(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = 0) -> DataFrame:
    """(key, url, body, sha1, refers) of every page: refers is the largest id of those with the same
    payload of `least` bytes or more (null: this page is that one, or its payload is smaller). One
    row a payload is joined back on its digest, an equi-join that Spark splits where one payload is
    very common."""
    sized = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    sized = sized.withColumn("sha1", F.unhex(F.sha1(F.col("body").cast("binary"))))
    firsts = sized.groupBy("sha1").agg(F.max("key").alias("largest"))
    other = (F.octet_length("body") >= least) & ~F.col("key").eqNullSafe(F.col("largest"))
    return sized.join(firsts, "sha1").select("key", "url", "body", "sha1", F.when(other, F.col("largest")).alias("refers"))


def write(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", folder: str | None = None, least: int = 0) -> DataFrame:
    """Write the archives; returns their list (folder, name, bytes, records), one row a file."""
    folder = folder or shared_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        task, number, out, part, done, records = TaskContext.get().partitionId(), 0, None, "", [], 0

        def close() -> None:
            name = f"pages-{task:06d}-{number:04d}.warc.gz"
            size = out.tell()
            out.close()
            files.move(part, f"{root}/{name}")
            done.append((folder, name, size, records))

        for b in batches:
            for i, u, h, sha1, refers in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if out is None:
                    files.create_dir(root, recursive=True)
                    part = f"{root}/.pages-{task}.{uuid.uuid4().hex}"
                    out, records = files.open_output_stream(part), 0
                out.write(member(page_record(str(i), u or "", h.encode(), base64.b32encode(sha1).decode(), None if refers is None else str(refers))))
                records += 1
                if out.tell() >= FILE_BYTES:
                    close()
                    out, number = None, number + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["folder", "name", "bytes", "records"])

    rows = with_types(pages, key, url, body, least)
    return saved(rows.mapInArrow(run, "folder string, name string, bytes bigint, records bigint"), "warc-list")


def read(archives: DataFrame, with_payload: bool = False, gaps: bool = False) -> DataFrame:
    """Records of the listed files (name, start, end, warc_type, record_id, refers_to, target_uri,
    payload_bytes, payload_digest[, payload]); with `gaps` the log of quarantined bytes (name,
    start, end, reason) instead."""

    def http_length(r: Record) -> int:
        for line in r.block.partition(END)[0].split(b"\r\n"):
            if line.lower().startswith(b"content-length:"):
                return int(line.split(b":")[1])
        return len(r.payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for f in b.to_pylist():
                rows: list[tuple] = []
                for r in salvage(get(f["folder"], f["name"])):
                    if isinstance(r, Gap):
                        if gaps:
                            rows.append((f["name"], r.start, r.end, r.reason))
                    elif not gaps:
                        h, whole = r.headers, r.headers.get("warc-type") == "response"
                        rows.append((f["name"], r.start, r.end, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), len(r.payload) if whole else http_length(r), digest(r.payload) if whole else h.get("warc-payload-digest", "").removeprefix("sha1:"), r.payload))
                    if len(rows) >= 2000:
                        yield batch(rows)
                        rows = []
                yield batch(rows)

    names = ["name", "start", "end", "reason"] if gaps else ["name", "start", "end", "warc_type", "record_id", "refers_to", "target_uri", "payload_bytes", "payload_digest", "payload"][: 9 + with_payload]
    kinds = dict.fromkeys(names, "string") | dict.fromkeys(["start", "end", "payload_bytes"], "bigint") | {"payload": "binary"}
    arrow = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], arrow[kinds[n]]) for k, n in enumerate(names)], names=names)

    # Dealt by ranges of name, which gives each task as many files as the next; a hash of few names does not.
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartitionByRange(n, "name").mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))
