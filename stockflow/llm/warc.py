"""WARC archives: a writer that notes repeated payloads, and a reader that salvages."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.storage import stored, work_path

DATE = "2024-01-01T00:00:00Z"
# Marks of the formats.
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 64 << 20
_READ = 1 << 18


def digest(data: bytes) -> str:
    """SHA-1 in bare upper-case base 32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or a plain path, and the path in it."""
    return pafs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


@dataclass
class Record:
    """One record: named fields in lower case, and its block."""

    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header of the block."""
        return self.block.partition(b"\r\n\r\n")[2]

    def http(self, name: str) -> str | None:
        """A field of the HTTP header."""
        for line in self.block.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")[1:]:
            key, _, value = line.partition(":")
            if key.strip().lower() == name:
                return value.strip()
        return None


def _line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def record_id(key: object) -> str:
    return "<urn:x-page:" + ("" if key is None else quote(str(key), safe="")) + ">"


def encode(key: object, url: str | None, payload: bytes, response: object, repeated: bool) -> bytes:
    """A response record, or a revisit record that names the response's key."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if repeated else payload)
    fields = [
        ("WARC-Type", "revisit" if repeated else "response"),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if repeated:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(response))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


class Broken(ValueError):
    """A record that fails a check."""


def parse(data: bytes, start: int = 0) -> tuple[Record, int]:
    """The record that starts at a version line, and where it ends; checks everything."""
    version = VERSION.match(data, start)
    if not version:
        raise Broken("version line")
    stop = data.find(b"\r\n\r\n", start)
    if stop < 0:
        raise Broken("end of header")
    fields = {}
    for line in data[version.end() : stop].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("named field")
        fields[name.strip().lower()] = value.strip()
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Broken("content length") from None
    end = stop + 4 + length
    if length < 0 or data[end : end + 4] != b"\r\n\r\n":
        raise Broken("end of record")
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Broken("mandatory field")
    record = Record(fields, data[stop + 4 : end])
    if fields.get("warc-block-digest", "").startswith("sha1:"):
        if fields["warc-block-digest"][5:] != digest(record.block):
            raise Broken("block digest")
    if fields["warc-type"] == "response" and fields.get("warc-payload-digest", "").startswith("sha1:"):
        if fields["warc-payload-digest"][5:] != digest(record.payload):
            raise Broken("payload digest")
    return record, end + 4


class _Window:
    """Bytes of a file from a position on; what lies before is let go."""

    def __init__(self, file):
        self.file, self.start, self.data, self.size = file, 0, b"", file.size()

    def upto(self, end: int) -> bool:
        """Have bytes up to a position, if the file is that long."""
        have = self.start + len(self.data)
        if end > have and have < self.size:
            self.file.seek(have)
            self.data += self.file.read(min(max(end - have, _READ, len(self.data)), self.size - have))
        return self.start + len(self.data) >= end

    def drop(self, position: int) -> None:
        self.data, self.start = self.data[position - self.start :], position


class _Inflated:
    """The bytes inside a gzip member, as a window; they are decoded when needed.

    What was decoded before an error counts. ``position`` is how far the file was read,
    ``error`` why decoding stopped before the member's end.
    """

    def __init__(self, window: _Window, at: int):
        self.window, self.position, self.error = window, at, ""
        self.press = zlib.decompressobj(31)
        self.start, self.data, self.size = 0, b"", float("inf")

    def upto(self, end: int) -> bool:
        parts, have = [self.data], self.start + len(self.data)
        while have < end and have < self.size:
            parts.append(self._more())
            have += len(parts[-1])
            if self.error or self.press.eof:
                self.size = have
        self.data = b"".join(parts)
        return have >= end

    def drop(self, position: int) -> None:
        self.data, self.start = self.data[position - self.start :], position

    def _more(self) -> bytes:
        self.window.upto(self.position + _READ)
        inside = self.position - self.window.start
        part = self.window.data[inside : inside + _READ]
        if not part:
            self.error = "end of member"
            return b""
        before = self.press.copy()
        try:
            out = self.press.decompress(part)
        except zlib.error as error:
            self.error = str(error)
            return _decoded(before, part)
        self.position += len(part) - len(self.press.unused_data)
        # The member's first bytes are not needed again unless it breaks, which reads anew.
        self.window.drop(self.position)
        return out


def _decoded(press, part: bytes) -> bytes:
    """All that can be decoded of bytes that hold an error."""
    out, step = [], 256
    while part:
        before = press.copy()
        try:
            out.append(press.decompress(part[:step]))
            part = part[step:]
        except zlib.error:
            if step == 1:
                break
            press, step = before, 1
    return b"".join(out)


def _plain(window: _Window | _Inflated, at: int) -> tuple[Record, int]:
    """The record that starts at a position of a window, and where it ends."""
    window.upto(at + _READ)
    while True:
        have = window.start + len(window.data)
        try:
            record, end = parse(window.data, at - window.start)
            return record, end + window.start
        except Broken as error:
            # Header and block may reach beyond the window; the length says how far.
            if str(error) == "end of header" and have < window.size:
                window.upto(have + max(_READ, have - at))
                continue
            text = window.data[at - window.start :].partition(b"\r\n\r\n")[0]
            need = re.search(rb"(?i)\r\ncontent-length:\s*(\d{1,15})\s*(?:\r\n|$)", text)
            if str(error) != "end of record" or not need:
                raise
            end = at + len(text) + 8 + int(need[1])
            if have >= min(end, window.size) or end > window.size:
                raise
            window.upto(end)


def _inside(window: _Inflated) -> Iterator[tuple[str, int, int, object]]:
    """Records and gaps of decoded bytes, in their positions."""
    at, gap, reason = 0, None, ""
    while window.upto(at + 1):
        try:
            record, end = _plain(window, at)
        except Broken as error:
            if gap is None:
                gap, reason = at, str(error)
            at = _candidate(window, at + 1, members=False)
            window.drop(min(at, window.start + len(window.data)))
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        yield "record", at, end, record
        at = end
        window.drop(at)
    if gap is not None:
        yield "gap", gap, window.size, reason


def _member(window: _Window, at: int) -> Iterator[tuple[str, int, int, object]]:
    """Records and gaps of a gzip member; then how it ended, as ('end', start, end, error)."""
    inner, held, found = _Inflated(window, at), None, 0
    for kind, low, high, what in _inside(inner):
        if kind == "gap":
            # The rest of a member that breaks off is part of the gap that it leaves.
            if not (inner.error and high == inner.size):
                yield "gap", at, inner.position, f"{what} in decoded bytes {low} to {high}"
            continue
        if held is not None:
            yield "record", at, inner.position, held
        held, found = what, found + 1
    if held is not None:
        yield "record", at, inner.position, held
    yield "end", at, inner.position, inner.error or ("" if found else "empty member")


def salvage(file) -> Iterator[tuple[str, int, int, object]]:
    """('record', start, end, Record) and ('gap', start, end, reason) of an archive.

    After a failed check the next gzip member or version line that opens a valid record
    is searched, and the bytes in between are reported as a gap. Inside a member the search
    goes on in the decoded bytes, so one bad record costs that record; of a member that is
    cut off or damaged the records before the damage are returned. Positions are those of
    the file, for records of a member those of the member as far as it was read. Memory is
    bounded by the longest record.
    """
    window, at, gap, reason = _Window(file), 0, None, ""
    while at < window.size:
        window.upto(at + 3)
        member = window.data[at - window.start : at - window.start + 3] == GZIP
        error, after = "", at
        if member:
            for kind, low, high, what in _member(window, at):
                if kind == "end":
                    error, after = what, high
                    continue
                if gap is not None:
                    yield "gap", gap, at, reason
                    gap = None
                yield kind, low, high, what
        else:
            try:
                record, after = _plain(window, at)
            except Broken as broken:
                error = str(broken)
            else:
                if gap is not None:
                    yield "gap", gap, at, reason
                    gap = None
                yield "record", at, after, record
        if error:
            if gap is None:
                gap, reason = at, error
            if window.start > at:  # a member's first bytes were let go
                window.start, window.data = at, b""
            after = _candidate(window, at + 1)
        at = after
        window.drop(min(at, window.start + len(window.data)))
        if window.start < at:
            window.start, window.data = at, b""
    if gap is not None:
        yield "gap", gap, window.size, reason


def _candidate(window: _Window | _Inflated, at: int, members: bool = True) -> int:
    """The next position where a member or a version line may start, or the end."""
    while window.upto(at + 1):
        window.upto(at + _READ)
        inside = at - window.start
        member = window.data.find(GZIP, inside) if members else -1
        line = VERSION.search(window.data, inside)
        found = [p for p in (member, line.start() if line else -1) if p >= 0]
        if found:
            return window.start + min(found)
        end = window.start + len(window.data)
        if end >= window.size:
            return window.size
        at = max(at, end - 10)
        window.drop(at)
    return window.size


def write(pages: DataFrame, folder: str | None = None, id_column: str = "page_id",
          url_column: str = "url", payload_column: str = "html", least: int = 0,
          archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page; returns (path, records) of the archives.

    Of equal payloads of at least ``least`` bytes the page with the smallest id is a
    response and the others revisit it; shorter ones are all responses. A null payload
    is empty, a null URL too. Rows that share the smallest id are all responses; a null
    id revisits any other. Columns not named are not read. An empty table writes
    nothing. Archives are named by the attempt that wrote them, and only those of the
    attempts that succeeded are returned. Copies meet by digest in a join that Spark can
    split; the smallest id is found with map-side sums.
    """
    target = folder or work_path(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(payload_column).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("key", F.sha1("payload"))
    firsts = rows.where(F.length("payload") >= least).groupBy(F.col("key").alias("of"))
    firsts = firsts.agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    found = rows.join(firsts, F.col("key") == F.col("of"), "left").select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        F.col("first").cast("string").alias("first"),
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(target)
        system.create_dir(root, recursive=True)
        context, number, out, size, count, path = TaskContext.get(), 0, None, 0, 0, ""

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{target}/{path}"], "records": [count]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.gz"
                    out, size, count, number = system.open_output_stream(f"{root}/{path}", compression=None), 0, 0, number + 1
                first = row["first"]
                member = _gzip(
                    encode(row["id"], row["url"], row["payload"], first, first is not None and first != row["id"])
                )
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stored(found.mapInArrow(archive, "path string, records bigint"), "archives")


def read(archives: DataFrame, path_column: str = "path") -> DataFrame:
    """What archives hold: records and gaps, in one row each.

    (path, start, end, kind, reason, record_type, record_id, url, payload_bytes,
    payload_digest, refers_to): ``kind`` is record or gap; a gap is a quarantined range
    of bytes with the check that failed. A response's payload is measured; a revisit's
    size and digest are those its header states. Archives are read as streams, by as
    many tasks as there are archives at most.
    """
    # A given number keeps Spark from putting the few short rows into one task.
    paths = archives.select(F.col(path_column).alias("path"))
    paths = paths.repartitionByRange(max(1, paths.count()), "path")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inside = file_system(path)
                with system.open_input_file(inside) as file:
                    for kind, start, end, what in salvage(file):
                        rows.append({"path": path, "start": start, "end": end, "kind": kind} | _described(kind, what))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return paths.mapInArrow(records, READ_SCHEMA)


READ_SCHEMA = (
    "path string, start bigint, end bigint, kind string, reason string, record_type string, "
    "record_id string, url string, payload_bytes bigint, payload_digest string, refers_to string"
)
_SCHEMA = pa.schema(
    [
        (name, pa.int64() if kind == "bigint" else pa.string())
        for name, kind in (part.split() for part in READ_SCHEMA.split(", "))
    ]
)


def _described(kind: str, what: object) -> dict:
    if kind == "gap":
        return {"reason": what}
    assert isinstance(what, Record)
    fields = what.fields
    out = {
        "record_type": fields["warc-type"],
        "record_id": fields["warc-record-id"],
        "url": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
    }
    if fields["warc-type"] == "revisit":
        size = what.http("content-length")
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        return out | {"payload_bytes": int(size) if size and size.isdigit() else None, "payload_digest": stated or None}
    return out | {"payload_bytes": len(what.payload), "payload_digest": digest(what.payload)}


def key_of(record_id_column: str):
    """The page key in a record id that ``write`` made; null if it is empty."""
    inside = F.regexp_extract(record_id_column, "^<urn:x-page:(.*)>$", 1)
    return F.when(inside != "", F.url_decode(inside))
