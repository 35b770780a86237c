"""Web archives packed in ZIP files: writing, and reading records by range without extraction.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz`` holds WARC records,
one gzip member each, ``indexes/index.cdxj`` a line per record with its place in that member. The reader
parses the end record, the ZIP64 end record where there is one, the central directory with its ZIP64
fields and the local header of each member it needs; then it reads the index and fetches each record by
its byte range. Neighbouring ranges are fetched together, up to ``READ_BYTES`` at a time.

Archives are written by the tasks into the shared folder through its own file system, under fresh names;
only those that a finished task reports in the manifest table count, so a lost executor leaves at most a
file that nobody reads. A task starts a new archive at ``ARCHIVE_BYTES``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize, scratch_path
from millrace.llm import text as tx
from millrace.llm.frames import session_of

ARCHIVE_BYTES = 32_000_000
READ_BYTES = 4_000_000
SHORTEST_REVISIT = 1000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Fixed values of the ZIP format.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_TAIL = 22 + 65_535 + 20 + 56

_RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
            "payload binary, archive string, offset long, length long")


# -- records ---------------------------------------------------------------------------------------

def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response record, or a revisit record without the payload where ``refers_to`` is given."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {(url or '').replace(chr(13), '').replace(chr(10), '')}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    url: str
    kind: str
    payload_bytes: int
    digest: str
    refers_to: int | None
    payload: bytes | None


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(raw: bytes) -> Record:
    """The record in one gzip member; a response whose payload does not match its digest is an error."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return Record(_page(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"],
                  int(_fields(http)["content-length"]), digest, _page(fields.get("warc-refers-to")), None if revisit else payload)


# -- the ZIP container -----------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # offset of the local header


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int]:
    """Size and header offset with the ZIP64 field for those that do not fit in 32 bits."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if size == 0xFFFFFFFF:
                size = values.pop(0)
            if packed == 0xFFFFFFFF:
                values.pop(0)
            if header == 0xFFFFFFFF:
                header = values.pop(0)
        at += 4 + length
    return size, header


def members(read, length: int) -> dict[str, Member]:
    """The central directory of a ZIP file; ``read(offset, size)`` gives bytes."""
    tail_at = max(0, length - _TAIL)
    tail = read(tail_at, length - tail_at)
    end = tail.rfind(END)
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(END, 0, end)  # the mark may also stand in a comment
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator: locator + 4] == LOCATOR64:
        end64 = read(struct.unpack_from("<Q", tail, locator + 8)[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = read(start, size), 0, {}
    for _ in range(count):
        if directory[at: at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46: at + 46 + n].decode("utf-8")
        full, header = _wide(directory[at + 46 + n: at + 46 + n + m], full, packed, header)
        found[name] = Member(name, method, full, header)
        at += 46 + n + m + k
    return found


def body_offset(read, member: Member) -> int:
    """Where a stored member's bytes begin, by its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    local = read(member.header, 30)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    n, m = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n + m


def pack(records: bytes, index: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(zipfile.ZipInfo(DATA), records)
        archive.writestr(zipfile.ZipInfo(INDEX), index)
    return out.getvalue()


def read_records(read, length: int) -> Iterator[tuple[Record, int, int]]:
    """All records of an archive with their place in its WARC member, in index order."""
    found = members(read, length)
    index = found[INDEX]
    lines = read(body_offset(read, index), index.size).decode().splitlines()
    places = [(int(x["offset"]), int(x["length"])) for x in (json.loads(line.split(" ", 2)[2]) for line in lines)]
    base, at = body_offset(read, found[DATA]), 0
    while at < len(places):
        start, stop, last = places[at][0], sum(places[at]), at + 1
        while last < len(places) and places[last][0] == stop and sum(places[last]) - start <= READ_BYTES:
            stop, last = sum(places[last]), last + 1
        block = read(base + start, stop - start)
        for offset, size in places[at:last]:
            yield parse_record(block[offset - start: offset - start + size]), offset, size
        at = last


# -- Spark -----------------------------------------------------------------------------------------

def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        body, lines, total, count = [], [], 0, 0

        def flush():
            name = f"{uuid.uuid4().hex}.wacz"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(pack(b"".join(body), "\n".join(lines).encode()))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], ["archive", "records"])

        for batch in tx.pieces(batches, "payload"):
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for page_id, url, payload, digest, refers_to in zip(*columns):
                packed = gzip.compress(record_bytes(page_id, url, payload, digest, refers_to), 1, mtime=0)
                lines.append(f"{page_id} 19700101000000 " + json.dumps({"offset": total, "length": len(packed), "filename": "data.warc.gz"}))
                body.append(packed)
                total, count = total + len(packed), count + 1
                if total >= ARCHIVE_BYTES:
                    yield flush()
                    body, lines, total, count = [], [], 0, 0
        if count:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages (page_id long, url, html)`` and return the manifest ``(archive, records)``.

    Of pages with equal payloads of at least ``SHORTEST_REVISIT`` bytes the one with the largest id is
    written as a response, the others as revisits of it; shorter ones are all responses. A null html is an
    empty payload. Rows with a null id are revisits where an equal page has an id, else responses; rows
    that share the largest id are all responses. An empty table writes nothing. Other columns are not read.
    """
    spark = session_of(pages)
    folder = folder or scratch_path(spark, "archives")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = pages.where(F.octet_length("html") >= SHORTEST_REVISIT).select("page_id", F.sha1(payload).alias("digest")).groupBy(
        "digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).where("n > 1").drop("n")
    groups = materialize(groups, "equal")  # a join of two plain scans can split a hot payload over many tasks
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("first")), F.col("first"))
    chosen = rows.join(groups, "digest", "left").withColumn("refers_to", refers)
    return materialize(chosen.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        _write(folder), "archive string, records long"), "manifest")


def _read(payloads: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["archive"].to_pylist():
                system, path = pafs.FileSystem.from_uri(name)
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for r, offset, length in read_records(lambda at, n: file.read_at(n, at), file.size()):
                        held.append({"page_id": r.page_id, "url": r.url, "record_type": r.kind, "payload_bytes": r.payload_bytes,
                                     "payload_digest": r.digest, "refers_to": r.refers_to,
                                     "payload": r.payload if payloads else None, "archive": name, "offset": offset, "length": length})
                        size += len(r.payload or b"") if payloads else 0
                        if len(held) >= 2000 or size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_archives(manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """One row per record of the archives named in ``manifest.archive``; revisits have no payload.

    Each archive is a task: names are tiny rows, which adaptive execution would merge into one task but for
    the explicit number. A repeated name is read once, a null name is left out, a missing file is an error.
    """
    session_of(manifest)
    names = manifest.select("archive").where("archive is not null").distinct()
    return names.repartition(max(1, names.count())).mapInArrow(_read(payloads), _RECORDS)
