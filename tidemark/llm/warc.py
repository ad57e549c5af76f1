"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Every record is a gzip member of its own, so that damage stays where it is.  The reader checks each
member (gzip checksum, version line, lengths, block digest).  After a failed check it searches for
the next member, or in uncompressed files the next version line, that passes, goes on there, and
reports the bytes between as a gap.

Files lie in a shared folder and are opened by URI through pyarrow's file systems, so that any
executor reaches them.  A writing task names its file by chance; the table of files that the job
returns names only those of tasks that succeeded, so a lost executor leaves at most an unused file.
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
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_folder, stored

VERSION = b"WARC/1.1"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_MEMBER = b"\x1f\x8b\x08"
_DATE = "2000-01-01T00:00:00Z"  # a fixed date, so that the same pages give the same archives
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads from this size on are written once.
REVISIT_FROM = 1000
# A reader holds one file at a time, so writers start a new one from this size on.
FILE_BYTES = 32 << 20


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record.  A revisit holds no payload, only the digest and length of the one it refers to."""
    body = b"" if kind == "revisit" else payload
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + body
    name = "" if page_id is None else str(page_id)
    lines = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{name} {digest}')}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: {_sha1(block)}",
        f"X-Page-ID: {name}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    payload: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    pass


def _parse(data: bytes, start: int, offset: int) -> tuple[Record, int]:
    """The record whose version line is at ``start``, and where it ends."""
    if not _VERSION_LINE.match(data, start):
        raise Damaged("no version line")
    head = data.find(b"\r\n\r\n", start)
    if head < 0:
        raise Damaged("headers without end")
    if _VERSION_LINE.search(data, start + 1, head):
        raise Damaged("another record begins within the headers")
    headers = {}
    for line in data[start:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("no content length")
    body, end = head + 4, head + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    block = data[body:end]
    if "warc-block-digest" in headers and not _digest_holds(headers["warc-block-digest"], block):
        raise Damaged("block digest differs")
    return Record(offset, headers, block.partition(b"\r\n\r\n")[2]), end + 4


def _digest_holds(label: str, data: bytes) -> bool:
    """Whether a digest ``algorithm:value``, in base 32 or hexadecimal, is that of the data; unknown algorithms hold."""
    name, _, value = label.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    found = hashlib.new(name, data)
    packed = base64.b32encode(found.digest()).decode().lower()
    return value.strip().lower().rstrip("=") in (found.hexdigest(), packed.rstrip("="))


def sha1_hex(label: str | None) -> str | None:
    """The hexadecimal form of a SHA-1 label in base 32 or hexadecimal; None for anything else."""
    name, _, value = (label or "").partition(":")
    value = value.strip()
    if name.strip().lower().replace("-", "") != "sha1":
        return None
    if re.fullmatch(r"[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


def _records_in(text: bytes, offset: int) -> tuple[list[Record], str]:
    """Records of an unpacked member in turn, going on at the next version line after damage; and what was damaged."""
    found, at, reason = [], 0, ""
    while at < len(text):
        try:
            one, at = _parse(text, at, offset)
            found.append(one)
        except Damaged as damage:
            reason = reason or str(damage)
            match = _VERSION_LINE.search(text, at + 1)
            at = match.start() if match else len(text)
    return found, reason


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` unpacks to, where it ends, and what was wrong with it."""
    if data[at : at + 3] != _MEMBER:
        return b"", at, "no gzip member"
    unpacker = zlib.decompressobj(31)
    parts, view = [], memoryview(data)
    try:
        # In pieces: a false start inside compressed data then costs one piece, not the whole rest.
        while not unpacker.eof and at < len(data):
            parts.append(unpacker.decompress(view[at : at + 65536]))
            at += min(65536, len(data) - at)
    except zlib.error as error:
        return b"".join(parts), at, f"gzip: {error}"
    if not unpacker.eof:
        return b"".join(parts), at, "gzip member without end"
    return b"".join(parts), at - len(unpacker.unused_data), ""


def _salvage_packed(data: bytes) -> Iterator[Record | Gap]:
    at, gap, reason = 0, None, ""
    while at < len(data):
        text, after, broken = _unpacked(data, at)
        found, inside = _records_in(text, at)
        if found and gap is not None:
            yield Gap(gap, at - gap, reason)
            gap = None
        yield from found
        if not broken and (found or not text) and not inside:
            at = after
            continue
        if gap is None:
            gap, reason = at, broken or inside
        if found and not broken:  # the member's damage ends where it ends
            yield Gap(gap, after - gap, reason)
            gap, at = None, after
            continue
        following = data.find(_MEMBER, at + 1)
        at = len(data) if following < 0 else following
    if gap is not None:
        yield Gap(gap, len(data) - gap, reason)


def _salvage_plain(data: bytes) -> Iterator[Record | Gap]:
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            found, after = _parse(data, at, at)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            match = _VERSION_LINE.search(data, at + 1)
            at = match.start() if match else len(data)
            continue
        if gap is not None:
            yield Gap(gap, at - gap, reason)
            gap = None
        yield found
        at = after
    if gap is not None:
        yield Gap(gap, len(data) - gap, reason)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Every record that passes its checks, in order, and every gap of bytes that belongs to none.

    A gzip member may hold several records, and one that is damaged or cut off still gives those that
    it unpacks to; the gap is then the whole member.
    """
    packed = data[:2] == _MEMBER[:2] or (not _VERSION_LINE.match(data) and _MEMBER in data)
    return _salvage_packed(data) if packed else _salvage_plain(data)


def _writer(folder: str):
    def run(batches):
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "payload_digest", "refers_to")]
            for row in zip(*columns):
                page_id, url, html, digest, refers_to = (v.as_py() for v in row)
                kind = "response" if refers_to is None else "revisit"
                packed = member(record(kind, page_id, url or "", (html or "").encode(), digest, refers_to))
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = system.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size], "records": [count]})

    return run


def plan_records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``page_id, payload_digest, refers_to``, one row for every different pair of the first two.

    Of equal payloads of ``revisit_from`` bytes or more the one with the largest ``page_id`` is
    written; the others refer to it.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = stored(
        pages.select("page_id", F.sha1(html).alias("payload_digest"), F.octet_length(html).alias("n")).distinct(), "payloads"
    )
    large = rows.filter(F.col("n") >= revisit_from)
    written = large.groupBy("payload_digest").agg(F.max("page_id").alias("last"))
    # The many rows of one payload are on the left, where adaptive execution can split them.
    rows = rows.withColumn("wanted", F.when(F.col("n") >= revisit_from, F.col("payload_digest")))
    other = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    joined = rows.join(written.withColumnRenamed("payload_digest", "wanted"), "wanted", "left")
    return joined.select("page_id", "payload_digest", other.alias("refers_to"))


def write(pages: DataFrame, folder: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives below ``folder``; the table of files written.

    NULL html is an empty payload, a NULL url an empty one; a NULL id is never referred to unless
    it is the only one of its payload.  Repeated rows are written as often as they come.
    """
    planned = stored(plan_records(pages, revisit_from), "records").select(
        F.col("page_id").alias("p"), F.col("payload_digest"), "refers_to"
    )
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(html).alias("d"))
    rows = rows.join(planned, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("d") == F.col("payload_digest")))
    # No payload travels further for a record that holds none; its length does.
    rows = rows.select("page_id", "url", "html", "payload_digest", "refers_to")
    return stored(rows.mapInArrow(_writer(folder), "file string, bytes long, records long"), "files")


_READ = (
    "file string, offset long, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary, gap_bytes long, gap_reason string"
)
_NAMES = [c.split()[0] for c in _READ.split(", ")]


def _reader(folder: str, payloads: bool):
    def line(name: str, item: Record | Gap) -> tuple:
        if isinstance(item, Gap):
            return (name, item.offset, None, None, None, None, None, None, None, item.length, item.reason)
        h = item.headers
        kind = h.get("warc-type")
        number = lambda key: int(h[key]) if h.get(key, "").lstrip("-").isdigit() else None
        if kind == "revisit":
            digest, size = sha1_hex(h.get("warc-payload-digest")), number("x-payload-length")
        else:
            digest, size = hashlib.sha1(item.payload).hexdigest(), len(item.payload)
        kept = item.payload if payloads else None
        return (
            name, item.offset, number("x-page-id"), h.get("warc-target-uri"), kind, size, digest,
            number("x-refers-to-page-id"), kept, None, None,
        )

    schema = pa.schema([
        pa.field(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]])
        for n, c in zip(_NAMES, _READ.split(", "))
    ])

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    data = stream.read()
                lines, size = [], 0
                for item in salvage(data):
                    lines.append(line(name, item))
                    size += len(lines[-1][8] or b"") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lines), schema)], schema=schema)
                        lines, size = [], 0
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lines), schema)], schema=schema)

    return run


def read(files: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records and gaps of the archives named in ``files.file``; a gap has ``gap_bytes`` and ``gap_reason`` only.

    ``payload_digest`` and ``payload_bytes`` are those of the full payload: computed from the bytes
    read for a response, taken from the header for a revisit.  Files are read in parallel.
    """
    spark: SparkSession = files.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file").repartition(n).mapInArrow(_reader(folder, payloads), _READ)


def round_trip(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the pages, read the archives back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Every row gives a row.  NULL html is an empty payload; NULL ids and urls are allowed; repeated rows
    come as often as they do; an empty table gives no rows; payloads of any length are taken whole;
    other columns are left out.  A file that cannot be read in full is an error, which names the gap.
    """
    folder = new_folder(pages.sparkSession, "warc")
    files = write(pages, folder, revisit_from)
    told = F.concat_ws(" ", F.lit("damaged archive"), "file", F.lit("at"), "offset", F.lit("bytes"), "gap_bytes", F.lit(":"), "gap_reason")
    damaged = F.raise_error(told).cast("boolean")
    found = read(files, folder).filter(F.when(F.col("gap_bytes").isNull(), True).otherwise(damaged))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
