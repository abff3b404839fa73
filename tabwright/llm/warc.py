r"""WARC archives: one gzip member per record, and a reader that salvages damaged files.

Writing. A payload of at least ``least_revisit`` bytes that several pages share is stored once, in the
record of the largest page id; the others are revisit records that name it. Records go through
Spark's own file writer, so archives land on any store that Spark can write. A gzip member ends
with its length, whose last byte is zero below 16 MiB; the writer's row separator is that byte.
Larger members are followed by a zero byte, which readers take as padding.

Reading. Every file is parsed from its start, as gzip members or as plain records. If a check fails -
member checksum, version line, header, length, record end, block or payload digest - the reader looks
for the next member or version line that is valid, goes on there, and logs the bytes between as a gap
(start, end, reason). So one bad byte costs one record. Nothing is dropped unseen: records, gaps
and padding cover the file.

A member of several records is searched in the same way in its decompressed bytes; the gap then has the
member's offsets and its reason the lost bytes of the content. Of a cut or damaged member only records with a
right digest are kept, and none if the checksum fails and every digest is right: the damage may be in any header.

Defined results: a null payload is empty, a null url leaves the target out, a null page id is written
as ``null``. An archive file holds ``archive_bytes`` and one record at most, whatever the task's share. Rows that repeat a page id each get a record; if the largest page id is repeated, all its
rows are responses. Further columns are ignored. An empty table gives no archive record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.scratch import scratch_dir, written

GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_BLANK = re.compile(rb"\r?\n\r?\n")

RECORD_SCHEMA = (
    "file string, offset long, end_offset long, gap string, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, payload binary"
)


@dataclass(frozen=True)
class WarcOptions:
    least_revisit: int = 1000
    date: str = "2000-01-01T00:00:00Z"
    level: int = 6
    #: Bytes of a row handed to Spark's writer, and of an archive file.
    row_bytes: int = 1 << 20
    archive_bytes: int = 64 << 20
    #: Payload bytes that leave a task at once when reading.
    out_bytes: int = 8 << 20


def _label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _hex(label: str | None) -> str | None:
    """Hex of a labelled SHA-1, written in base 32 or in hex; None for other labels."""
    kind, _, value = (label or "").strip().partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError:
        return None


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, opts: WarcOptions = WarcOptions()) -> bytes:
    """One WARC/1.1 record, not compressed."""
    digest = hashlib.sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}:{digest.hexdigest()}>", f"WARC-Date: {opts.date}",
        f"WARC-Payload-Digest: {_label(digest.digest())}", f"WARC-Block-Digest: {_label(hashlib.sha1(block).digest())}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}:{digest.hexdigest()}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def verdicts(pages: DataFrame, opts: WarcOptions = WarcOptions()) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another record holds."""
    size = F.octet_length("html")
    large = pages.where(size >= opts.least_revisit).select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"))
    large = large.groupBy("page_id", "digest").count()
    holder = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return large.join(holder, "digest").where("NOT page_id <=> refers_to AND refers_to IS NOT NULL").select(
        F.col("page_id").alias("rev_id"), F.col("digest").alias("rev_digest"), "refers_to"
    )


def write_archives(pages: DataFrame, path: str, opts: WarcOptions = WarcOptions()) -> None:
    """One record per row of ``pages`` (page_id, url, html) into new archives under ``path``.

    A task's members are joined to rows of about ``row_bytes``, and the writer opens a new file after
    ``archive_bytes`` worth of rows. A longer row is followed by empty ones, one for every further ``row_bytes``
    of it: they count towards the file and are written as padding, so long records do not make long files.
    """

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, row, size, ready = [], [], 0, 0

        def close() -> None:
            nonlocal row, size
            joined = b"".join(row)
            rows.append(joined[:-1] if joined[-1] == 0 else joined)
            rows.extend([b""] * (size // opts.row_bytes - 1))
            row, size = [], 0

        for frame in frames:
            for page, url, payload, ref in frame[["page_id", "url", "payload", "refers_to"]].itertuples(index=False):
                page, ref = (None if pd.isna(x) else int(x) for x in (page, ref))
                packed = member(record_bytes(page, url, bytes(payload or b""), ref, opts), opts.level)
                row.append(packed)
                size += len(packed)
                ready += len(packed)
                if size >= opts.row_bytes:
                    close()
                if ready > opts.out_bytes and rows:
                    yield pd.DataFrame({"record": rows})
                    rows, ready = [], 0
        if row:
            close()
        yield pd.DataFrame({"record": rows})

    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("binary").alias("payload"))
    same = base["page_id"].eqNullSafe(F.col("rev_id")) & (F.sha1("payload") == F.col("rev_digest"))
    rev = verdicts(pages.select(F.col("page_id").cast("long").alias("page_id"), "html"), opts)
    ready = base.join(rev, same, "left").select("page_id", "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))
    ready = ready.withColumn("page_id", F.col("page_id").cast("string"))
    rows = ready.mapInPandas(records, "record binary").select(F.col("record").cast("string").alias("value"))
    per_file = max(1, opts.archive_bytes // opts.row_bytes)
    rows.write.option("lineSep", "\u0000").option("maxRecordsPerFile", per_file).text(path)


class BadRecord(ValueError):
    """The failed check; of a damaged member also its sound records and where decompression stopped."""

    def __init__(self, why: str, found: list[dict] = (), stop: int = 0):
        super().__init__(why)
        self.found, self.stop = found, stop


def parse_record(data: bytes, pos: int, digest: bool = False) -> tuple[int, dict]:
    """The plain record at ``pos``: (its end, its fields). Raises BadRecord with the failed check.

    ``digest``: a record without a digest of its own bytes fails too.
    """
    start = _VERSION.match(data, pos)
    if not start:
        raise BadRecord("version")
    blank = _BLANK.search(data, start.end() - 2)
    if not blank:
        raise BadRecord("header")
    head: dict[str, str] = {}
    for line in data[start.end() : blank.start()].splitlines():
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("header")
        head[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = head.get("content-length", "")
    if not length.isdecimal():
        raise BadRecord("length")
    block_end = blank.end() + int(length)
    if block_end > len(data):
        raise BadRecord("truncated")
    tail = re.compile(rb"\r?\n\r?\n").match(data, block_end)
    if not tail:
        raise BadRecord("record end")
    block = data[blank.end() : block_end]
    want = _hex(head.get("warc-block-digest"))
    if want and hashlib.sha1(block).hexdigest() != want:
        raise BadRecord("block digest")
    if digest and not want and (not _hex(head.get("warc-payload-digest")) or head.get("warc-type") == "revisit"):
        raise BadRecord("no digest")
    return tail.end(), _fields(head, block)


def _fields(head: dict[str, str], block: bytes) -> dict:
    payload, size = block, len(block)
    if head.get("content-type", "").startswith("application/http"):
        cut = _BLANK.search(block)
        if not cut:
            raise BadRecord("http header")
        payload = block[cut.end() :]
        told = re.search(rb"(?im)^content-length:\s*(\d+)", block[: cut.end()])
        size = int(told[1]) if told else len(payload)
    digest = _hex(head.get("warc-payload-digest"))
    if head.get("warc-type") == "revisit":
        payload = None
    else:
        own, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest and own != digest:
            raise BadRecord("payload digest")
        digest = own
    return {
        "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
        "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"),
        "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


def _inflated(data: bytes, pos: int) -> tuple[bytes, int, str]:
    """Content of the gzip member at ``pos``, as far as it goes, its end, and what is wrong with it."""
    opened, out, at = zlib.decompressobj(31), [], pos
    try:
        # In pieces: what follows the member in the last one is copied by each call.
        while at < len(data) and not opened.eof:
            out.append(opened.decompress(data[at : at + 65_536]))
            at += 65_536
        return b"".join(out), min(at, len(data)) - len(opened.unused_data), "" if opened.eof else "truncated"
    except zlib.error:
        pass
    # Again in small pieces, the failing one byte by byte: a call that fails returns nothing.
    opened, out, at = zlib.decompressobj(31), [], pos
    while at < len(data):
        before = opened.copy()
        try:
            out.append(opened.decompress(data[at : at + 4096]))
            at += 4096
        except zlib.error:
            break
    for at in range(at, min(at + 4096, len(data))):
        try:
            out.append(before.decompress(data[at : at + 1]))
        except zlib.error:
            break
    return b"".join(out), at, "member"


def _unit(data: bytes, pos: int) -> tuple[int, list[tuple[str | None, dict]]]:
    """The gzip member or plain record at ``pos``: its end, its records and the gaps between (a member may hold several)."""
    if not data.startswith(GZIP, pos):
        end, fields = parse_record(data, pos)
        return end, [(None, fields)]
    inner, end, wrong = _inflated(data, pos)

    def plain(content: bytes, at: int) -> tuple[int, list[tuple[str | None, dict]]]:
        after, fields = parse_record(content, at, digest=bool(wrong))
        return after, [(None, fields)]

    found = list(_salvaged(inner, plain, _VERSION))
    records = [fields for *_, gap, fields in found if gap is None]
    if not wrong and (records or not found):
        return end, [(f"{gap} in content bytes {start}-{stop}" if gap else None, fields) for start, stop, gap, fields in found]
    if len(records) == len(found):  # a cut spoils the last record at least, a wrong checksum any
        records = records[:-1] if wrong == "truncated" else []
    raise BadRecord(wrong if wrong else found[0][2], records, end)


def _salvaged(data: bytes, unit: Callable, starts: re.Pattern) -> Iterator[tuple[int, int, str | None, dict]]:
    pos, gap, why, stop = 0, None, "", 0
    while pos < len(data):
        if gap is None and data[pos] == 0:
            pos += 1
            continue
        try:
            end, found = unit(data, pos)
        except BadRecord as err:
            if gap is None:
                gap, why = pos, str(err)
            for fields in err.found:
                yield pos, err.stop, None, fields
            # Plain records inside what was decompressed are those just given.
            stop = max(stop, err.stop if err.found else 0)
            following = starts.search(data, pos + 1)
            while following and following.start() < stop and not data.startswith(GZIP, following.start()):
                following = starts.search(data, following.start() + 1)
            pos = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, pos, why, {}
            gap = None
        for inside, fields in found:
            yield pos, end, inside, fields
        pos = end
    if gap is not None:
        yield gap, len(data), why, {}


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict]]:
    """(start, end, None, record) and (start, end, reason, {}) for gaps, in file order."""
    return _salvaged(data, _unit, _START)


def read_archives(spark: SparkSession, path: str, opts: WarcOptions = WarcOptions()) -> DataFrame:
    """Rows of RECORD_SCHEMA: records (``gap`` null) and quarantined gaps (only file, offsets and ``gap``).

    A file is one row of Spark's binary reader, so it must fit in a task, as those of ``write_archives`` do.
    """
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    # Text columns stay objects: a column of nothing but gaps and nulls would else become numbers.
    empty, numbers = dict.fromkeys(names), {"offset": "int64", "end_offset": "int64", "payload_bytes": "Int64"}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame.path, frame.content):
                out, size = [], 0
                for start, end, gap, fields in salvage(bytes(content)):
                    out.append(empty | {"file": name, "offset": start, "end_offset": end, "gap": gap} | fields)
                    size += 1000 + len(fields.get("payload") or b"")
                    if size > opts.out_bytes:
                        yield pd.DataFrame(out, columns=names, dtype=object).astype(numbers)
                        out, size = [], 0
                yield pd.DataFrame(out, columns=names, dtype=object).astype(numbers)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(run, RECORD_SCHEMA)


def indexed(spark: SparkSession, path: str, opts: WarcOptions = WarcOptions()) -> tuple[DataFrame, DataFrame]:
    """(records without payloads, gaps) of the archives, read once.

    Both are cut from one written table, so the log of quarantined bytes stays in the shared folder.
    """
    found = written(read_archives(spark, path, opts).drop("payload"), "warc-index")
    gaps = found.where("gap IS NOT NULL").select("file", "offset", "end_offset", "gap")
    return found.where("gap IS NULL").drop("gap"), gaps


def archived(pages: DataFrame, opts: WarcOptions = WarcOptions()) -> str:
    """The pages written to new archives in the shared folder; their path."""
    path = f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, opts)
    return path


def round_trip(pages: DataFrame, opts: WarcOptions = WarcOptions()) -> DataFrame:
    """Write the pages to new archives and read their records and gaps back, payloads included."""
    return read_archives(pages.sparkSession, archived(pages, opts), opts)
