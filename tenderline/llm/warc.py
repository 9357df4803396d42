"""Web archives: a writer with revisit records, and a reader that salvages damaged files.

The writer makes one gzip member per record, files of some thousand records, each written under
a temporary name and moved into place when complete, so a task that is run again leaves one whole
file. Of records with equal payloads the one with the smallest id is the response; the others are
revisits without the payload that name it.

The reader streams a file in blocks and checks every record: version line, header lines, length,
end marks, and the payload's digest. After a failed check it searches for the next place where a
record can start (a gzip member, or a version line in plain files), goes on from there, and logs
the bytes it skipped with the reason. Damage costs the records that it touches, not the rest.

Folders may be on any file system that pyarrow opens by URI; a bare path is a local one that all
executors must share.

Scale: digests are made where pages are read; only (digest, id) rows are grouped, map-side
combined, and the payloads that share a digest are joined by it where a size check does not let
the small side be sent to all tasks. A reader task holds one block and one record.

Defined cases: a null payload is empty; payloads under ``least`` bytes are always responses;
every row with the smallest id of its payload is a response; null ids come last and are written
as an empty id; a null url leaves its header out, control characters in it are percent-encoded;
an empty table writes no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

VERSION = b"WARC/1.1"
RECORDS_PER_FILE = 2000
BLOCK = 1 << 20
#: Rows of a table that may be sent to all tasks.
SENT_ROWS = 100_000
#: Longest header of a record; without an end by then the record is damaged.
LONGEST_HEADER = 1 << 16
_MEMBER = b"\x1f\x8b\x08"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One uncompressed record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if kind == "response" else b"")
    named = lambda i: f"<urn:page:{'' if i is None else i}>"
    lines = [("WARC-Type", kind), ("WARC-Record-ID", named(page_id)), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    lines += [("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("X-Payload-Length", str(len(payload)))]
    if kind == "revisit":
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", named(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_first_of_payload(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with ``first_id``, the smallest id among equal payloads (null where it is their own)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    shared = sized.where(F.octet_length("payload") >= least).groupBy(F.col("digest").alias("of_digest")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
    shared = shared.where("n > 1 AND first_id IS NOT NULL").drop("n")
    few = len(shared.take(SENT_ROWS + 1)) <= SENT_ROWS
    joined = sized.join(F.broadcast(shared) if few else shared, (F.col("digest") == F.col("of_digest")) & (F.octet_length("payload") >= least), "left")
    own = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", own.alias("first_id"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, compress: bool = True) -> DataFrame:
    """Write (page_id, url, html) as archive files below ``folder``; (file, records) of each.

    The result is lazy: files are written when it is evaluated.
    """
    rows = with_first_of_payload(pages, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        part, count, stream, temporary = 0, 0, None, ""

        def close() -> pa.RecordBatch:
            stream.close()
            name = f"part-{context.partitionId():06d}-{part:05d}.warc{'.gz' if compress else ''}"
            system.move(f"{root}/{temporary}", f"{root}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], type=pa.int64())], names=["file", "records"])

        for batch in batches:
            for page_id, url, payload, first_id in zip(*[c.to_pylist() for c in batch.columns]):
                if stream is None:
                    temporary = f"writing-{context.taskAttemptId()}-{part}"
                    stream = system.open_output_stream(f"{root}/{temporary}", compression=None)
                data = record("response" if first_id is None else "revisit", page_id, url, payload, first_id)
                stream.write(_member(data) if compress else data)
                count += 1
                if count == RECORDS_PER_FILE:
                    yield close()
                    part, count, stream = part + 1, 0, None
        if stream is not None:
            yield close()

    return rows.mapInArrow(run, "file string, records bigint")


class _Source:
    """A file read forward in blocks, with the bytes from the current place on in ``buffer``."""

    def __init__(self, stream) -> None:
        self.stream, self.buffer, self.place, self.ended = stream, b"", 0, False

    def fill(self, size: int) -> bool:
        """Have at least ``size`` bytes in the buffer; False if the file has fewer."""
        if len(self.buffer) < size and not self.ended:
            parts, have = [self.buffer], len(self.buffer)
            while have < size:
                more = self.stream.read(max(BLOCK, size - have))
                if not more:
                    self.ended = True
                    break
                parts.append(more)
                have += len(more)
            self.buffer = b"".join(parts)
        return len(self.buffer) >= size

    def skip(self, size: int) -> None:
        self.buffer = self.buffer[size:]
        self.place += size

    def next_of(self, marks: tuple[bytes, ...], start: int) -> bool:
        """Skip to the first mark at or after ``start``; to the end if there is none."""
        longest = max(map(len, marks))
        while True:
            self.fill(start + BLOCK)
            found = [i for i in (self.buffer.find(m, start) for m in marks) if i >= 0]
            if found:
                self.skip(min(found))
                return True
            if self.ended:
                self.skip(len(self.buffer))
                return False
            tail = max(start, len(self.buffer) - longest + 1)
            self.skip(tail)
            start = 0


class Damaged(ValueError):
    pass


def parsed(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, bytes used) of the record at the start of ``data``, all checks passed.

    ``data`` may be cut short; then the length that would be needed is in the error's second value.
    """
    if not data.startswith(b"WARC/"):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", 0, LONGEST_HEADER)
    if end < 0:
        raise Damaged("no end of header", LONGEST_HEADER)
    lines = data[:end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        raise Damaged("bad version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("bad header line")
        try:
            headers[name.strip().decode("ascii").lower()] = value.strip().decode()
        except UnicodeDecodeError:
            raise Damaged("bad header text") from None
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit() or len(size) > 15:
        raise Damaged("bad length")
    start, total = end + 4, end + 4 + int(size) + 4
    if len(data) < total:
        raise Damaged("cut short", total)
    if data[total - 4 : total] != b"\r\n\r\n":
        raise Damaged("no end of record")
    block = data[start : total - 4]
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted[5:] != base32_sha1(block):
        raise Damaged("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    wanted = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and wanted.startswith("sha1:") and wanted[5:] != base32_sha1(payload):
        raise Damaged("payload digest differs")
    return headers, payload, total


def _plain_records(source: _Source) -> Iterator[tuple]:
    while source.fill(1):
        at = source.place
        need = LONGEST_HEADER
        while True:
            source.fill(need)
            try:
                headers, payload, used = parsed(source.buffer)
            except Damaged as error:
                if len(error.args) > 1 and error.args[1] > len(source.buffer) and not source.ended:
                    need = error.args[1]
                    continue
                reason = error.args[0]
                source.next_of((b"WARC/1.", b"WARC/0."), 1)
                yield None, at, source.place, reason
            else:
                yield (headers, payload), at, at + used, None
                source.skip(used)
            break


def _packed_records(source: _Source) -> Iterator[tuple]:
    while source.fill(1):
        at = source.place
        unpacker = zlib.decompressobj(31)
        parts, taken, reason = [], 0, None
        try:
            if not source.fill(len(_MEMBER)) or not source.buffer.startswith(_MEMBER):
                raise Damaged("no gzip member")
            while not unpacker.eof:
                if not source.fill(taken + 1):
                    raise Damaged("member cut short")
                piece = source.buffer[taken:]
                parts.append(unpacker.decompress(piece))
                taken += len(piece) - len(unpacker.unused_data)
            data = b"".join(parts)
            headers, payload, used = parsed(data)
            if used != len(data):
                raise Damaged("bytes after the record")
        except (Damaged, zlib.error) as error:
            reason = error.args[0] if isinstance(error, Damaged) else "bad gzip data"
        if reason is None:
            yield (headers, payload), at, at + taken, None
            source.skip(taken)
        else:
            source.next_of((_MEMBER,), 1)
            yield None, at, source.place, reason


def records_of(stream) -> Iterator[tuple]:
    """((headers, payload) or None, first byte, end, reason) of a plain or packed archive.

    Neighbouring gaps are one gap, with the first reason.
    """
    source = _Source(stream)
    source.fill(BLOCK)
    # the first mark tells the kind, as the start itself may be damaged
    packed, plain = source.buffer.find(_MEMBER), source.buffer.find(b"WARC/")
    made = _packed_records(source) if packed >= 0 and (plain < 0 or packed < plain) else _plain_records(source)
    gap = None
    for found, first, end, reason in made:
        if found is None:
            gap = (gap[0], end, gap[2]) if gap else (first, end, reason)
            continue
        if gap:
            yield None, *gap
            gap = None
        yield found, first, end, None
    if gap:
        yield None, *gap


_READ = "file string, first bigint, end bigint, gap string, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length bigint, payload binary"


def read_archives(spark: SparkSession, folder: str, files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the named files below ``folder``.

    A gap has its byte range and the reason in ``gap``, and nulls elsewhere. ``payloads`` False
    leaves the bytes out; they are checked all the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        names = [part.split(" ")[0] for part in _READ.split(", ")]
        kinds = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[part.split(" ")[1]] for part in _READ.split(", ")]

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for found, first, end, reason in records_of(stream):
                        if found is None:
                            rows.append((name, first, end, reason) + (None,) * 7)
                            continue
                        headers, payload = found
                        length = headers.get("x-payload-length", str(len(payload)))
                        rows.append((
                            name, first, end, None, headers.get("warc-type"), headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"),
                            headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(length) if length.isdigit() else None, payload if payloads else None,
                        ))
                        size += len(payload) if payloads else 256
                        if size > 4 * BLOCK:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    return files.select("file").mapInArrow(run, _READ)


def round_trip(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write the pages, read the files back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    from tenderline.llm.common import written

    spark = pages.sparkSession
    files = written(write_archives(pages, folder, least), "warc-files")
    # a file per task: their list is small, the files are not
    back = read_archives(spark, folder, files.repartition(max(files.count(), 1), "file"), payloads=False).where("gap IS NULL")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("bigint")
    return back.select(
        as_id("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", as_id("refers_to").alias("refers_to")
    )


#: DuckDB SQL of the same digest over the table pages; SHA-1 in base32 is spelled out by 5-bit groups.
WARC_SQL = """
WITH pages_of AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (
  SELECT page_id, n, h, list_transform(range(0, 8), lambda g: CAST('0x' || substr(h, 5 * g + 1, 5) AS BIGINT)) AS parts FROM pages_of),
digests AS (
  SELECT page_id, n, h, array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((parts[i // 4 + 1] >> (5 * (3 - i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS digest
  FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM digests)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > first_id OR (page_id IS NULL AND first_id IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id OR (page_id IS NULL AND first_id IS NOT NULL) THEN first_id END AS refers_to
FROM firsts
"""
