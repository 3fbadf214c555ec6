"""WARC archives: one gzip member per record, written by tasks and read back by byte range.

Writing finds, per payload, the smallest page_id from a pre-aggregated digest table; the other pages
become revisit records without payload. Each task writes files of its own under names no other attempt
uses, and reports them in a manifest; only what successful tasks reported is ever read.

Reading cuts files into byte ranges. A task looks for gzip magic in its range, accepts a place as the
start of a member only if it inflates to a WARC header, and owns the records that start inside the
range, reading past its end where the last one does. No index and no whole-file read is needed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.workspace import materialize, new_folder

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 16 << 20
FILE_BYTES = 512 << 20
MOST_TASKS = 50_000
_SLACK = 1 << 16

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def digest(payload: bytes) -> str:
    """Base-32 SHA-1, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, response_id) -> bytes:
    revisit = page_id != response_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{'' if response_id is None else response_id}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archive(pages: DataFrame, folder: str, smallest_revisit: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of page_id, url, html; the manifest of the files written.

    Of rows with equal payloads of ``smallest_revisit`` bytes or more, that with the smallest page_id
    is a response and the others revisit it; rows that repeat that page_id are responses too. A null
    html is an empty payload, a null url leaves its header out, a null page_id gets an empty id and
    is a response only where its payload has no other. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_sha", F.sha1("html"))
    first = rows.groupBy("_sha").agg(F.min("page_id").alias("response_id"))
    joined = rows.join(first, "_sha").withColumn(
        "response_id",
        F.when(F.octet_length("html") >= smallest_revisit, F.col("response_id")).otherwise(F.col("page_id")),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        out, path, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(k) for k in ("page_id", "url", "html", "response_id")), strict=True):
                page_id, url, html, response_id = (x.as_py() for x in row)
                if out is None:
                    system.create_dir(root, recursive=True)
                    path = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = system.open_output_stream(path, compression=None), 0, 0
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = packer.compress(_record(page_id, url, html.encode(), response_id)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        if done:
            base = folder[: len(folder) - len(root)] if folder.endswith(root) else ""
            columns = list(zip(*((base + p, n, c) for p, n, c in done), strict=True))
            yield pa.record_batch([pa.array(c) for c in columns], ["path", "bytes", "records"])

    written = joined.select("page_id", "url", "html", "response_id").mapInArrow(run, MANIFEST)
    return materialize(written, "warc-manifest")


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every member that starts in the range and inflates to a WARC header."""
    file.seek(start)
    data = bytearray(file.read(min(size, end + _SLACK) - start))

    def inflate(at: int) -> tuple[bytes, int] | None:
        stream = zlib.decompressobj(31)
        try:
            parts = [stream.decompress(bytes(data[at : at + 4096]))]
            if not parts[0].startswith(b"WARC/1."):
                return None
            used = min(at + 4096, len(data))
            while not stream.eof:
                if used == len(data):
                    more = file.read(1 << 20)
                    if not more:
                        raise ValueError(f"record at {start + at} breaks off")
                    data.extend(more)
                chunk = bytes(data[used : used + (1 << 18)])
                parts.append(stream.decompress(chunk))
                used += len(chunk)
        except zlib.error:
            return None
        return b"".join(parts), used - len(stream.unused_data)

    at = data.find(MAGIC)
    while at >= 0 and start + at < end:
        found = inflate(at)
        if found is None:
            at = data.find(MAGIC, at + 1)
        else:
            yield start + at, found[0]
            at = data.find(MAGIC, found[1])


_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*([^\r\n]*)", re.M)


def _parsed(content: bytes) -> tuple:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.lower(): v.decode() for k, v in _FIELD.findall(head)}
    block = rest[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = {k.lower(): v.decode() for k, v in _FIELD.findall(http)}.get(b"content-length")
    kind, claimed = fields.get(b"warc-type"), fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if claimed and digest(payload) != claimed:
            raise ValueError(f"payload of {fields.get(b'warc-record-id')} does not match its digest")
        size, claimed = len(payload), digest(payload)
    else:
        size, payload = int(stated) if stated else None, None
    return (
        fields.get(b"warc-record-id"),
        kind,
        fields.get(b"warc-target-uri"),
        fields.get(b"warc-refers-to"),
        claimed or None,
        size,
        payload,
    )


def read_archive(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the files named by ``path`` and ``bytes``, read in ranges of ``split_bytes``.

    A revisit has a null payload; its digest and length are those its headers state for the full
    payload. A response whose payload does not match its digest, or a record that breaks off, is an
    error. No files give no rows.
    """
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes)))
    splits = manifest.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    tasks = splits.count()
    splits = splits.repartition(max(1, min(tasks, MOST_TASKS)), "path", "start")
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, local = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with system.open_input_file(local) as file:
                    for offset, content in members(file, size, start, min(size, start + split_bytes)):
                        rows.append((path, offset, *_parsed(content)))
                        held += len(content)
                        if held > 8 << 20:
                            yield _batch(rows, kinds, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, kinds, names)

    return splits.mapInArrow(run, RECORDS)


def _batch(rows, kinds, names) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def archive_round_trip(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write pages to archives in the shared folder, read them back, and describe each record."""
    folder = new_folder(pages.sparkSession, "warc")
    records = read_archive(write_archive(pages, folder), split_bytes)

    def page(column: str):
        return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
