"""WARC archives: a writer that stores equal payloads once, and a reader that splits files at any byte.

Writer: each record is a gzip member of its own. Of the records with equal payloads the one with the largest page_id is a
``response``; the others are ``revisit`` records that refer to it and carry the HTTP headers only. Each task writes one
file under a name of its own and moves it to the final name of its partition, so a task that runs again replaces its file.

Reader: a task gets a byte range, looks for the gzip magic number from its start on, and accepts the first candidate that
decodes to a WARC header. From there it reads member after member, and owns the records that start inside its range.

Defined results: a null html is an empty payload; a null page_id never is the one referred to while another is there; a
repeated row is a record of its own, and equal rows that hold the largest page_id all are responses; an empty table gives
no file and no record; a payload shorter than ``least_bytes`` always is a response. Payloads are never cut. A member that
can't be decoded to its end is an error that names the file and offset.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.llm.arrays import map_in_tasks

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
RECORDS = (
    "path string, offset long, record_type string, page_id long, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to long"
)


def write_archives(pages: DataFrame, folder: str, at: str = "2026-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) into ``folder``, which all executors share.

    Returns the list of archives (path, bytes, records), itself a table beside them."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    stored_at = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"))
    rows = rows.join(stored_at, "digest", "left").select("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        final = f"part-{task.partitionId():05d}.warc.gz"
        where, base = fs.FileSystem.from_uri(folder)
        own, sink, size, count = f"{base}/.{final}-{task.taskAttemptId()}", None, 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                if sink is None:
                    where.create_dir(base, recursive=True)
                    sink = where.open_output_stream(own)
                member = _member(*(batch.column(i)[row].as_py() for i in range(5)), at)
                sink.write(member)
                size, count = size + len(member), count + 1
        if sink is not None:
            sink.close()
            where.move(own, f"{base}/{final}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{final}"]), pa.array([size]), pa.array([count])], ["path", "bytes", "records"])

    map_in_tasks(rows, write, "path string, bytes long, records long").write.parquet(f"{folder}/_archives")
    return pages.sparkSession.read.parquet(f"{folder}/_archives")


def _urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _member(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, at: str) -> bytes:
    revisit = refers_to is not None and page != refers_to
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {at}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = 8 << 20, payloads: bool = False) -> DataFrame:
    """Records of the listed archives (path, bytes). Digest and size of a stored payload are taken from its bytes."""
    starts = F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split_bytes}L)")).alias("first")
    splits = archives.select("path", starts).select("path", "first", (F.col("first") + split_bytes).alias("last"))
    # one range each: a round robin of a short list of ranges
    splits = splits.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    schema = RECORDS + (", payload binary" if payloads else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for offset, member in members(path, first, last):
                    row = _record(path, offset, member, payloads)
                    rows.append(row)
                    held += len(row[-1] or b"") if payloads else 0
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield _rows(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows, names)

    return map_in_tasks(splits, read, schema)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"offset": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names)


def members(path: str, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """Offset and decoded bytes of the members that start in [first, last)."""
    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as source:
        start = _first_member(source, first, last)
        while start is not None and start < last:
            source.seek(start)
            decoder, out, used = zlib.decompressobj(31), io.BytesIO(), 0
            while not decoder.eof:
                data = source.read(min(CHUNK, 1 << 16))
                if not data:
                    if used == 0:
                        return
                    raise ValueError(f"{path}: member at {start} has no end")
                try:
                    out.write(decoder.decompress(data))
                except zlib.error as error:
                    raise ValueError(f"{path}: member at {start} can't be decoded: {error}") from error
                used += len(data)
            yield start, out.getvalue()
            start += used - len(decoder.unused_data)


def _first_member(source: pa.NativeFile, first: int, last: int) -> int | None:
    """First place in [first, last) where a gzip member begins that holds a WARC header."""
    at, tail = first, b""
    while at - len(tail) < last:
        source.seek(at)
        data = source.read(CHUNK)
        if not data:
            return None
        window = tail + data
        place = window.find(MAGIC)
        while place >= 0:
            start = at - len(tail) + place
            if start >= last:
                return None
            if _has_header(source, start):
                return start
            place = window.find(MAGIC, place + 1)
        tail = window[-2:]
        at += len(data)
    return None


def _has_header(source: pa.NativeFile, start: int) -> bool:
    source.seek(start)
    try:
        return zlib.decompressobj(31).decompress(source.read(4096), 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _record(path: str, offset: int, member: bytes, payloads: bool) -> tuple:
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), len(payload)
    if kind == "revisit":
        size, payload = int(_fields(http)["content-length"]), None
    elif base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{path}: payload at {offset} doesn't have its digest")
    row = (path, offset, kind, _page(fields["warc-record-id"]), fields.get("warc-target-uri"), digest, size, _page(fields.get("warc-refers-to")))
    return (*row, payload) if payloads else row
