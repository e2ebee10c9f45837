"""WARC archives: written one gzip member per record, read back by byte ranges.

Tasks write files of their own in a shared folder and report them; a file counts only if
its task's report did, so a task that runs again leaves nothing that is read twice. The
reader cuts files into byte ranges without an index: a task looks for gzip magic in its
range, takes a candidate for a record if its first bytes decode to a record header, and
owns the records that start inside, reading past the end where the last one goes on.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm.common import chunks, whole_text
from payscope.session import materialize

#: Payloads below this size are never revisits; bytes of a range of the reader.
LEAST_REVISIT, RANGE = 100, 8 << 20
#: Tasks of the reader; with more ranges a task has several.
READ_TASKS = 50_000
#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLOCK = 1 << 16
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs


def _open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The folder as Spark names it; Arrow has other names for two of the file systems."""
    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest)


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed. A revisit has the response's HTTP header and no body."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(id, digest, refers_to), once each: keys and payloads (by SHA-256) of the rows whose
    payload another row with a smaller key has."""
    size = F.octet_length(whole_text(html))
    slim = pages.select(
        F.col(key).alias("id"), size.alias("size"), F.unhex(F.sha2(whole_text(html), 256)).alias("digest")
    ).filter(F.col("size") >= LEAST_REVISIT)
    slim = materialize(slim, "digests")
    groups = slim.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    groups = materialize(groups.select("digest", "first"), "groups")
    found = slim.join(groups, "digest").filter(~F.col("id").eqNullSafe(F.col("first")))
    return found.select("id", "digest", F.col("first").alias("refers_to")).distinct()


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row to ``folder`` (a URI that all executors reach) and returns
    (file, bytes, records), written beside them.

    Null payloads are empty; a null key writes a record without one, and revisits the
    smallest key with the same payload. Rows that share the smallest key are all
    responses. An empty table writes no file. Other columns are left out. Rows are told
    apart by key and payload alone, so it doesn't matter how scans are split.
    """
    rows = pages.select(
        F.col(key).alias("id"), F.col(url).alias("url"), whole_text(html).alias("html"), F.unhex(F.sha2(whole_text(html), 256)).alias("digest")
    )
    # Written, so that rows which share key and payload can be split between tasks.
    known = materialize(revisits(pages, key, html), "revisits").select(F.col("id").alias("of"), F.col("digest").alias("same"), "refers_to")
    rows = rows.join(known, F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left").select("id", "url", "refers_to", "html")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open_folder(folder)
        name, size, n, out = "", 0, 0, None
        for batch in chunks(batches):
            if out is None:
                name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                system.create_dir(top, recursive=True)
                out = system.open_output_stream(f"{top}/{name}", compression=None)
            for i, u, refers_to, text in zip(*(c.to_pylist() for c in batch.columns)):
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = press.compress(record(i, u, text.encode(), refers_to, date)) + press.flush()
                out.write(member)
                size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            yield pa.record_batch([[name], [size], [n]], ["file", "bytes", "records"])

    return materialize(rows.mapInArrow(work, "file string, bytes long, records long"), "warc-files")


class _Range:
    """Bytes of a file from an offset on, fetched in blocks as they are asked for."""

    def __init__(self, source, size: int, start: int):
        self.source, self.size, self.base, self.data = source, size, start, b""

    def get(self, at: int, n: int) -> bytes:
        if not self.base <= at <= self.base + len(self.data):
            self.base, self.data = at, b""
        while self.base + len(self.data) < min(at + n, self.size):
            self.source.seek(self.base + len(self.data))
            more = self.source.read(max(_BLOCK, n))
            if not more:
                break
            keep = at - self.base
            self.data, self.base = self.data[keep:] + more, at
        return self.data[at - self.base : at - self.base + n]


def _member(window: _Range, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields (names in lower case), block and end of the record that starts at a byte, or None if none
    does: the member has to begin like a record before the rest is read. A header may have
    any length, since it holds the whole url."""
    unzip, text, place, head, seen = zlib.decompressobj(31), bytearray(), at, -1, 0
    while not unzip.eof:
        piece = window.get(place, _BLOCK if text else 1024)
        if not piece:
            return None
        try:
            text += unzip.decompress(piece)
        except zlib.error:
            return None
        place += len(piece)
        if head < 0:
            if not bytes(text[:7]).startswith(b"WARC/1."[: len(text)]):
                return None
            head = text.find(b"\r\n\r\n", seen)
            seen = max(0, len(text) - 3)
    if head < 0:
        return None
    lines = bytes(text[:head]).decode(errors="replace").split("\r\n")[1:]
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = fields.get("content-length", "")
    if not length.isdigit() or head + 4 + int(length) > len(text):
        return None
    return fields, bytes(text[head + 4 : head + 4 + int(length)]), place - len(unzip.unused_data)


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records that start in the byte range [start, end) of a file."""
    window, at = _Range(source, size, start), start
    while at < end:
        block = window.get(at, min(_BLOCK, end - at) + len(MAGIC) - 1)
        found = block.find(MAGIC)
        if found < 0:
            at += max(1, len(block) - len(MAGIC) + 1)
            continue
        at += found
        got = _member(window, at) if at < end else None
        if got is None:
            at += 1
        else:
            yield got[:2]
            at = got[2]


def read_warc(spark: SparkSession, folder: str, files: DataFrame, span: int = RANGE, payload: bool = True) -> DataFrame:
    """One row per record of ``files`` (file, bytes): ``record_id``, ``page_id``, ``url``,
    ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest`` (hex) and, if
    asked for, ``payload``, null for revisits. Size and digest are of the payload itself,
    for revisits as their header states them, null where it doesn't. A record of another
    type has its whole block as payload. A range of ``span`` bytes is a task."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(span).cast("long")))
    ranges = files.filter("bytes > 0").select("file", "bytes", starts.alias("start"))
    # A row stands for megabytes to read, so rows are dealt out one to a task.
    tasks = files.agg(F.sum(F.ceil(F.col("bytes") / span))).first()[0]
    ranges = ranges.repartition(min(int(tasks or 1), READ_TASKS))
    names = ["record_id", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *(["payload"] if payload else [])]
    schema = pa.schema(
        [(n, pa.int64() if n in ("page_id", "refers_to", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in names]
    )

    def row(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields.get("warc-type")
        number = lambda k: int(fields[k]) if fields.get(k, "").isdigit() else None
        head, _, body = block.partition(b"\r\n\r\n") if kind in ("response", "revisit") else (b"", b"", block)
        if kind == "revisit":
            stated = re.search(rb"(?im)^content-length: *(\d+)", head)
            size, digest, body = int(stated[1]) if stated else None, fields.get("warc-payload-digest"), None
            digest = digest.removeprefix("sha256:") if digest else None
        else:
            size, digest = len(body), hashlib.sha256(body).hexdigest()
        whole = (fields.get("warc-record-id"), number("page-id"), fields.get("warc-target-uri"), kind, number("refers-to-page-id"), size, digest, body)
        return whole[: len(names)]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open_folder(folder)
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                held, weight = [], 0
                with system.open_input_file(f"{top}/{name}") as source:
                    for fields, block in records_in(source, size, start, min(start + span, size)):
                        held.append(row(fields, block))
                        weight += len(block) if payload else 256
                        if weight > 4 << 20:
                            yield pa.record_batch([list(c) for c in zip(*held)], schema=schema)
                            held, weight = [], 0
                if held:
                    yield pa.record_batch([list(c) for c in zip(*held)], schema=schema)

    kinds = {"page_id": "long", "refers_to": "long", "payload_bytes": "long", "payload": "binary"}
    return ranges.mapInArrow(work, ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names))


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of the gzipped archives in a folder, whoever wrote them. They have to
    be gzipped record by record, as the format asks for."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"))


def complete(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records``, written, if they are as many as the writer of ``files`` reported."""
    records = materialize(records, "records")
    have, want = records.count(), files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    if have != want:
        raise RuntimeError(f"{have} records read of {want} written")
    return records
