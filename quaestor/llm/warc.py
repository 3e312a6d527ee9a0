"""WARC archives: writing with revisit and continuation records, reading with segment reassembly (operator 1).

Writing: payload digests are counted by a partially aggregated groupBy, the least id per repeated digest is joined back
(only repeated digests, so the join is a broadcast or a skew-splittable sort-merge join). A task streams its pages into two
gzip-per-record files in the shared folder: records, and the continuations of records longer than a segment. File names
hold the task's attempt; only files that a successful attempt reports in the manifest are read, so lost executors and
repeated tasks leave nothing wrong behind.

Reading: the manifest's byte ranges are dealt out; a task parses its records, decodes whole ones at once and passes
segments on. Only segments are shuffled: grouped by origin identifier, ordered by number, checked to be numbered 1 to n and to
have the declared total length, joined, and the chunked transfer framing decoded. A group is one record, never more.

Defined results: null payload is empty; null url an empty target; null ids are written and read as null; equal payloads
under one least id are all responses. A record that fails a check comes back with ``valid`` false and no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, work_path, written

SEGMENT = 32 << 10
CHUNK = 8 << 10
RANGE = 2 << 20
DATE = "2026-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
SCAN = "id bigint, kind string, digest string, refers_to bigint, origin string, number int, total bigint, valid boolean, n_bytes bigint, body binary"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Payload in chunked transfer framing."""
    parts = []
    for a in range(0, len(payload), size):
        piece = payload[a : a + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Payload of chunked framing; chunk extensions and trailers are skipped. ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP header")
    fields = dict(x.split(b":", 1) for x in head.lower().split(b"\r\n")[1:] if b":" in x)
    return dechunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC record as its own gzip member."""
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in fields.items()] + [f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def records(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record, a gzip member of its own, of a byte range that begins and ends at records."""
    for raw in _members(memoryview(data)):
        head, found, rest = raw.partition(b"\r\n\r\n")
        if not found or not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _members(data: memoryview) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        opener, parts = zlib.decompressobj(31), []
        while not opener.eof:
            if at >= len(data):
                raise ValueError("an archive ends within a record")
            step = data[at : at + (1 << 14)]
            parts.append(opener.decompress(step))
            at += len(step)
        at -= len(opener.unused_data)
        yield b"".join(parts)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write the archives; returns their manifest (file, start, length), one row per byte range that begins at a record."""
    spark = pages.sparkSession
    folder = work_path(spark, "warc")
    few = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    keyed = few.withColumn("sha", F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    same = keyed.where(F.octet_length("payload") >= min_revisit).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    same = written(same.where("n > 1").select("sha", "first"), "same")
    whole = spread(keyed.join(same, "sha", "left").drop("sha"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, top = _opened(folder)
        store.create_dir(top, recursive=True)
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        names = [f"{stem}{x}.warc.gz" for x in ("", "-more")]
        sinks = [None, None]
        size, begun, rows = [0, 0], [0, 0], []

        def put(k: int, data: bytes) -> None:
            if sinks[k] is None:
                sinks[k] = store.open_output_stream(f"{top}/{names[k]}", compression=None)
            sinks[k].write(data)
            size[k] += len(data)
            if size[k] - begun[k] >= RANGE:
                rows.append((names[k], begun[k], size[k] - begun[k]))
                begun[k] = size[k]

        for batch in batches:
            for i, url, text, first in zip(*(batch.column(c) for c in ("id", "url", "payload", "first")), strict=True):
                i, url, first = i.as_py(), url.as_py() or "", first.as_py()
                payload = text.as_py().encode()
                name = f"<urn:uuid:{uuid.uuid4()}>"
                fields = {"WARC-Type": "response", "WARC-Record-ID": name, "WARC-Date": DATE, "WARC-Target-URI": url.replace("\r", "%0D").replace("\n", "%0A"), "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{digest32(payload)}"}
                if i is not None:
                    fields["X-Page-ID"] = str(i)
                if first is not None and i != first:
                    put(0, record(fields | {"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page": str(first)}, HTTP))
                    continue
                block = HTTP + chunked(payload)
                if len(block) <= segment:
                    put(0, record(fields, block))
                    continue
                parts = [block[a : a + segment] for a in range(0, len(block), segment)]
                put(0, record(fields | {"WARC-Segment-Number": "1"}, parts[0]))
                for n, part in enumerate(parts[1:], 2):
                    more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": str(n)}
                    if n == len(parts):
                        more["WARC-Segment-Total-Length"] = str(len(block))
                    put(1, record(more, part))
        for k, sink in enumerate(sinks):
            if sink is not None:
                sink.close()
                if size[k] > begun[k]:
                    rows.append((names[k], begun[k], size[k] - begun[k]))
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x}" for x in cols[0]], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["file", "start", "length"])

    return written(whole.mapInArrow(run, "file string, start bigint, length bigint"), "manifest")


def _row(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    number = fields.get("WARC-Segment-Number")
    page, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    page, first = page and int(page), first and int(first)
    told = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    kind = fields["WARC-Type"]
    if number:
        total = fields.get("WARC-Segment-Total-Length")
        return page, kind, told, first, fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), int(number), total and int(total), None, len(block), block
    if kind == "revisit":
        return page, kind, told, first, None, None, None, True, None, None
    return page, kind, *_decoded(block, told, first, keep)


def _decoded(block: bytes, told: str | None, first, keep: bool) -> tuple:
    try:
        payload = http_payload(block)
        own = digest32(payload)
        good = told in (None, own)
    except ValueError:
        payload, own, good = b"", told, False
    return own, first, None, None, None, good, len(payload) if good else None, payload if keep and good else None


def _scan_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in SCAN.split(", ")])


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per response and revisit record: id, record_type, digest, refers_to, valid, payload_bytes, payload.

    ``payloads`` false leaves the payload column null; everything is read, joined and checked all the same.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, length in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "length")), strict=True):
                store, place = _opened(name)
                with store.open_input_file(place) as f:
                    data = f.read_at(length, start)
                rows, size = [], 0
                for fields, block in records(data):
                    rows.append(_row(fields, block, payloads))
                    size += len(block)
                    if size > 4 << 20:
                        yield _scan_batch(rows)
                        rows, size = [], 0
                yield _scan_batch(rows)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segments in batch.column("segments"):
                parts = sorted(segments.as_py(), key=lambda s: s["number"])
                head, block = parts[0], b"".join(p["body"] for p in parts)
                whole = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and parts[-1]["total"] == len(block)
                decoded = _decoded(block, head["digest"], head["refers_to"], payloads) if whole else (head["digest"], head["refers_to"], None, None, None, False, None, None)
                yield _scan_batch([(head["id"], head["kind"], *decoded)])

    slots = manifest.sparkSession.sparkContext.defaultParallelism
    dealt = manifest.repartition(slots * 4)
    found = written(dealt.mapInArrow(scan, SCAN), "records")
    pieces = found.where("number is not null").select("origin", F.struct("number", "id", "kind", "digest", "refers_to", "total", "body").alias("s"))
    joined = pieces.groupBy("origin").agg(F.collect_list("s").alias("segments")).select("segments").mapInArrow(join, SCAN)
    every = found.where("number is null").unionByName(joined)
    return every.select("id", F.col("kind").alias("record_type"), "digest", "refers_to", "valid", F.col("n_bytes").alias("payload_bytes"), F.col("body").alias("payload"))


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 0) -> DataFrame:
    """Write the archives, read them back, resolve revisits: id, payload_bytes, payload_digest, record_type, refers_to."""
    found = written(read_archives(write_archives(pages, id_col, url_col, payload_col, min_revisit), payloads=False).drop("payload"), "read")
    bad = found.where("not valid").count()
    if bad:
        raise ValueError(f"{bad} records failed their checks")
    full = found.where("record_type = 'response'")
    again = found.where("record_type = 'revisit'").drop("payload_bytes")
    sizes = full.select(F.col("digest").alias("_digest"), "payload_bytes").join(again.select(F.col("digest").alias("_digest")).distinct(), "_digest", "left_semi").distinct()
    solved = again.join(sizes, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    return full.unionByName(solved).select(F.col("id").alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def oracle() -> str:
    """DuckDB SQL of roundtrip() on pages; base 32 is spelled from the digest's bits."""
    return """
with p as (select page_id, encode(coalesce(html, '')) as h from pages),
     d as (select page_id, octet_length(h) as n, sha1(h) as x from p),
     f as (select x, n, min(page_id) as first from d group by x, n),
     bits as (select x, list_aggregate(list_transform(string_split(x, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), 'string_agg', '') as b from (select distinct x from d)),
     spelt as (select x, list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * cast(substr(b, 5 * i + 1, 1) as int) + 8 * cast(substr(b, 5 * i + 2, 1) as int) + 4 * cast(substr(b, 5 * i + 3, 1) as int)
                  + 2 * cast(substr(b, 5 * i + 4, 1) as int) + cast(substr(b, 5 * i + 5, 1) as int), 1)), 'string_agg', '') as payload_digest from bits)
select d.page_id, cast(d.n as bigint) as payload_bytes, payload_digest,
       case when d.page_id = first then 'response' else 'revisit' end as record_type,
       case when d.page_id = first then null else first end as refers_to
from d join f on d.x = f.x and d.n = f.n join spelt on d.x = spelt.x"""
