"""WARC archives by way of a chunked record table.

A record is rows of (record, chunk number) with at most ``chunk`` bytes each. Writing streams the rows of a partition
into one archive of gzip members, one per record; the digest of a payload is carried from chunk to chunk and compared
with the header's at the last one. Reading streams archives in spans of whole members and gives the chunk table back,
each row with the digest of the payload so far. The page that is written lies in its row, because the table has it there; beside
it neither side holds more of a payload than a chunk. Archives go to
the shared folder, first under a task attempt's name and then renamed, so a task that is run again does no harm.

Records with equal payloads of ``min_bytes`` or more: those with the largest page_id are responses, the rest are
revisits of it. Edge cases: a null payload counts as empty; a null page_id sorts below all and is given back as null;
rows that repeat the largest page_id are all responses; a null url is left out; line ends in a url are escaped; an
empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.shared import folder, written

PAGE = "urn:sievework:page:"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SPANS = "archive string, begin long, size long, records long"
CHUNKS = "page_id long, url string, record_type string, refers_to long, chunk_no long, last boolean, payload_bytes long, payload_digest string, data binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_table(pages: DataFrame, payload: str = "html", min_bytes: int = 0, chunk: int = 1 << 20) -> DataFrame:
    """The chunk table of what is to be written: one row per chunk, chunks of a record in order and together."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    # digests and ids find the responses; payloads then meet them by page, however many pages share a payload
    ids = rows.select("page_id", "digest", "n")
    first = ids.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("best"))
    found = ids.distinct().join(first, "digest").filter(F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best")))
    refers = found.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "best")
    joined = rows.join(refers, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    typed = joined.select(
        "page_id", "url", "digest", "n", F.col("best").alias("refers_to"), F.when(F.col("best").isNotNull(), F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )
    # chunks are cut from the payload one at a time, so no row holds them all
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("payload") / chunk).cast("int") - 1))
    each = typed.select("page_id", "url", "digest", "n", "refers_to", "payload", F.explode(numbers).alias("_i"))
    return each.select("page_id", "url", "digest", "n", "refers_to", F.col("_i").cast("long").alias("chunk_no"), F.substring("payload", F.col("_i") * chunk + 1, F.lit(chunk)).alias("data"))


def _header(page_id: int | None, url: str | None, digest: str, n: int, refers_to: int | None, date: str) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(HTTP) + (n if refers_to is None else 0)}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write(records: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", span: int = 8 << 20) -> DataFrame:
    """Write a chunk table as archives under ``path``; give the spans (archive, begin, size, records) of whole records,
    as a table that is written when this returns."""

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, out, at, begin, count = [], None, 0, 0, 0
        task = TaskContext.get()
        store, place = fs.FileSystem.from_uri(path)
        name = f"{place}/part-{task.partitionId():06d}.warc.gz"
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(place, recursive=True)
                    own = f"{name}.{task.taskAttemptId()}"
                    out = store.open_output_stream(own)
                if row["chunk_no"] == 0:
                    digest, gz, left = hashlib.sha1(), zlib.compressobj(1, wbits=31), row["n"] if row["refers_to"] is None else 0
                    head = _header(row["page_id"], row["url"], base32(bytes.fromhex(row["digest"])), row["n"], row["refers_to"], date)
                    at += out.write(gz.compress(head + HTTP))
                digest.update(row["data"])
                left -= len(row["data"])
                at += out.write(gz.compress(row["data"]))
                if left == 0:
                    if row["refers_to"] is None and digest.hexdigest() != row["digest"]:
                        raise ValueError(f"chunks of page {row['page_id']} don't give its digest")
                    at += out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    count += 1
                    if at - begin >= span:
                        spans.append((f"{path}/part-{task.partitionId():06d}.warc.gz", begin, at - begin, count))
                        begin, count = at, 0
        if out is not None:
            out.close()
            store.move(own, name)
            if count:
                spans.append((f"{path}/part-{task.partitionId():06d}.warc.gz", begin, at - begin, count))
        cols = list(zip(*spans, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["archive", "begin", "size", "records"])

    return written(records.mapInArrow(archive, SPANS), "warc-spans")


def _members(stream, size: int, step: int = 1 << 16) -> Iterator[Iterator[bytes]]:
    """Each gzip member of ``size`` bytes of a stream as an iterator of its pieces, to be used up before the next."""
    rest, left = b"", size

    def pieces() -> Iterator[bytes]:
        nonlocal rest, left
        gz = zlib.decompressobj(wbits=31)
        while not gz.eof:
            if not rest:
                rest = stream.read(min(step, left))
                left -= len(rest)
                if not rest:
                    raise ValueError("an archive ends within a record")
            piece = gz.decompress(rest, step)
            rest = gz.unconsumed_tail or gz.unused_data
            if piece:
                yield piece

    while rest or left:
        yield pieces()


def read(spans: DataFrame, chunk: int = 1 << 20, data: bool = True) -> DataFrame:
    """The chunk table of archives: payload_bytes and payload_digest (base32 SHA-1) are those of the payload up to and
    with this chunk; on the last chunk, of all of it. Without ``data`` payloads are read and digested all the same."""

    def span_rows(archive: str, begin: int, size: int) -> Iterator[tuple]:
        store, place = fs.FileSystem.from_uri(archive)
        with store.open_input_file(place) as f:
            f.seek(begin)
            for pieces in _members(f, size):
                buffer = b""
                for piece in pieces:
                    buffer += piece
                    if b"\r\n\r\n" in buffer:
                        break
                head, _, buffer = buffer.partition(b"\r\n\r\n")
                fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                while len(buffer) < len(HTTP):
                    buffer += next(pieces)
                buffer, left = buffer[len(HTTP) :], int(fields["Content-Length"]) - len(HTTP)
                page, refers = (re.sub(r"[<>]", "", fields.get(k, "")).removeprefix(PAGE) for k in ("WARC-Record-ID", "WARC-Refers-To"))
                own = (int(page) if page else None, fields.get("WARC-Target-URI"), fields["WARC-Type"], int(refers) if refers else None)
                if own[2] == "revisit":
                    for _ in pieces:
                        pass
                    yield (*own, 0, True, int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), b"" if data else None)
                    continue
                digest, done, number = hashlib.sha1(), 0, 0
                while True:
                    while len(buffer) < min(chunk, left):
                        buffer += next(pieces)
                    part, buffer = buffer[: min(chunk, left)], buffer[min(chunk, left) :]
                    digest.update(part)
                    left, done = left - len(part), done + len(part)
                    yield (*own, number, left == 0, done, base32(digest.copy().digest()), part if data else None)
                    number += 1
                    if left == 0:
                        break
                for _ in pieces:
                    pass
                if f"sha1:{base32(digest.digest())}" != fields["WARC-Payload-Digest"]:
                    raise ValueError(f"page {own[0]} of {archive} doesn't have the digest in its header")

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary())
        names = ["page_id", "url", "record_type", "refers_to", "chunk_no", "last", "payload_bytes", "payload_digest", "data"]
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
            rows.clear()
            return batch

        for batch in batches:
            for s in batch.to_pylist():
                held = 0
                for row in span_rows(s["archive"], s["begin"], s["size"]):
                    rows.append(row)
                    held += len(row[-1] or b"") + 200
                    if held > 8 << 20:
                        yield flush()
                        held = 0
                if rows:
                    yield flush()

    return spans.mapInArrow(table, CHUNKS)


def round_trip(spark: SparkSession, pages: DataFrame, payload: str = "html", min_bytes: int = 0, data: bool = False) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back as a chunk table."""
    spans = write(record_table(pages, payload, min_bytes), folder(spark, "warc"))
    many = max(1, spark.sparkContext.defaultParallelism)
    return read(spans.repartition(max(many, 4 * many), "archive", "begin"), data=data)
