"""A drop of files of many kinds: each goes to its parser by its name, and what can't be read is set aside with a reason."""

from __future__ import annotations

import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources import parse

#: Kinds by suffix, and limits of an archive.
KINDS = {".md": "markdown", ".txt": "markdown", ".html": "html", ".htm": "html", ".jsonl": "lines", ".json": "json", ".zip": "archive"}
MOST_FILES, MOST_BYTES = 300, 30 << 20
ARTICLE = "path string, member string, kind string, title string, url string, published string, text string, reason string"


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all files below a folder. Spark's scan leaves out files without a byte, so their names are added."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    every, empty = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True), []
    while every.hasNext():
        status = every.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            empty.append((status.getPath().toString(), b""))
    return found.unionByName(spark.createDataFrame(empty, "path string, content binary"))


def kind_of(name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(name, r"(\.[A-Za-z0-9]+)$", 1))
    return F.coalesce(*(F.when(suffix == s, k) for s, k in KINDS.items()), F.lit("unknown"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of archives one by one, or one row with the reason why there are none."""
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            rows: list[tuple] = []
            try:
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    infos = sorted((i for i in z.infolist() if not i.is_dir() and not i.filename.startswith("__MACOSX") and not posixpath.basename(i.filename).startswith(".")), key=lambda i: i.filename)
                    if len(infos) > MOST_FILES or sum(i.file_size for i in infos) > MOST_BYTES:
                        rows = [(path, None, None, "archive too large")]
                    else:
                        rows = [(path, i.filename, z.read(i), None) for i in infos] or [(path, None, None, "empty archive")]
            except (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, OSError) as e:
                # broken, encrypted or packed in a way that isn't known
                rows = [(path, None, None, f"bad archive: {type(e).__name__}")]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], ["path", "member", "content", "reason"])


def routed(drop: DataFrame, default: str = "{}") -> DataFrame:
    """Rows as ``ARTICLE`` of a drop (path, content): one for each document, for each line of a JSON lines file, and for each file or member
    that can't be read; the latter have a ``reason``. A JSON document that can't be read gives the ``default`` as its
    text, with the reason beside it. An empty or null content is an empty document."""
    plain = drop.select("path", F.lit(None).cast("string").alias("member"), "content", F.lit(None).cast("string").alias("reason"), kind_of(F.col("path")).alias("kind"))
    packed = plain.filter("kind = 'archive'").select("path", F.coalesce("content", F.lit(b"")).alias("content")).mapInArrow(_unpacked, "path string, member string, content binary, reason string")
    every = plain.filter("kind <> 'archive'").unionByName(packed.withColumn("kind", F.when(F.col("reason").isNotNull(), "archive").otherwise(kind_of(F.col("member")))))
    raw = F.coalesce(F.col("content").cast("string"), F.lit(""))
    unread = F.when(F.col("kind") == "archive", F.coalesce("reason", F.lit("archive in an archive"))).when(F.col("kind") == "unknown", "unknown kind").when(~F.is_valid_utf8(raw), "not UTF-8")
    read = every.withColumns({"reason": unread, "text": F.make_valid_utf8(raw)}).select("path", "member", "kind", "text", "reason")
    none, given = F.lit(None).cast("string"), ("path", "member", "kind")
    bad = read.filter("reason is not null").select(*given, none.alias("title"), none.alias("url"), none.alias("published"), F.when(F.col("kind") == "json", default).alias("text"), "reason")
    good = read.filter("reason is null").drop("reason")
    md = good.filter("kind = 'markdown'").withColumn("a", parse.markdown_article(F.col("text"))).select(*given, "a.title", "a.url", "a.published", F.col("a.body").alias("text"), none.alias("reason"))
    html = good.filter("kind = 'html'").withColumn("a", parse.page_text("text")).select(*given, "a.title", none.alias("url"), none.alias("published"), F.col("a.text"), none.alias("reason"))
    broken = lambda c: F.try_parse_json(c).isNull()
    json = good.filter("kind = 'json'").select(*given, none.alias("title"), none.alias("url"), none.alias("published"), F.when(broken(F.col("text")), default).otherwise(F.col("text")).alias("text"), F.when(broken(F.col("text")), "malformed JSON").alias("reason"))
    lines = good.filter("kind = 'lines'").withColumn("text", F.explode(F.split("text", "\r?\n"))).filter(F.trim("text") != "")
    lines = lines.select(*given, none.alias("title"), none.alias("url"), none.alias("published"), "text", F.when(broken(F.col("text")), "malformed line").alias("reason"))
    return bad.unionByName(md).unionByName(html).unionByName(json).unionByName(lines)


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What was read (a default counts as read), and the quarantine: (path, member, kind, reason), with the text of bad lines."""
    return rows.filter(F.col("reason").isNull() | (F.col("kind") == "json")).drop("reason"), rows.filter("reason is not null").select("path", "member", "kind", "reason", "text")
