"""A log of commits over a table in hash buckets: writers that work at once lose nothing, readers see whole versions.

Under ``root`` lie data folders, each written once, and ``log/<number>.json``, which names for each bucket the folder
that holds it. A version exists once its log entry does. An entry is put only where none is, in one step of the file
system: a writer that comes second sees that, and either carries its buckets over to the newer version, if that left
them alone, or merges again. A merge rewrites the buckets that its rows fall into and no others.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import feed

BUCKETS = 64
BUCKET = "_bucket"


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _entry(root: str, number: int) -> str:
    return f"{root}/log/{number:020d}.json"


def newest(spark: SparkSession, root: str) -> int:
    """The number of the newest version, -1 if there is none."""
    files, at = _path(spark, f"{root}/log")
    if not files.exists(at):
        return -1
    names = (s.getPath().getName() for s in files.listStatus(at))
    return max((int(n[:20]) for n in names if re.fullmatch(r"\d{20}\.json", n)), default=-1)


def entry(spark: SparkSession, root: str, number: int) -> dict:
    """What a version consists of; version -1 is empty."""
    if number < 0:
        return {"buckets": {}, "batches": {}, "count": BUCKETS}
    files, at = _path(spark, _entry(root, number))
    stream = files.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def put(spark: SparkSession, root: str, number: int, content: dict) -> bool:
    """Put an entry where none is. False if another writer was first. The entry is whole from the moment it exists."""
    files, target = _path(spark, _entry(root, number))
    files.mkdirs(target.getParent())
    spare_files, spare = _path(spark, f"{root}/log/.{uuid.uuid4().hex}")
    out = spare_files.create(spare, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    try:
        if files.getScheme() == "file":  # a local rename would replace what is there; a link doesn't
            try:
                os.link(spare.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(spare), files.makeQualified(target), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True
    finally:
        if files.exists(spare):
            files.delete(spare, False)


def table(spark: SparkSession, root: str, number: int | None = None, buckets: set[int] | None = None) -> DataFrame | None:
    """A version, the newest if none is named, or some of its buckets; null where nothing was written."""
    held = entry(spark, root, newest(spark, root) if number is None else number)
    folders: dict[str, list[str]] = {}
    for b, folder in held["buckets"].items():
        if buckets is None or int(b) in buckets:
            folders.setdefault(folder, []).append(f"{root}/{folder}/{BUCKET}={b}")
    paths = [p for ps in folders.values() for p in ps]
    return spark.read.option("mergeSchema", True).parquet(*paths) if paths else None


def merge(root: str, batch: DataFrame, key: str, enrich: list[str], order: str, checks: list[str], mark: tuple[str, int] | None = None, buckets: int = BUCKETS, between: Callable[[], None] | None = None) -> int:
    """Merge a batch into the newest version, as ``feed.upsert`` does, and commit the next one; its number is returned. A
    merge that would lose a key or rewrite one of ``checks`` is refused before anything is committed. ``mark`` (a query
    and its batch) makes a batch that is replayed change nothing. ``between`` is called between merge and commit, for
    tests. Failed and overtaken merges leave folders that no version names; ``swept`` deletes them."""
    spark = batch.sparkSession
    work, base = None, {}
    while True:
        now = newest(spark, root)
        held = entry(spark, root, now)
        if mark and held["batches"].get(mark[0], -1) >= mark[1]:
            return now
        count = held["count"] if now >= 0 else buckets
        if work is None or count != base["count"] or any(held["buckets"].get(b) != base["buckets"].get(b) for b in work):
            base = {**held, "count": count}
            work = _write(spark, root, batch, key, enrich, order, checks, now, count)
        if between:
            between()
        batches = {**held["batches"], **({mark[0]: mark[1]} if mark else {})}
        if put(spark, root, now + 1, {"buckets": {**held["buckets"], **work}, "batches": batches, "count": count}):
            return now + 1


def _write(spark: SparkSession, root: str, batch: DataFrame, key: str, enrich: list[str], order: str, checks: list[str], number: int, buckets: int) -> dict[str, str]:
    rows = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    touched = {r[0] for r in rows.select(BUCKET).distinct().collect()}  # at most ``buckets``
    if not touched:
        return {}
    old = table(spark, root, number, touched)
    fresh = batch.drop(order).limit(0) if old is None else old.drop(BUCKET)
    merged = feed.upsert(fresh, batch, key, enrich, order).drop("outcome")
    if old is not None and not feed.violations(fresh, merged, key, checks).isEmpty():
        raise ValueError("the batch would lose keys or rewrite provenance")
    folder = f"data/{uuid.uuid4().hex}"
    out = merged.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    out.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{folder}")
    return {str(b): folder for b in touched}


def sink(root: str, key: str, enrich: list[str], order: str, checks: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """``merge`` for ``foreachBatch``."""

    def store(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "no-query"
        merge(root, batch, key, enrich, order, checks, (query, number), buckets)

    return store


def swept(spark: SparkSession, root: str, keep: int) -> int:
    """Delete data folders that none of the newest ``keep`` versions names, and older entries; returns the number of folders.
    No merge may be running."""
    last = newest(spark, root)
    numbers = range(max(0, last - keep + 1), last + 1)
    named = {f for n in numbers for f in entry(spark, root, n)["buckets"].values()}
    files, at = _path(spark, f"{root}/data")
    gone = [s.getPath() for s in files.listStatus(at) if f"data/{s.getPath().getName()}" not in named] if files.exists(at) else []
    files_log, log = _path(spark, f"{root}/log")
    for s in files_log.listStatus(log) if files_log.exists(log) else []:
        if re.fullmatch(r"\d{20}\.json", s.getPath().getName()) and int(s.getPath().getName()[:20]) < numbers.start:
            files_log.delete(s.getPath(), False)
    for p in gone:
        files.delete(p, True)
    return len(gone)
