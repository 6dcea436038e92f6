"""Structured Streaming forms of the incremental operators. A stream ends when its input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.operators import feed


def source(spark: SparkSession, path: str, schema: StructType | str, kind: str = "json", files: int = 1000) -> DataFrame:
    """New files of a folder as a stream; the checkpoint knows which were read."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files).load(path)


def once_per_key(stream: DataFrame, keys: list[str], time: str | None = None, delay: str = "7 days") -> DataFrame:
    """The first row of each key. With a time column the keys older than ``delay`` are forgotten; rows that late pass
    as new ones, so a merge behind it must still be idempotent."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys) if time else stream.dropDuplicates(keys)


def counts(stream: DataFrame, time: str, keys: list[str], window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows by window and keys, given out once a window is past the delay."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def upsert_versions(root: str, key: str, enrich: list[str], order: str, checks: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink for ``foreachBatch``: merge each batch into the newest finished version of a table under ``root`` and write
    the next version. Beside it lies a mark for the query's batch, so a batch that is replayed changes nothing, while
    batch 0 of a new checkpoint is merged like any other; a crash between version and mark leads to one more merge of
    the same rows, which changes no value. What a crash left half written is overwritten. A merge that would lose a key
    or rewrite one of ``checks`` is refused. A key is thereby seen only once its row is stored."""

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "no-query"
        files, mark = _files(spark, f"{root}/batches/{query}-{number}")
        if files.exists(mark):
            return
        newest = newest_version(spark, root)
        base = None if newest is None else version(spark, f"{root}/v{newest}")
        fresh = batch.drop(order).limit(0) if base is None else base
        merged = feed.upsert(fresh, batch, key, enrich, order).drop("outcome")
        if base is not None and not feed.violations(base, merged, key, checks).isEmpty():
            raise ValueError("the batch would lose keys or rewrite provenance")
        merged.write.mode("overwrite").parquet(f"{root}/v{0 if newest is None else newest + 1}")
        files.create(mark, True).close()

    return store


def newest_version(spark: SparkSession, root: str) -> int | None:
    """The number of the newest finished version under a folder."""
    files, at = _files(spark, root)
    if not files.exists(at):
        return None
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and version(spark, f"{root}/{n}") is not None), default=None)


def version(spark: SparkSession, path: str) -> DataFrame | None:
    """A finished version of a table, else null: a version counts once its writer has marked it as done."""
    files, mark = _files(spark, f"{path}/_SUCCESS")
    return spark.read.parquet(path) if files.exists(mark) else None


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Drain a stream through a sink and stop."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
