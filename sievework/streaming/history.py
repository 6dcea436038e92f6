"""Version history that is stored as changes: a version adds rows only for keys that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.operators import history
from sievework.streaming import commits


def append(root: str, snapshot: DataFrame, key: str, content: list[str]) -> int:
    """Store the next version of a table and return its number, from 0. Two writers at once get numbers one after the
    other: the second compares with what the first has stored."""
    spark = snapshot.sparkSession
    while True:
        last = commits.newest(spark, root)
        before = as_of(spark, root, key, content, last) if last >= 0 else None
        number = last + 1
        folder = f"data/{commits.uuid.uuid4().hex}"
        history.changes(before, snapshot, key, content, number).write.parquet(f"{root}/{folder}")
        if commits.put(spark, root, number, {"folder": folder}):
            return number


def log(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """All changes up to a version, the newest if none is named."""
    last = commits.newest(spark, root) if version is None else version
    folders = [f"{root}/{commits.entry(spark, root, n)['folder']}" for n in range(last + 1)]
    return spark.read.parquet(*folders) if folders else None


def as_of(spark: SparkSession, root: str, key: str, content: list[str], version: int) -> DataFrame:
    return history.as_of(log(spark, root, version), key, content, version)
