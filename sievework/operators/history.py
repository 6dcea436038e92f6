"""The history of a table as intervals: each content of a key with the first and last version that has it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LAST = "last"


def intervals(stacked: DataFrame, key: str, version: str, content: list[str]) -> DataFrame:
    """(key, content, first, last) of snapshots stacked with the number of their version; versions are consecutive
    numbers. A content that goes and comes back has an interval for each time. Rows alike in key and version count
    once."""
    w = W.partitionBy(key).orderBy(version)
    rows = stacked.select(key, version, F.struct(*content).alias("_c")).groupBy(key, version).agg(F.min("_c").alias("_c"))
    starts = F.coalesce((F.lag(version).over(w) < F.col(version) - 1) | ~F.col("_c").eqNullSafe(F.lag("_c").over(w)), F.lit(True))
    runs = rows.withColumn("_s", starts).withColumn("_run", F.sum(F.col("_s").cast("int")).over(w))
    return runs.groupBy(key, "_run").agg(F.first("_c").alias("_c"), F.min(version).alias("first"), F.max(version).alias(LAST)).select(key, *(F.col(f"_c.{c}").alias(c) for c in content), "first", LAST)


def changes(before: DataFrame | None, snapshot: DataFrame, key: str, content: list[str], version: int) -> DataFrame:
    """What a new version changes, against the snapshot before it: (key, content, version, gone) of keys that are new,
    have another content, or are gone."""
    now = snapshot.select(key, F.struct(*content).alias("_n")).groupBy(key).agg(F.min("_n").alias("_n"))
    if before is None:
        out = now.withColumn("gone", F.lit(False))
    else:
        old = before.select(key, F.struct(*content).alias("_o"), F.lit(True).alias("_was"))
        both = now.withColumn("_is", F.lit(True)).join(old, key, "full")
        out = both.filter(F.col("_is").isNull() | F.col("_was").isNull() | ~F.col("_n").eqNullSafe(F.col("_o"))).withColumn("gone", F.col("_is").isNull())
    return out.select(key, *(F.col(f"_n.{c}").alias(c) for c in content), F.lit(version).cast("long").alias("version"), "gone")


def as_of(log: DataFrame, key: str, content: list[str], version: int) -> DataFrame:
    """The snapshot of a version out of the changes up to it."""
    newest = log.filter(F.col("version") <= version).groupBy(key).agg(F.max_by(F.struct("gone", *content), "version").alias("_r"))
    return newest.filter(~F.col("_r.gone")).select(key, *(F.col(f"_r.{c}").alias(c) for c in content))


def spans(log: DataFrame, key: str, content: list[str]) -> DataFrame:
    """The changes as intervals; ``last`` is null for what the newest version still has."""
    nxt = F.lead("version").over(W.partitionBy(key).orderBy("version"))
    return log.withColumn(LAST, nxt - 1).filter(~F.col("gone")).select(key, *content, F.col("version").alias("first"), LAST)
