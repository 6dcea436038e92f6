"""Proof that page ranges that were read cover what was asked for, without a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def gaps(read: DataFrame, wanted: DataFrame, source: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(source, lo, hi) of what isn't covered: ranges that were read, ends included, are stitched where they meet, and the
    rest of the wanted range of each source is given out, one row a gap. A source without any read range is one gap; a
    wanted range whose end lies before its start has none."""
    w = W.partitionBy(source)
    ends = wanted.select(source, F.col(lo).alias("_from"), F.col(hi).alias("_to")).filter("_from <= _to")
    cut = read.select(source, F.col(lo).alias("_a"), F.col(hi).alias("_b")).join(ends, source).filter("_a <= _b and _b >= _from and _a <= _to").select(source, "_from", "_to", "_a", "_b")
    # an empty range before the start and one behind the end make the outer gaps like the inner ones
    marks = ends.select(source, "_from", "_to", (F.col("_from") - 1).alias("_a"), (F.col("_from") - 1).alias("_b")).unionByName(ends.select(source, "_from", "_to", (F.col("_to") + 1).alias("_a"), (F.col("_to") + 1).alias("_b")))
    reach = F.max("_b").over(w.orderBy("_a", "_b").rowsBetween(W.unboundedPreceding, -1))
    return cut.unionByName(marks).withColumn("_reach", reach).filter(F.col("_a") > F.col("_reach") + 1).select(source, (F.col("_reach") + 1).alias(lo), (F.col("_a") - 1).alias(hi))


def proven(read: DataFrame, wanted: DataFrame, source: str, failures: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(source, gaps, missing, failed, scan_complete): complete only if nothing is missing and nothing failed, by a list of
    (source) with one row a failure."""
    g = gaps(read, wanted, source, lo, hi).groupBy(source).agg(F.count("*").alias("gaps"), F.sum(F.col(hi) - F.col(lo) + 1).alias("missing"))
    f = failures.groupBy(source).agg(F.count("*").alias("failed"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    every = wanted.select(source).distinct().join(g, source, "left").join(f, source, "left").select(source, zero("gaps"), zero("missing"), zero("failed"))
    return every.withColumn("scan_complete", (F.col("gaps") == 0) & (F.col("failed") == 0))
