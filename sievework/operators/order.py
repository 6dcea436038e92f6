"""A total order over a table that no single task sorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.scratch import cut


def numbered(df: DataFrame, keys: list[Column], name: str = "seq") -> DataFrame:
    """``df`` with the number of each row, from 0, in the order of ``keys``: rows go to range partitions by sampled bounds,
    are sorted there, and add their place in the partition to the number of rows in the partitions before. The
    partitions are pinned by a checkpoint, because bounds that are sampled again may differ. Rows alike in all keys
    are numbered in any order and share a partition, so let the last key tell rows apart.

    Nulls come first with ``asc``; an empty table stays empty; a column called ``name`` is replaced."""
    out = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    there = {c.lower() for c in df.columns}
    at = next(x for x in ("_at", "_at_", "_at__", "_at___") if x not in there)
    pinned = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, 33)
    sizes = pinned.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row a partition: the window and the broadcast are as small as the number of partitions
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return pinned.join(F.broadcast(before), part == F.col("_part")).select(*out, (F.col("_before") + F.col(at).bitwiseAND((1 << 33) - 1)).alias(name))


def written_in_order(df: DataFrame, keys: list[Column], path: str, kind: str = "parquet") -> None:
    """``df`` as files whose names follow the order of ``keys``, each sorted: read file by file they give the total order."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").format(kind).save(path)


def running(df: DataFrame, keys: list[Column], value: Column, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` (null counts as 0) over all rows that come before in the order of ``keys``."""
    out = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    pinned = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"_at": F.monotonically_increasing_id(), "_value": F.coalesce(value, F.lit(0))}))
    part = F.shiftright("_at", 33).alias("_part")
    sums = pinned.groupBy(part).agg(F.sum("_value").alias("_sum"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("_part", before("_sum", W.orderBy("_part")).alias("_offset"))  # one row a partition
    rows = pinned.withColumn("_part", part).withColumn("_own", before("_value", W.partitionBy("_part").orderBy("_at")))
    return rows.join(F.broadcast(offsets), "_part").select(*out, (F.col("_offset") + F.col("_own")).alias(name))
