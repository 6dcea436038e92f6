"""Set checks over ids and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators import feed


def ids(df: DataFrame, key: str) -> DataFrame:
    """Distinct ids that aren't empty."""
    c = F.col(key).cast("string")
    return df.filter(c.isNotNull() & (c != "")).select(key).distinct()


def outside(seen: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Ids of ``seen`` in none of the other tables."""
    out = ids(seen, key)
    for o in others:
        out = out.join(ids(o, key), key, "left_anti")
    return out


def gaps(seen: DataFrame, key: str, by: str, *others: DataFrame, examples: int = 5) -> DataFrame:
    """Per group: how many ids of ``seen`` are outside the others, and the first few of them."""
    lost = outside(seen, key, *others).join(seen.select(key, by).distinct(), key)
    first = feed.first_of(lost, [by], [key], examples).groupBy(by).agg(F.array_join(F.sort_array(F.collect_list(key)).cast("array<string>"), ",").alias("examples"))
    return lost.groupBy(by).agg(F.count("*").alias("missing")).join(first, by)


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: sizes of two id sets, of what they share, and of what only one has."""
    x, y = ids(a, key).withColumn("_a", F.lit(True)), ids(b, key).withColumn("_b", F.lit(True))
    l, r = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return x.join(y, key, "full").agg(F.count_if(l).alias("left"), F.count_if(r).alias("right"), F.count_if(l & r).alias("both"), F.count_if(l & ~r).alias("left_only"), F.count_if(r & ~l).alias("right_only"))


def disjoint(test: DataFrame, dev: DataFrame, key: str) -> DataFrame:
    """``dev`` without the rows whose key stands in ``test``."""
    return dev.join(test.filter(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")


def verification(feed_table: DataFrame, baseline: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(check, n): rows without an id, ids that repeat, rows fewer than before, lost ids and rewritten fields."""
    c = F.col(key).cast("string")
    one = lambda name, n: (F.lit(name).alias("check"), n.cast("long").alias("n"))
    missing = feed_table.agg(F.count_if(c.isNull() | (c == "")).alias("n")).select(*one("missing_id", F.col("n")))
    repeated = feed_table.filter(c != "").groupBy(key).count().agg(F.count_if(F.col("count") > 1).alias("n")).select(*one("repeated_id", F.col("n")))
    sizes = feed_table.agg(F.count("*").alias("a")).join(baseline.agg(F.count("*").alias("b")), F.lit(True))
    shrunk = sizes.select(*one("shrunk_by", F.greatest(F.lit(0), F.col("b") - F.col("a"))))
    found = feed.violations(baseline, feed_table, key, columns).agg(F.count_if(F.col("kind") == "lost").alias("lost"), F.count_if(F.col("kind") == "changed").alias("changed"))
    return missing.unionByName(repeated).unionByName(shrunk).unionByName(found.select(*one("lost", F.col("lost")))).unionByName(found.select(*one("rewritten", F.col("changed"))))


def unsent(local: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """What a side file holds: local rows whose key the base lacks. A null key is nobody's and goes along."""
    return local.join(ids(base, key), key, "left_anti")


def reapplied(base: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """A fresh base with the rows of a side file that it lacks, so that applying twice changes nothing; of equal keys within the
    side file one row, the first by all its columns, is taken."""
    columns = [c for c in side.columns if c != key]
    one = side.groupBy(key).agg(F.min(F.struct(*columns)).alias("_r")).select(key, *(F.col("_r")[c].alias(c) for c in columns))
    return base.unionByName(unsent(one, base, key), allowMissingColumns=True)


def append_lines(df: DataFrame, path: str) -> None:
    """Add rows to a folder of JSON lines; what is there stays as it is."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def seen_union(current: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Two lists of what was seen as one: each key once, with the data that the current list has for it, else the other's
    (the least of its rows)."""
    columns = [c for c in current.columns if c != key]
    both = current.select(key, F.lit(0).alias("_o"), F.struct(*columns).alias("_r")).unionByName(other.select(key, F.lit(1).alias("_o"), F.struct(*columns).alias("_r")))
    return both.groupBy(key).agg(F.min(F.struct("_o", "_r")).alias("_x")).select(key, *(F.col(f"_x._r.{c}").alias(c) for c in columns))
