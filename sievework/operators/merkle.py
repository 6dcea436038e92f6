"""A manifest of a table over its keys in order, which also tells where two tables differ.

Rows are leaves under the leading digits of their keys, ``WIDTH`` a level; a node's digest is the SHA-256 of its children's, each
behind its digits, in order. The tree depends on the rows alone, not on their partitions, and a change touches the nodes
above it only, so two tables are compared by going down where digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.scratch import cut

#: Characters of the key that a level takes.
WIDTH = 2


def _joined(name: Column, digest: Column) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(name.alias("n"), digest.alias("d"))))
    return F.sha2(F.array_join(F.transform(pairs, lambda p: F.concat(p["n"], F.lit("="), p["d"])), "\n"), 256)


def leaves(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, digest) of each row: null keys are empty, and a null value differs from an empty one."""
    field = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.sha2(F.concat_ws("", *(field(F.col(f"`{c}`")) for c in columns)), 256).alias("digest"))


def tree(df: DataFrame, key: str, columns: list[str], depth: int) -> DataFrame:
    """(level, prefix, n, digest) of all nodes from the root (level 0, no prefix) to ``depth``. Choose ``depth`` so that few
    keys share their first ``depth * WIDTH`` characters; a node there holds all of them, in order of key and digest."""
    rows = leaves(df, key, columns)
    level = rows.groupBy(F.substring("key", 1, depth * WIDTH).alias("prefix")).agg(F.count("*").alias("n"), _joined(F.col("key"), F.col("digest")).alias("digest"))
    out = level.select(F.lit(depth).alias("level"), "prefix", "n", "digest")
    for d in range(depth - 1, -1, -1):
        level = level.groupBy(F.substring("prefix", 1, d * WIDTH).alias("up")).agg(F.sum("n").alias("n"), _joined(F.col("prefix"), F.col("digest")).alias("digest")).withColumnRenamed("up", "prefix")
        out = out.unionByName(level.select(F.lit(d).alias("level"), "prefix", "n", "digest"))
    return out


def unequal(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """Prefixes of the lowest nodes in which two trees of one depth differ, found level by level: only children of unequal
    nodes are looked at. ``a_n`` and ``b_n`` are the rows below, 0 where a tree has no such node."""
    found = None
    for level in range(depth + 1):
        of = lambda t, name, level=level: t.filter(F.col("level") == level).select("prefix", F.col("n").alias(f"{name}_n"), F.col("digest").alias(f"_{name}"))
        x, y = of(a, "a"), of(b, "b")
        if found is not None:
            up = F.substring("prefix", 1, (level - 1) * WIDTH)
            above = found.select(F.col("prefix").alias("_up"))
            x, y = (t.join(above, up == F.col("_up"), "left_semi") for t in (x, y))
        found = x.join(y, "prefix", "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("prefix", F.coalesce("a_n", F.lit(0)).cast("long").alias("a_n"), F.coalesce("b_n", F.lit(0)).cast("long").alias("b_n"))
    return found


def differing(a: DataFrame, b: DataFrame, key: str, columns: list[str], depth: int) -> DataFrame:
    """(key, kind) of rows that are added, lost or changed from ``a`` to ``b``; rows under equal nodes are never compared."""
    nodes = unequal(cut(tree(a, key, columns, depth)), cut(tree(b, key, columns, depth)), depth).select("prefix")
    own = lambda df, name: leaves(df, key, columns).join(nodes, F.substring("key", 1, depth * WIDTH) == F.col("prefix"), "left_semi").groupBy("key").agg(F.sort_array(F.collect_list("digest")).alias(name))
    both = own(a, "_a").join(own(b, "_b"), "key", "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    return both.select("key", F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "lost").otherwise("changed").alias("kind"))
