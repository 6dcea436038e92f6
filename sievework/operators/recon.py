"""Reconciliation: coverage, inventories, snapshots, stages and accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def coverage(df: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    """Rows and conditional counts by ``keys``; a measure without rows is 0."""
    return df.groupBy(*keys).agg(F.count("*").alias("records"), *(F.count_if(c).alias(k) for k, c in measures.items()))


def author_span(df: DataFrame, author: str, month: str, kind: str) -> DataFrame:
    """Per author: records, kinds in order, first and last known month."""
    known = F.when(F.col(month) != "unknown", F.col(month))
    return df.groupBy(author).agg(F.count("*").alias("records"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.min(known).alias("first_month"), F.max(known).alias("last_month"))


def inventory(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, records) over each dimension by itself: one pass of grouping sets."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in dimensions)))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("records"))


def first_seen(snapshots: DataFrame, key: str, order: list[str], *columns: str) -> DataFrame:
    """Per key the columns of its first snapshot."""
    at = F.min(F.struct(*order, *(c for c in columns if c not in order)))
    return snapshots.groupBy(key).agg(at.alias("_first")).select(key, *(F.col(f"_first.{c}") for c in columns))


def growth(snapshots: DataFrame, step: str, key: str) -> DataFrame:
    """(step, new_keys): keys of a snapshot that the one before it lacks; the first snapshot has none to grow from.
    A key's own steps are ranked against the list of all steps, so snapshots are never joined with each other."""
    steps = snapshots.select(step).distinct().withColumn("_n", F.row_number().over(W.orderBy(step)))
    held = snapshots.select(step, key).distinct().join(steps, step)
    before = F.lag("_n").over(W.partitionBy(key).orderBy("_n"))
    new = held.withColumn("_before", before).filter("_n > 1 and (_before is null or _before < _n - 1)")
    return steps.filter("_n > 1").join(new.groupBy(step).agg(F.count("*").alias("new_keys")), step, "left").select(step, F.coalesce("new_keys", F.lit(0)).cast("long").alias("new_keys"))


def stages(ids: DataFrame, key: str, members: dict[str, DataFrame], default: str) -> DataFrame:
    """Each id with the first table of ``members``, in order, that has it, and how many have it."""
    out = ids.select(key).distinct()
    for name, table in members.items():
        out = out.join(table.select(F.col(key).alias(f"_{name}")).distinct(), F.col(key) == F.col(f"_{name}"), "left")
    stage = F.coalesce(*(F.when(F.col(f"_{n}").isNotNull(), F.lit(n)) for n in members), F.lit(default))
    held = sum((F.col(f"_{n}").isNotNull().cast("int") for n in members), F.lit(0))
    return out.select(key, stage.alias("stage"), held.cast("long").alias("tables"))


def account(seen: DataFrame, key: str, *places: DataFrame) -> DataFrame:
    """(key, accounted): whether a seen key is in any place."""
    known = places[0].select(key)
    for p in places[1:]:
        known = known.union(p.select(key))
    return seen.select(key).distinct().join(known.distinct().withColumn("_k", F.lit(True)), key, "left").select(key, F.coalesce("_k", F.lit(False)).alias("accounted"))


def complete(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """``any`` and ``all`` of a condition by keys, and whether there are rows and all hold."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias("any_ok"), F.coalesce(F.bool_and(condition), F.lit(False)).alias("all_ok"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with multiplicity, that only one side has: empty if the tables are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def verdicts(probes: DataFrame, family: str, ok: Column, refused: Column) -> DataFrame:
    """Per family of probes: counts and a verdict."""
    g = probes.groupBy(family).agg(F.count("*").alias("probes"), F.count_if(ok).alias("ok"), F.count_if(refused).alias("refused"))
    return g.withColumn("verdict", F.when(F.col("ok") == F.col("probes"), "open").when(F.col("refused") == F.col("probes"), "refused").when(F.col("ok") > 0, "partial").otherwise("unclear"))
