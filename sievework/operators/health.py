"""Counts that tell how intake, providers, samples and shadows are doing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import stats as S


def given_up(calls: DataFrame, key: str, day: str, today: Column, mismatch: Column, timeout: Column, mismatches: int = 2, timeouts: int = 3) -> DataFrame:
    """Per key: mismatches and timeouts in all and today, and whether to leave it alone: for good, or for the day."""
    g = calls.groupBy(key).agg(F.count_if(mismatch).alias("mismatches"), F.count_if(timeout).alias("timeouts"), F.count_if(timeout & (F.col(day) == today)).alias("timeouts_today"))
    return g.withColumn("skip", (F.col("mismatches") >= mismatches) | (F.col("timeouts") >= timeouts) | (F.col("timeouts_today") >= 1))


def blocked(calls: DataFrame, author: str, item: str, refused: Column, least: int = 2) -> DataFrame:
    """Authors of whom ``least`` or more distinct items were refused."""
    return calls.filter(refused).groupBy(author).agg(F.countDistinct(item).alias("refused")).filter(F.col("refused") >= least)


def providers(rows: DataFrame, quality: str, rule_allowed: Column, by: list[str]) -> DataFrame:
    q = F.coalesce(F.col(quality), F.lit("Q5"))
    return rows.groupBy(*by).agg(F.count("*").alias("probes"), F.count_if(q != "Q5").alias("available"), F.count_if(rule_allowed).alias("rule_capable"))


def intake(pending: DataFrame, quality: str, retries: str, channel_errors: DataFrame) -> DataFrame:
    """One row: rows of good text that are stuck, rows that wait for a better provider, channel errors, and status."""
    q = F.upper(F.coalesce(F.col(quality), F.lit("")))
    stuck = q.isin("Q1", "Q2") & (F.coalesce(F.col(retries), F.lit(0)) >= 2)
    g = pending.agg(F.count_if(stuck).alias("stuck"), F.count_if(q.isin("Q3", "Q4", "Q5", "")).alias("waiting"))
    e = channel_errors.agg(F.count("*").alias("channel_errors"))
    return g.join(e, F.lit(True)).withColumn("status", F.when((F.col("stuck") > 0) | (F.col("channel_errors") > 0), "attention").otherwise("ok"))


def sample_summary(rows: DataFrame, by: list[str], author: str, chars: str) -> DataFrame:
    """Per group: rows, authors, the largest author's share, and the upper median of ``chars``, all from counts by value,
    so no group's rows are gathered."""
    share = rows.groupBy(*by, author).agg(F.count("*").alias("_n")).groupBy(*by).agg(F.sum("_n").alias("items"), F.count("*").alias("authors"), F.max("_n").alias("_most"))
    return share.join(upper_median(rows, by, chars), by).select(*by, "items", "authors", S.ratio(F.col("_most"), F.col("items")).alias("max_author_share"), F.col("median").alias("chars_median"))


def upper_median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per group, the value at place n // 2 of its n sorted values (``median``), by a running sum over distinct values."""
    n = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = W.partitionBy(*by)
    at = n.withColumns({"_upto": F.sum("_n").over(w.orderBy(value).rowsBetween(W.unboundedPreceding, 0)), "_all": F.sum("_n").over(w)})
    return at.filter((F.col("_upto") > F.floor(F.col("_all") / 2)) & (F.col("_upto") - F.col("_n") <= F.floor(F.col("_all") / 2))).select(*by, F.col(value).alias("median"))


def yields(full: DataFrame, excerpt: DataFrame, key: str, checkable: Column) -> DataFrame:
    """Claims of whole texts beside those of excerpts, per key."""
    side = lambda d, n: d.groupBy(key).agg(F.count("*").alias(f"claims_{n}"), F.count_if(checkable).alias(f"checkable_{n}"))
    j = side(full, "full").join(side(excerpt, "excerpt"), key, "full")
    return j.select(key, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("claims_full", "checkable_full", "claims_excerpt", "checkable_excerpt")))


def ledger(requests: DataFrame, day: str, key: str) -> DataFrame:
    return requests.groupBy(day, key).agg(F.count("*").alias("count"))


def shadow(ours: DataFrame, theirs: DataFrame, record: str, symbol: str, polarity: str, by: list[str]) -> DataFrame:
    """Pair sets of two labellers over the records both have seen: sizes, overlap, agreement of direction."""
    side = lambda d, n: d.groupBy(*by, record, symbol).agg(F.collect_set(polarity).alias(n))
    j = side(ours, "_a").join(side(theirs, "_b"), [*by, record, symbol], "full")
    a, b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return j.groupBy(*by).agg(
        F.count_if(a).alias("our_pairs"), F.count_if(b).alias("their_pairs"), F.count_if(a & b).alias("both_pairs"),
        F.count_if(F.coalesce(F.arrays_overlap("_a", "_b"), F.lit(False))).alias("direction_agree"), F.count_if(a & ~b).alias("our_only"), F.count_if(b & ~a).alias("their_only"))


def merged_lists(rows: DataFrame, key: str, order: str, items: str, text: str, most: int = 40) -> DataFrame:
    """Per key: the first text and all items in order, ``most`` at most. What is gathered is cut to the first ``most``
    rows of a key, which hold all items that can be kept."""
    w = W.partitionBy(key).orderBy(order)
    before = F.coalesce(F.sum(F.size(items)).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    some = rows.withColumns({"_b": before, "_r": F.row_number().over(w)}).filter((F.col("_r") == 1) | ((F.col("_b") < most) & (F.size(items) > 0)))
    listed = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_r", F.col(items).alias("x")))), lambda s: s["x"]))
    return some.groupBy(key).agg(F.min_by(text, "_r").alias(text), F.slice(listed, 1, most).alias(items))
