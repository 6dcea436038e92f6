"""Incremental state: seen-sets, continuity, budgets, back-off, lateness, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import text as T


def unseen(entries: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return entries.dropDuplicates(keys).join(seen, keys, "left_anti")


def continuity(listing: DataFrame, anchors: DataFrame, board: str, entry: str, page: str, deepest: int) -> DataFrame:
    """Per board: the first page on which an anchor of an earlier scan is visible, the budget that doubling from 1
    reaches it with, and whether that is within ``deepest`` pages. A board without anchors starts anew."""
    hit = listing.join(anchors.select(board, entry).distinct(), [board, entry]).groupBy(board).agg(F.min(page).alias("anchor_page"))
    out = listing.groupBy(board).agg(F.max(page).alias("pages")).join(hit, board, "left").join(anchors.groupBy(board).agg(F.count("*").alias("anchors")), board, "left")
    budget = F.pow(F.lit(2), F.ceil(F.log2(F.col("anchor_page").cast("double")))).cast("long")
    return out.select(board, "pages", "anchor_page", budget.alias("scan_pages"), F.coalesce(F.col("anchor_page") <= deepest, F.col("anchors").isNull()).alias("complete"))


def demoted(batch: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """All rows of a batch whose scan is incomplete become backfill."""
    done = status.select(key, F.col("complete").alias("_c"))
    return batch.join(done, key, "left").withColumn("intake_class", F.when(F.coalesce("_c", F.lit(False)), F.lit("live_candidate")).otherwise("backfill")).drop("_c")


def late(df: DataFrame, published: str, captured: str, days: int = 3) -> DataFrame:
    """Rows captured more than ``days`` whole days after publication are backfill; none is dropped."""
    return df.withColumn("intake_class", F.when(T.days_between(F.col(published), F.col(captured)) > days, F.lit("backfill")).otherwise("live_candidate"))


def within_budget(calls: DataFrame, day: str, order: list, cap: int) -> DataFrame:
    """``allowed`` marks the first ``cap`` calls of a day in an order without ties."""
    return calls.withColumn("allowed", F.row_number().over(W.partitionBy(day).orderBy(*order)) <= cap)


def backoff_due(last: DataFrame, tried: str, grade: str, days: dict[str, int], default: int, now: Column) -> DataFrame:
    """Whether the wait of a row's grade is over at ``now``."""
    wait = F.lit(None)
    for g, n in days.items():
        wait = F.when(F.col(grade) == g, n).otherwise(wait)
    return last.withColumn("due", F.col(tried).isNull() | (T.days_between(F.col(tried), now) >= F.coalesce(wait, F.lit(default))))


def changes(df: DataFrame, key: str, order: list[str], fingerprint: str) -> DataFrame:
    """Rows whose fingerprint differs from the row before; the first of a key is one."""
    before = F.lag(fingerprint).over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_before", before).filter(~F.col(fingerprint).eqNullSafe(F.col("_before"))).drop("_before")


def persistent(df: DataFrame, key: str, day: str, condition: Column, last: int = 14, least: int = 3) -> DataFrame:
    """Keys for which a condition held on ``least`` or more of the newest ``last`` days on record."""
    days = df.select(day).distinct().withColumn("_n", F.row_number().over(W.orderBy(F.desc(day)))).filter(F.col("_n") <= last).select(day)
    return df.filter(condition).join(days, day, "left_semi").groupBy(key).agg(F.countDistinct(day).alias("days")).filter(F.col("days") >= least)


def worklist(df: DataFrame, priority: list, budget: int) -> DataFrame:
    """The first ``budget`` rows by priority."""
    return df.orderBy(*priority).limit(budget)


def recovery_days(since_success: Column, least: int = 14, margin: int = 2) -> Column:
    return F.greatest(F.lit(least), since_success + margin)
