"""The pending queue and the archive behind it: merges, orders, holds, budgets, hand-overs. Nothing is ever dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import dates as D
from sievework.functions import text as T


def merge(pending: DataFrame, listing: DataFrame, now: Column) -> DataFrame:
    """The queue after a scan: ``listing`` (id, title, published) over ``pending`` (id, title, published, first_seen,
    retries). What the listing shows fills in or replaces old values unless it is empty; each row was tried once more;
    ``historical`` rows leave the live queue for the backlog."""
    n = listing.dropDuplicates(["id"]).select("id", F.col("title").alias("_t"), F.col("published").alias("_p"))
    j = pending.join(n, "id", "full")
    first = F.coalesce("first_seen", now.cast("string"))
    published = D.first_date(F.col("_p"), F.col("published"))
    return j.select(
        "id", D.first_date(F.col("_t"), F.col("title")).alias("title"), published.alias("published"), first.alias("first_seen"),
        (F.coalesce("retries", F.lit(0)) + 1).cast("long").alias("retries"), D.historical(published, first).alias("historical"))


def ordered_work(work: DataFrame, now: Column, budget: int) -> DataFrame:
    """The first ``budget`` rows of the queue: those handed in by the owner, new ones, recent ones, those tried least,
    those checked and seen longest ago, then by id."""
    flag = lambda c: F.when(c, 0).otherwise(1)
    return work.orderBy(
        flag(F.col("handed_in")), flag(~F.col("was_pending")), flag(D.recent(F.col("published"), now)), F.coalesce("retries", F.lit(0)),
        F.coalesce("last_checked", F.lit("")), F.coalesce("first_seen", F.lit("")), "id").limit(budget)


def batch(backlog: DataFrame, archive: DataFrame, curated: DataFrame, order: list, size: int = 8) -> DataFrame:
    """The next ``size`` rows of a backlog that are neither curated nor learned yet."""
    learned = archive.filter("learned").select("id")
    return backlog.join(curated.select("id").union(learned).distinct(), "id", "left_anti").orderBy(*order).limit(size)


def carried(archive: DataFrame, probes: DataFrame, due: Column) -> DataFrame:
    """The archive after a run: a row that is due takes its probe's quality, one that isn't is carried on and marked,
    one without a probe stays. ``probes`` has id and new_quality; ``due`` is over the archive's columns."""
    j = archive.withColumn("_known", F.lit(True)).join(probes.withColumn("_probed", F.lit(True)), "id", "full")
    fresh = F.col("_probed").isNotNull() & (F.col("_known").isNull() | due)
    return j.select("id", F.when(fresh, F.col("new_quality")).otherwise(F.col("quality")).alias("quality"), (F.col("_probed").isNotNull() & ~fresh).alias("skipped"))


def within_reserve(calls: DataFrame, day: str, order: list, cap: int, reserve: int, priority: str) -> DataFrame:
    """``allowed``: fresh calls have all of a day's ``cap``, others what is left of it without the ``reserve``. A call
    counts those of its day that were allowed before, so fresh ones are counted first."""
    fresh = F.col(priority) == "new"
    n = F.row_number().over(W.partitionBy(day).orderBy(F.when(fresh, 0).otherwise(1), *order))
    return calls.withColumn("allowed", n <= F.when(fresh, cap).otherwise(cap - reserve))


def date_resolutions(undated: DataFrame, listing: DataFrame, known: DataFrame) -> DataFrame:
    """New rows of the side table of dates: listed now with a date, without one in the feed, and not resolved before."""
    dated = listing.filter(~T.is_empty(F.col("published"))).select("id", "published").dropDuplicates(["id"])
    return dated.join(undated.select("id"), "id", "left_semi").join(known.select("id"), "id", "left_anti")


def rescoped(pending: DataFrame, jump: DataFrame, settled: DataFrame) -> DataFrame:
    """Every row of the queue with its place: ids of a bulk jump go to the backlog unless they are settled elsewhere."""
    marks = jump.select("id", F.lit(True).alias("_j")).distinct().join(settled.select("id").distinct(), "id", "left_anti")
    return pending.join(marks, "id", "left").withColumn("place", F.when(F.col("_j"), "backlog").otherwise("pending")).drop("_j")


def unanswered(items: DataFrame, answers: DataFrame, version: str) -> DataFrame:
    """Items to ask again: without an answer of this version that was available."""
    done = answers.filter((F.col("version") == version) & ~F.col("note").eqNullSafe(F.lit("unavailable"))).select("id")
    return items.join(done, "id", "left_anti")


def watch(listing: DataFrame, seen: DataFrame, baseline: bool, most: int = 40) -> DataFrame:
    """New ids of a watched list, the newest ``most``; none on the first look, which only marks all as seen."""
    new = listing.join(seen.select("id"), "id", "left_anti").orderBy(F.desc("id")).limit(most)
    return new.limit(0) if baseline else new


def once_a_day(runs: DataFrame, day: str, order: list) -> DataFrame:
    """``sends``: the first run of a day."""
    return runs.withColumn("sends", F.row_number().over(W.partitionBy(day).orderBy(*order)) == 1)


def counters(calls: DataFrame, day: str, outcome: str) -> DataFrame:
    """Per day: calls billed (a refunded one isn't), refunds, and detail rows by class of outcome."""
    o = F.col(outcome)
    return calls.groupBy(day).agg(
        F.count_if(o != "refunded").alias("billed"), F.count_if(o == "refunded").alias("refunded"), F.count_if(o == "admitted").alias("admitted"),
        F.count_if(o.startswith("http_") | (o == "exception")).alias("errors"), F.count("*").alias("detail_rows"))


def reconciled(stated: DataFrame, calls: DataFrame, day: str, outcome: str) -> DataFrame:
    """Stated counters (billed, refunded, admitted, errors) against detail rows: missing rows, and whether all agree."""
    found = counters(calls, day, outcome).select(day, *(F.col(c).alias(f"_{c}") for c in ("admitted", "errors", "detail_rows")))
    j = stated.join(found, day, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    expected = F.col("billed") + F.col("refunded")
    whole = (z("_detail_rows") == expected) & (z("_admitted") == F.col("admitted")) & (z("_errors") == F.col("errors"))
    return j.select(day, z("_detail_rows").cast("long").alias("detail_rows"), F.greatest(F.lit(0), expected - z("_detail_rows")).cast("long").alias("missing"), F.when(whole, "COMPLETE").otherwise("INCOMPLETE").alias("status"))


def within_runs(calls: DataFrame, day: str, run: str, order: list, cap: int, run_cap: int) -> DataFrame:
    """``allowed``: the first ``run_cap`` calls of a run, as long as the day has had fewer than ``cap`` of them. ``order`` is the
    order of a day's calls and tells them apart; a run's calls follow one another."""
    first = F.row_number().over(W.partitionBy(day, run).orderBy(*order)) <= run_cap
    tried = calls.withColumn("_first", first)
    return tried.withColumn("allowed", F.col("_first") & (F.sum(F.col("_first").cast("int")).over(W.partitionBy(day).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) <= cap)).drop("_first")
