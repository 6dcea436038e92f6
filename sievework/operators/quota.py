"""Call budgets with refunds: what becomes of each call attempt of a key, in order.

A call to the first model or a fallback is charged unless nothing was processed: an overload (503) and a spent fallback
(429 of a model other than the first) are refunded, and that fallback is skipped from then on. A spent first model ends
the key's budget, as the cap does. ``attempts`` has a key, an order that tells attempts of a key apart, a model and a
status; an unknown status is charged as an error, a null one too, and a null model counts as the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Statuses of an answer, an overload and a spent quota.
DONE, BUSY, SPENT = 200, 503, 429

COUNTS = ("calls", "admitted", "errors", "refunded")


def outcome_of(first: Column, status: Column) -> Column:
    """What a call that takes place comes to."""
    return (
        F.when(status == DONE, "admitted").when(status == BUSY, "refunded").when((status == SPENT) & ~first, "fallback_spent")
        .when(status == SPENT, "exhausted").otherwise("error")
    )


def outcomes(attempts: DataFrame, key: str, order: list[str], model: str, status: str, first: str, cap: int) -> DataFrame:
    """``attempts`` with ``outcome``: admitted, refunded, fallback_spent, exhausted, error, skipped (a spent fallback) or
    refused (the budget is used up). Charges don't depend on what was refused before, because refusal lasts to the end,
    so running sums tell the same as a walk through the states."""
    before = lambda *by: W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    known = attempts.withColumns({"_first": F.coalesce(F.col(model) == first, F.lit(True))}).withColumn("_would", outcome_of(F.col("_first"), F.col(status)))
    skipped = known.withColumn("_skip", ~F.col("_first") & F.coalesce(F.max(F.col("_would") == "fallback_spent").over(before(key, model)), F.lit(False)))
    charged = ~F.col("_skip") & ~F.col("_would").isin("refunded", "fallback_spent")
    over = (F.coalesce(F.sum(charged.cast("long")).over(before(key)), F.lit(0)) >= cap) | F.coalesce(F.max(F.col("_would") == "exhausted").over(before(key)), F.lit(False))
    return skipped.withColumn("outcome", F.when(over, "refused").when(F.col("_skip"), "skipped").otherwise(F.col("_would"))).drop("_first", "_would", "_skip")


def budgets(outcome: DataFrame, key: str, model: str) -> DataFrame:
    """The state of each key after all its attempts: calls charged, admitted, errors, refunds, whether its first model is
    spent, and its spent fallbacks, sorted."""
    o = F.col("outcome")
    spent = F.array_sort(F.collect_set(F.when(o == "fallback_spent", F.col(model))))  # as many as there are models
    return outcome.groupBy(key).agg(
        F.count_if(o.isin("admitted", "error", "exhausted")).alias("calls"), F.count_if(o == "admitted").alias("admitted"), F.count_if(o.isin("error", "refunded", "fallback_spent")).alias("errors"),
        F.count_if(o.isin("refunded", "fallback_spent")).alias("refunded"), F.coalesce(F.max(o == "exhausted"), F.lit(False)).alias("exhausted"), spent.alias("spent"))
