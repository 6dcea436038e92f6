"""Filling a set with whole posts, author after author, and building test and dev sets from it.

A walk takes one post of each author in turn, in a seeded order of authors, until the target number of items is
reached; a post that would take its author over the cap stays at the head of the author's queue and blocks what is
behind it. The walk needn't be walked: an author gives the posts up to the first that breaks the cap, the k-th of them
in round k, and the walk ends with the first post before which the target is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.operators import order
from sievework.operators.feed import first_of
from sievework.operators.sample import seeded


def fill(posts: DataFrame, author: str, items: str, queue: list[Column], seed: str, target: int, cap: int) -> DataFrame:
    """The posts that the walk takes, with ``round`` and ``before``, the items taken before each. ``queue`` is the order
    of an author's posts and tells them apart. A post has one item at least, so no author gives more posts than ``cap``;
    posts without items are left out. With no target nothing is taken."""
    if target <= 0:
        return posts.limit(0).withColumns({"round": F.lit(0), "before": F.lit(0).cast("long")})
    own = W.partitionBy(author).orderBy(*queue)
    heads = first_of(posts.filter(F.col(items) > 0), [author], queue, keep=max(cap, 1))  # more can't fit under the cap
    within = heads.withColumns({"_sum": F.sum(items).over(own), "round": F.row_number().over(own)}).filter(F.col("_sum") <= cap).drop("_sum")
    rounds = within.groupBy("round").agg(F.sum(items).alias("_n"))  # at most ``cap`` rows
    starts = rounds.select("round", F.coalesce(F.sum("_n").over(W.orderBy("round").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    begun = within.join(F.broadcast(starts.filter(F.col("_start") < target)), "round")
    turn = [F.col("round").asc(), seeded(seed, F.col(author)).asc(), F.col(author).asc()]
    return order.running(begun.drop("_start"), turn, F.col(items), "before").filter(F.col("before") < target)


def splits(posts: DataFrame, key: str, author: str, items: str, fixed: Column, queue: list[Column], seed: str, test: int, dev: int, share: float) -> DataFrame:
    """Posts with ``split``: those that are ``fixed`` and a fill up to ``test`` items are the test set; a fill of ``dev``
    items from the rest is the dev set, topped up without the cap, authors in seeded order, if the cap stalls it. Other
    posts are left out. The cap of a fill is a share of its target."""
    held = posts.withColumn("_fixed", F.coalesce(fixed, F.lit(False)))
    certain, free = held.filter("_fixed").drop("_fixed"), held.filter(~F.col("_fixed") & (F.col(items) > 0)).drop("_fixed")
    wanted = test - (certain.agg(F.sum(items)).first()[0] or 0)
    first = order.cut(fill(free, author, items, queue, seed, wanted, int(share * wanted)).select(key))
    left = free.join(first, key, "left_anti")
    second = order.cut(fill(left, author, items, queue, seed, dev, int(share * dev)).select(key, items))
    missing = dev - (second.agg(F.sum(items)).first()[0] or 0)
    chosen = second.select(key)
    if missing > 0:
        rest = left.join(chosen, key, "left_anti")
        more = order.running(rest, [seeded(seed, F.col(author)).asc(), F.col(author).asc(), *queue], F.col(items))
        chosen = chosen.unionByName(more.filter(F.col("before") < missing).select(key))
    marks = first.withColumn("split", F.lit("test")).unionByName(chosen.withColumn("split", F.lit("dev")))
    return certain.withColumn("split", F.lit("test")).unionByName(free.join(marks, key))
