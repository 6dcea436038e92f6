"""Deterministic sampling: order by the hash of seed and key, never by a random generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def seeded(seed: str, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), key.cast("string")), 256)


def per_stratum(df: DataFrame, strata: list[str], seed: str, key: str, share: float) -> DataFrame:
    """A share of each stratum, one row at least."""
    w = W.partitionBy(*strata)
    n = F.greatest(F.lit(1), F.round(F.count("*").over(w) * share).cast("long"))
    return df.withColumns({"_n": n, "_r": F.row_number().over(w.orderBy(seeded(seed, F.col(key)), key))}).filter("_r <= _n").drop("_n", "_r")


def largest_remainder(df: DataFrame, strata: list[str], total: int) -> DataFrame:
    """(strata, size, quota): ``total`` seats dealt out in proportion; left-over seats by remainder, then key."""
    sizes = df.groupBy(*strata).agg(F.count("*").alias("size"))
    everyone = W.partitionBy(F.lit(1))
    exact = sizes.withColumn("_all", F.sum("size").over(everyone)).withColumns({"_floor": F.floor(F.col("size") * total / F.col("_all")), "_rest": F.col("size") * total % F.col("_all")})
    ranked = exact.withColumns({"_left": total - F.sum("_floor").over(everyone), "_rank": F.row_number().over(everyone.orderBy(F.desc("_rest"), *strata))})
    return ranked.select(*strata, "size", (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("long").alias("quota"))


def round_robin(df: DataFrame, group: str, order: list, take: int) -> DataFrame:
    """The first of each group, then the second of each, and so on; ``turn`` and ``group`` give the order."""
    turn = df.withColumn("turn", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    return turn.orderBy("turn", group).limit(take)


def _taken(pool: DataFrame, author: str, key: str, used: DataFrame, cap: int, n: int) -> DataFrame:
    """The first ``n`` rows of a pool in seeded order, no author more than ``cap`` with what is ``used`` (author, n)."""
    left = pool.join(used.select(F.col(author), F.col("n").alias("_u")), author, "left").withColumn("_left", cap - F.coalesce("_u", F.lit(0)))
    ranked = left.withColumn("_r", F.row_number().over(W.partitionBy(author).orderBy("_h", key))).filter(F.col("_r") <= F.col("_left"))
    return ranked.orderBy("_h", key).limit(n).drop("_u", "_left", "_r")


def passes(df: DataFrame, author: str, key: str, steps: list[tuple[str, Column, int]], cap: int, seed: str) -> DataFrame:
    """(step, author, key): in each step (name, condition, number), rows that fulfil the condition and aren't taken yet
    are taken in seeded order, no author more than ``cap`` over all steps. A row is taken by a greedy walk exactly if it
    is among its author's first free places and then among the first of those left, so each step is one ranking. What
    is taken, at most the sum of the numbers, is kept by the driver from step to step."""
    spark, rows = df.sparkSession, []
    pool = df.withColumn("_h", seeded(seed, F.col(key)))
    schema = f"step string, {author} string, {key} {df.schema[key].dataType.simpleString()}"
    for name, condition, n in steps:
        taken = spark.createDataFrame(rows, schema)
        used = taken.groupBy(author).agg(F.count("*").alias("n"))
        some = pool.filter(condition).join(taken.select(key), key, "left_anti").withColumn(author, F.col(author).cast("string"))
        rows += [(name, r[author], r[key]) for r in _taken(some, author, key, used, cap, n).select(author, key).collect()]
    return spark.createDataFrame(rows, schema)


def capped_greedy(df: DataFrame, stratum: str, author: str, key: str, quotas: DataFrame, cap: int, seed: str) -> DataFrame:
    """(stratum, author, key): strata in order take rows in seeded order up to their quota, no author more than ``cap``
    over all strata. ``quotas`` is small: a row for each stratum."""
    steps = [(r[0], F.col(stratum).eqNullSafe(F.lit(r[0])), r[1]) for r in quotas.select(stratum, "quota").orderBy(stratum).collect()]
    return passes(df, author, key, steps, cap, seed).toDF("stratum", "author", "key")


def allocated(df: DataFrame, author: str, total: int, least: int) -> DataFrame:
    """(author, size, quota): seats in proportion to size, ``least`` for each author and never more than there are."""
    sizes = df.groupBy(author).agg(F.count("*").alias("size"))
    everyone = sizes.agg(F.sum("size").alias("_all"))
    quota = F.least("size", F.greatest(F.lit(least), F.bround(total * F.col("size") / F.col("_all"), 0).cast("long")))
    return sizes.join(everyone, F.lit(True)).select(author, "size", quota.alias("quota"))


def by_year(df: DataFrame, author: str, year: str, key: str, total: int, least: int, seed: str) -> DataFrame:
    """Rows chosen by author quota, each author's spread over years in proportion, one of each year at least, and then
    cut to the quota in a second seeded order."""
    sized = df.join(allocated(df, author, total, least), author).withColumn("_y", F.count("*").over(W.partitionBy(author, year)))
    share = F.greatest(F.lit(1), F.bround(F.col("quota") * F.col("_y") / F.col("size"), 0).cast("long"))
    first = sized.withColumn("_r", F.row_number().over(W.partitionBy(author, year).orderBy(seeded(seed, F.col(key)), key))).filter(F.col("_r") <= share)
    last = first.withColumn("_r", F.row_number().over(W.partitionBy(author).orderBy(seeded(seed + "2", F.col(key)), key)))
    return last.filter(F.col("_r") <= F.col("quota")).drop("_r", "_y", "size", "quota")


def split_by_flag(df: DataFrame, flag: Column, key: str, n: int, most: float, seed: str) -> DataFrame:
    """``df`` with ``split``: ``n`` test rows in seeded order, at most ``most`` of them with the flag; the rest is dev."""
    order = [seeded(seed, F.col(key)), F.col(key)]
    flagged = min(df.filter(flag).count(), round(n * most))
    test = df.filter(flag).orderBy(*order).limit(flagged).select(key).union(df.filter(~flag).orderBy(*order).limit(n - flagged).select(key))
    return df.join(test.withColumn("_t", F.lit(True)), key, "left").withColumn("split", F.when(F.col("_t"), "test").otherwise("dev")).drop("_t")


def marked_subset(df: DataFrame, key: str, n: int, seed: str, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: whether a row is among the first ``n`` in an order of its own seed."""
    some = df.orderBy(seeded(seed, F.col(key)), key).limit(n).select(key, F.lit(True).alias("_m"))
    return df.join(some, key, "left").withColumn(name, F.coalesce("_m", F.lit(False))).drop("_m")


def blind(df: DataFrame, key: str, labels: list[str], seed: str) -> DataFrame:
    """What a rater sees: rows under a name that tells nothing, without the labels and the key."""
    return df.select(F.substring(seeded(seed, F.col(key)), 1, 10).alias("blind_id"), *(c for c in df.columns if c not in (*labels, key)))


def drawn(df: DataFrame, author: str, key: str, seed: str, quotas: dict[str, int] | int) -> DataFrame:
    """A sample of each author: the first of the distinct keys in seeded order, as many as the author's quota (none if it has
    none), in place of draws by a random generator."""
    quota = F.lit(quotas) if isinstance(quotas, int) else F.coalesce(*(F.when(F.col(author) == a, n) for a, n in quotas.items()), F.lit(0))
    one = df.dropDuplicates([author, key]).withColumns({"_quota": quota, "_n": F.row_number().over(W.partitionBy(author).orderBy(seeded(seed, F.col(key)), key))})
    return one.filter("_n <= _quota").drop("_n", "_quota")


def pooled(df: DataFrame, **reasons: Column) -> DataFrame:
    """``df`` with ``reason``: the first of the conditions, in the order given, that keeps a row out of the pool, else null."""
    return df.withColumn("reason", F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), name) for name, c in reasons.items()), F.lit(None)))
