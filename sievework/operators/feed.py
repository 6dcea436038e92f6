"""The feed table: projection of posts to records, merges under integrity rules, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import text as T

#: Columns of a record that never change once they hold a value.
IMMUTABLE = ("source", "source_kind", "author", "published_at", "title", "url", "captured_at", "intake_class", "capture_mode")


def normalize(posts: DataFrame, source: str, source_kind: str, captured_at: str, author: str = "author", **constants: Column) -> DataFrame:
    """Posts (author, title, text, url, date) as feed records; ``constants`` overlay further columns."""
    url, body = T.without_fragment(F.coalesce("url", F.lit(""))), F.coalesce("text", F.lit(""))
    return posts.select(
        T.content_key(F.col(author), url, F.col("date"), F.col("title")).alias("id"), F.lit(source).alias("source"), F.lit(source_kind).alias("source_kind"),
        F.col(author).alias("author"), F.coalesce(F.col("date").cast("string"), F.lit("")).alias("published_at"), F.coalesce("title", F.lit("")).alias("title"),
        url.alias("url"), T.excerpt(body).alias("excerpt"), F.length(body).cast("long").alias("content_chars"), F.lit(captured_at).alias("captured_at"),
        *(c.alias(k) for k, c in constants.items()),
    )


def first_of(df: DataFrame, keys: list[str], order: list, keep: int = 1) -> DataFrame:
    """The first ``keep`` rows of each key in an order; give an order without ties."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= keep).drop("_n")


def upsert(base: DataFrame, incoming: DataFrame, key: str, enrich: list[str], order: str = "seq") -> DataFrame:
    """Append-only merge: new keys are added, the first row of a key in a batch wins, and of a key that is known only
    the ``enrich`` columns change, where the batch brings a value. ``outcome`` tells added, enriched and kept."""
    b = base.withColumn("_old", F.lit(True))
    firsts = first_of(incoming, [key], [order]).drop(order).withColumn("_new", F.lit(True))
    new = firsts.select(F.col(key).alias("_k"), "_new", *(F.col(c).alias(f"n_{c}") for c in firsts.columns if c not in (key, "_new")))
    joined = b.join(new, F.col(key) == F.col("_k"), "full")
    known = F.coalesce("_old", F.lit(False))

    def column(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(key), F.col("_k")).alias(key)
        old, now = F.col(c), F.col(f"n_{c}")
        if c in enrich:
            return F.when(known, F.coalesce(now, old)).otherwise(now).alias(c)
        return F.when(known, old).otherwise(now).alias(c)

    changed = F.lit(False)
    for c in enrich:
        changed = changed | (F.col(f"n_{c}").isNotNull() & ~F.col(f"n_{c}").eqNullSafe(F.col(c)))
    outcome = F.when(~known, "added").when(F.coalesce("_new", F.lit(False)) & changed, "enriched").otherwise("kept").alias("outcome")
    return joined.select(*(column(c) for c in base.columns), outcome)


def fill_missing(versions: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key and column the newest value that is not empty; ``order`` grows with time."""
    newest = [F.max_by(T.null_if_empty(F.col(c).cast("string")), F.when(~T.is_empty(F.col(c).cast("string")), F.col(order))).alias(c) for c in columns]
    return versions.groupBy(key).agg(*newest)


def best_of(current: DataFrame, prior: DataFrame, key: str, rank: str, columns: list[str]) -> DataFrame:
    """Outer merge in which a row keeps its prior columns where the prior rank is higher."""
    p = prior.select(F.col(key).alias("_k"), F.col(rank).alias("_rank"), *(F.col(c).alias(f"p_{c}") for c in columns))
    j = current.join(p, F.col(key) == F.col("_k"), "full")
    older = F.coalesce(F.col("_rank") > F.col(rank), F.col(rank).isNull())
    return j.select(F.coalesce(key, "_k").alias(key), F.greatest(rank, "_rank").alias(rank), *(F.when(older, F.col(f"p_{c}")).otherwise(F.col(c)).alias(c) for c in columns))


def merge_counters(base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: list[str], day: str, days: int = 45) -> DataFrame:
    """Three-way merge of counters: both growths since ``base`` count, never less than either side; ``paid`` sticks;
    the newest ``days`` days stay. The sides are stacked, so the merge is one shuffle."""
    sides = [d.select(*keys, "count", "paid", F.lit(n).alias("side")) for n, d in (("b", base), ("o", ours), ("t", theirs))]
    stacked = sides[0].unionByName(sides[1]).unionByName(sides[2])
    of = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("count"))), F.lit(0))
    merged = stacked.groupBy(*keys).agg(F.greatest(of("o") + of("t") - of("b"), of("o"), of("t")).cast("long").alias("count"), F.max("paid").alias("paid"))
    return newest(merged, day, days)


def newest(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows of the newest ``days`` distinct days. The distinct days are ranked, not the rows."""
    ranked = df.select(day).distinct().withColumn("_n", F.row_number().over(W.orderBy(F.desc(day)))).filter(F.col("_n") <= days).select(day)
    return df.join(ranked, day, "left_semi")


def violations(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, kind, field): keys that got lost, and non-empty values that changed."""
    lost = old.join(new, key, "left_anti").select(F.col(key).cast("string").alias("key"), F.lit("lost").alias("kind"), F.lit("").alias("field"))
    n = new.select(F.col(key).alias("_k"), *(F.col(c).alias(f"n_{c}") for c in columns))
    fields = F.array_compact(F.array(*(F.when(~T.is_empty(F.col(c).cast("string")) & ~F.col(c).eqNullSafe(F.col(f"n_{c}")), F.lit(c)) for c in columns)))
    changed = old.join(n, F.col(key) == F.col("_k")).select(F.col(key).cast("string").alias("key"), F.lit("changed").alias("kind"), F.explode(fields).alias("field"))
    return lost.unionByName(changed)


def undeclared(old: DataFrame, new: DataFrame, key: str, columns: list[str], revised: str) -> DataFrame:
    """``violations`` but for values that the new row declares: ``revised`` is an array column of ``new`` with the names of
    the fields that an audited revision changed. Declaring saves no key from being lost."""
    said = new.select(F.col(key).cast("string").alias("key"), F.lit("changed").alias("kind"), F.explode(revised).alias("field")).distinct()
    return violations(old, new, key, columns).join(said, ["key", "kind", "field"], "left_anti").select("key", "kind", "field")


def digest(*columns: Column) -> Column:
    """A digest of a table's rows that doesn't depend on their order: the sum of 60 bits of each row's SHA-256, hashed.
    It takes a number's room however many rows there are."""
    row = F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256)
    return F.sha2(F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")).cast("string"), 256)


def manifest(feed: DataFrame, key: str = "id") -> DataFrame:
    """Counts, bytes of all values, and digests of ids and of whole rows of a feed."""
    every = [F.col(c) for c in feed.columns]
    size = sum((F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in every), F.lit(0))
    return feed.agg(F.count("*").alias("records"), F.countDistinct(key).alias("distinct_ids"), F.sum(size).cast("long").alias("bytes"), digest(F.col(key)).alias("ids_digest"), digest(*every).alias("content_digest"))


def duplicate_flags(df: DataFrame, **keys: Column) -> DataFrame:
    """``df`` with a boolean per key: its value, if it has one, occurs in other rows too."""
    for name, c in keys.items():
        often = df.select(c.alias("_v")).filter("_v is not null").groupBy("_v").count().filter("count > 1").select("_v", F.lit(True).alias("_d"))
        df = df.withColumn("_own", c).join(often, F.col("_own") == F.col("_v"), "left").withColumn(name, F.coalesce("_d", F.lit(False))).drop("_own", "_v", "_d")
    return df
