"""Intake of utterances and articles: admission, outcomes, duplicates under alternative keys, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import labels as L
from sievework.functions import text as T
from sievework.operators.feed import first_of
from sievework.sources.parse import clean_text


def utterance_key(author: Column, at: Column, title: Column) -> Column:
    """Author, minute and the beginning of the title: the key of a copy without a post id."""
    return F.concat_ws("|", F.lower(F.coalesce(author, F.lit(""))), F.substring(F.coalesce(at, F.lit("")), 1, 16), F.substring(F.coalesce(title, F.lit("")), 1, 40))


def new_utterances(batch: DataFrame, index: DataFrame, order: str = "seq") -> DataFrame:
    """``batch`` (post_id, author, time, title, body, an order column) with ``outcome``: duplicate if the index or an
    earlier row of the batch has its post id or its utterance key, else title_only, body_missing or new."""
    keyed = batch.withColumn("utterance_key", utterance_key(F.col("author"), F.col("time"), F.col("title")))
    ids, keys = index.select("post_id").distinct(), index.select(utterance_key(F.col("author"), F.col("time"), F.col("title")).alias("utterance_key")).distinct()
    keyed = keyed.join(ids.withColumn("_by_id", F.lit(True)), "post_id", "left").join(keys.withColumn("_by_key", F.lit(True)), "utterance_key", "left")
    first_id = batch.groupBy("post_id").agg(F.min(order).alias("_first_id"))
    first_key = keyed.groupBy("utterance_key").agg(F.min(order).alias("_first_key"))
    keyed = keyed.join(first_id, "post_id", "left").join(first_key, "utterance_key", "left")
    again = F.coalesce("_by_id", F.lit(False)) | F.coalesce("_by_key", F.lit(False)) | (F.col("_first_id") < F.col(order)) | (F.col("_first_key") < F.col(order))
    empty = F.trim(F.coalesce("body", F.lit(""))) == ""
    outcome = F.when(again, "duplicate").when(empty & (F.col("title") != ""), "title_only").when(empty, "body_missing").otherwise("new")
    return keyed.select(*batch.columns, "utterance_key", outcome.alias("outcome"))


def article_outcomes(batch: DataFrame, stored: DataFrame, least_chars: int = 1, order: str = "seq") -> DataFrame:
    """``batch`` (url, text) with its sha256 and ``outcome``: no_link, no_text, duplicate (the text or the URL is stored
    or came earlier in the batch, in a row that was not known before it) or stored, asked in this order."""
    b = batch.withColumns({"sha256": F.sha2(F.coalesce("text", F.lit("")), 256), "_url": T.null_if_empty(T.folded_url(F.coalesce("url", F.lit(""))))})
    usable = F.col("_url").isNotNull() & (F.length(F.trim(F.coalesce("text", F.lit("")))) >= least_chars)
    shas, urls = stored.select("sha256").distinct().withColumn("_s", F.lit(True)), stored.select(T.folded_url(F.col("url")).alias("_url")).distinct().withColumn("_u", F.lit(True))
    known = F.coalesce("_s", F.lit(False)) | F.coalesce("_u", F.lit(False))
    j = b.join(shas, "sha256", "left").join(urls, "_url", "left")
    fresh = j.filter(usable & ~known)
    j = j.join(fresh.groupBy("sha256").agg(F.min(order).alias("_fs")), "sha256", "left").join(fresh.groupBy("_url").agg(F.min(order).alias("_fu")), "_url", "left")
    again = known | F.coalesce(F.col("_fs") < F.col(order), F.lit(False)) | F.coalesce(F.col("_fu") < F.col(order), F.lit(False))
    outcome = F.when(F.col("_url").isNull(), "no_link").when(~usable, "no_text").when(again, "duplicate").otherwise("stored")
    return j.select(*batch.columns, "sha256", outcome.alias("outcome"))


def known_by_either(rows: DataFrame, feed: DataFrame, author: str, url: str, entry: str, by_url: Column) -> DataFrame:
    """Rows that the feed does not have: under (author, canonical URL) where ``by_url`` holds, else under (author,
    entry key). Authors are compared in lower case."""
    r = rows.withColumns({"_a": F.lower(author), "_u": T.without_query(F.col(url)), "_by": by_url})
    f = feed.select(F.lower(author).alias("_a"), T.without_query(F.col(url)).alias("_u"), F.col(entry).alias("_e"))
    one = r.filter("_by").join(f.select("_a", "_u").distinct(), ["_a", "_u"], "left_anti").select(*rows.columns)
    two = r.filter("not coalesce(_by, false)").withColumn("_e", F.col(entry)).join(f.select("_a", "_e").distinct(), ["_a", "_e"], "left_anti").select(*rows.columns)
    return one.unionByName(two)


def intake_class(published: Column, captured: Column, first_run: Column, complete: Column, days: int = 3) -> Column:
    """Live only for a complete scan that is not a source's first and found the row in time; else backfill."""
    late = F.coalesce(T.days_between(published, captured) > days, F.lit(False))
    return F.when(first_run | ~F.coalesce(complete, F.lit(False)) | late, "backfill").otherwise("live_candidate")


def downgraded(df: DataFrame, wrong: Column, reason: str, at: str) -> DataFrame:
    """Rows for which ``wrong`` holds become backfill, with a ``revision`` that says which fields changed, when and
    why; others keep theirs."""
    revision = F.struct(F.array(F.lit("intake_class")).alias("fields"), F.lit(at).alias("at"), F.lit(reason).alias("reason"))
    had = F.col("revision") if "revision" in df.columns else F.lit(None)
    return df.withColumns({"revision": F.when(wrong, revision).otherwise(had), "intake_class": F.when(wrong, "backfill").otherwise(F.col("intake_class"))})


def best_acquisition(candidates: DataFrame, key: str, quality: str, priority: str, order: str) -> DataFrame:
    """The candidate of each key with the best grade (``Q1`` before ``Q5``), then by provider priority, then by ``order``,
    a column without ties within a key."""
    return first_of(candidates, [key], [F.col(quality).asc_nulls_last(), F.col(priority).asc_nulls_last(), F.col(order).asc_nulls_last()])


def discoveries(paths: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, paths): in which of several listings a key was found, by name, and whether the first one has it."""
    out = None
    for name, df in paths.items():
        one = df.select(key, F.lit(name).alias("path"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("path")), ",").alias("paths"))


def pages_to_cutoff(listing: DataFrame, page: str, published: str, cutoff: str) -> DataFrame:
    """Rows of the pages up to the first whose newest date lies before the cutoff, as a scan would have seen them."""
    newest = listing.groupBy(page).agg(F.max(published).alias("_n"))
    stop = newest.filter(F.col("_n") < cutoff).agg(F.min(page).alias("_stop"))
    return listing.join(F.broadcast(stop), F.lit(True)).filter(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")


def routed(candidates: DataFrame, key: str, full: list[str], brief: list[str]) -> DataFrame:
    """The best transcript of each key out of what several providers gave: ``candidates`` has domain, text and priority.
    Texts are cleaned and graded by their provider; the best grade wins, then priority. A key of which no text is worth
    a grade above the lowest has its metadata only. ``rule_allowed`` marks full transcripts."""
    text = clean_text(F.coalesce("text", F.lit("")))
    graded = candidates.select(key, "domain", "priority", text.alias("text")).withColumn("quality", L.grade(F.col("domain"), F.col("text"), full, brief))
    best = first_of(graded, [key], [F.col("quality").asc(), F.col("priority").asc_nulls_last(), F.col("domain").asc_nulls_last(), F.sha2("text", 256).asc()])
    none = F.col("quality") == "Q5"
    return best.select(
        key, F.when(none, "metadata_only").otherwise("available").alias("status"), "quality", F.when(none, "metadata_only").otherwise(F.coalesce("domain", F.lit(""))).alias("provider"), F.when(none, "").otherwise(F.col("text")).alias("text"),
        L.timed(F.col("text")).alias("timestamp_evidence"), (F.col("quality") == "Q2").alias("rule_allowed"), F.when(none, 0).otherwise(F.length("text")).cast("long").alias("chars"))
