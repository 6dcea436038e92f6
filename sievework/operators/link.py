"""Joins of records with texts, keys and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T


def verified_texts(items: DataFrame, texts: DataFrame, key: str, text: str, digest: str) -> DataFrame:
    """``items`` with the text whose SHA-256 is the one they were frozen with; null where no text is it."""
    known = texts.select(F.col(key).alias("_k"), F.col(text).alias(text), F.sha2(text, 256).alias("_h")).dropDuplicates(["_k", "_h"])
    return items.join(known, (F.col(key) == F.col("_k")) & (F.col(digest) == F.col("_h")), "left").drop("_k", "_h")


def with_url_matches(items: DataFrame, records: DataFrame, url: str, key: str, flag: Column) -> DataFrame:
    """``items`` with the number of records under their canonical URL, the first of these, and whether any has the flag."""
    m = records.withColumn("_u", T.without_query(F.col(url))).groupBy("_u").agg(F.count("*").alias("matches"), F.min(key).alias("first_record"), F.bool_or(flag).alias("any_flag"))
    j = items.withColumn("_own", T.without_query(F.col(url))).join(m, F.col("_own") == F.col("_u"), "left").drop("_own", "_u")
    return j.withColumns({"matches": F.coalesce("matches", F.lit(0)).cast("long"), "any_flag": F.coalesce("any_flag", F.lit(False))})


def through(answers: DataFrame, names: DataFrame, records: DataFrame, blind: str, item: str, record: str) -> DataFrame:
    """Answers under blind names joined to items and on to records."""
    return answers.join(names.select(blind, item), blind).join(records.select(item, record), item)


def attributed(rows: DataFrame, url: str, config: DataFrame, pattern: str, prefix: str, board: str) -> DataFrame:
    """``kind`` and ``author`` from the link alone: a configured blog's author, an unknown blog by its id, a board's post
    and any other link without an author. ``config`` (blog_id, blog_author) is small: one row for each profile."""
    found = rows.withColumn("_b", T.null_if_empty(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)))
    j = found.join(config.select(F.col("blog_id").alias("_b"), "blog_author"), "_b", "left")
    kind = F.when(F.col("_b").isNotNull(), "blog").when(F.contains(F.coalesce(url, F.lit("")), F.lit(board)), "forum").otherwise("owner_forward")
    author = F.when(F.col("_b").isNull(), "unattributed").otherwise(F.coalesce("blog_author", F.concat(F.lit(prefix), "_b")))
    return j.withColumns({"kind": kind, "author": author}).drop("_b", "blog_author")


def category(pages: DataFrame, page: str, html: str, pattern: str, config: DataFrame) -> DataFrame:
    """Per page and blog: distinct links by the blog id in their path; blogs that aren't configured count as one."""
    links = pages.select(page, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)))).alias("href"))
    j = links.withColumn("blog_id", F.regexp_extract("href", pattern, 1)).join(config.select("blog_id", F.lit(True).alias("_c")), "blog_id", "left")
    return j.groupBy(page, F.when(F.col("_c"), F.col("blog_id")).otherwise("unattributed").alias("blog")).agg(F.count("*").alias("links"))
