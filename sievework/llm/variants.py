"""Spelling variants: words that differ by one edit, found by an even-partition pigeonhole join.

A word is cut into two segments of even length; one edit leaves one of them whole. The index holds each word under its
length and each segment; a word probes it with its own segments, for words of equal length, and with the substrings at
the same place or one to the right, for words that are one shorter. A segment alone is shared by too many words of a
large vocabulary, so the damaged half is cut in two in the same way, and a key holds the whole half and the whole
quarter: no pair of near words is lost by it, and what meets in a bucket differs in one quarter only. Candidates are
then told apart and verified by their edit distance.

All tables here grow with the vocabulary, so every join is a merge join: the driver never gathers a side to broadcast
it, however small it looks in compressed form.

Everything is built from Spark's functions. Edge cases: null and empty texts have no words; a null doc_id counts as an
empty one; a word is any run of letters, however long; near words of equal count go by code points; an empty table
gives no rows; columns that aren't asked for are left out, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import written

LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs this many times as often as the words that take it.
RATIO = 10
#: Runs whose checksum this divides lose a code point.
SPOILT = 31


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``, its occurrences: letter runs, A-Z lower-cased, of which one in ``SPOILT`` lacks a code point."""
    run = F.translate(F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    long = runs.filter(F.length("run") >= LEAST_LENGTH).select(run.alias("run"), F.crc32(F.concat("key", F.lit(":"), run)).alias("sum"))
    at = (F.col("sum") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("sum") % SPOILT == 0, cut).otherwise(F.col("run"))
    found = long.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _keys(word: Column, length: Column, shift: int) -> list[Column]:
    """Keys of a word among words of ``length``: with ``shift`` 1 those of a word that is one longer. Parts behind the
    edit lie ``shift`` to the right of their place in the index."""
    half = F.floor(length / 2).cast("int")
    first, last = F.floor(half / 2).cast("int"), F.floor((length - half) / 2).cast("int")

    def part(start: Column, size: Column) -> Column:
        return F.substring(word, start + 1, size)

    zero = F.lit(0)
    left, right = part(zero, half), part(half + shift, length - half)
    return [
        F.xxhash64(length, F.lit(1), left, part(half, last)),  # the edit is in the last quarter
        F.xxhash64(length, F.lit(2), left, part(half + last + shift, length - half - last)),  # in the third
        F.xxhash64(length, F.lit(3), right, part(zero, first)),  # in the second
        F.xxhash64(length, F.lit(4), right, part(first + shift, half - first)),  # in the first
    ]


def near(vocabulary: DataFrame) -> DataFrame:
    """Each two words of (word, n) that differ by one edit, once: ``a``, ``b`` with ``a_n`` and ``b_n``."""
    size = F.length("word")
    index = vocabulary.select("word", "n", F.explode(F.array(*_keys(F.col("word"), size, 0))).alias("key"))
    longer = vocabulary.select("word", "n", F.explode(F.array(*_keys(F.col("word"), size - 1, 1))).alias("key"))
    a = index.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = index.withColumn("equal", F.lit(True)).unionByName(longer.withColumn("equal", F.lit(False))).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "equal")
    once = ~F.col("equal") | (F.col("a") < F.col("b"))
    met = a.join(b.hint("merge"), "key").filter(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "a_n", "b_n").distinct()


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``n``, ``n_near``, and the ``form`` of each word with ``form_n`` and ``root``: the near word that occurs
    most, if ``RATIO`` times as often, and what following forms ends at (the word itself if it has none)."""
    vocabulary = written(words(docs, key, text), "variant-words")
    pairs = near(vocabulary)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    most = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("most"))
    other, other_n = F.col("most.other"), -F.col("most.col1")
    enough = other_n >= RATIO * F.col("n")
    told = vocabulary.join(most.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, other).alias("form"), F.when(enough, other_n).alias("form_n"))
    found = written(told, "variant-forms")
    # counts grow RATIO times with each step, so the longest chain is known, and each join doubles the steps taken
    steps = max(1, int(math.log(max(found.agg(F.max("n")).first()[0] or 1, 1), RATIO)) + 1)
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        roots = roots.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("ahead", "root").alias("root"))
    return found.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
