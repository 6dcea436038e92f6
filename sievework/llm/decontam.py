"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations only.

A short item inside a long document has a high containment but a tiny Jaccard similarity, so one sketch size can't
serve all documents. Documents are partitioned by the power of two above their number of shingles, and each partition
has its own one-permutation MinHash sketch: the smallest hash of each of ``2 ** (size + extra)`` bins. Items are
partitioned by their own number of shingles, and sketched once for each document partition; small items get more bins.
An item is a candidate for a document of which it shares a bin minimum. Only documents with a candidate are cut into
shingles again, and their candidates are verified by exact shingle containment.

With ``extra`` bins a shingle of an item inside a document is the minimum of its bin with probability 1 - 2**-extra at
least, so an item is missed only if all its shared shingles fail: under 1e-6 for each row of ``SIZES``.

Items enter as a broadcast table while their sketches are under ``broadcast_rows`` rows; beyond that both sides are
shuffled by bin minimum.

Edge cases: words are runs of letters and digits, lower-cased; items under five words are one shingle of all their
words and are sought at that width; a null or wordless text has no shingles and never matches; rows that repeat both
id and text count once; texts of any length are searched whole; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import fresh, written

#: Items with at least so many shingles, up to the next row: further bins as a power of two, and rounds of hashing.
SIZES = ((1, 10, 2), (4, 7, 1), (12, 3, 1))
WIDTH = 5
#: Documents of more than 2 ** LARGEST shingles share the last partition.
LARGEST = 26


def pinned(c: Column) -> Column:
    """``c``, worked out once where it stands: the optimizer moves no filter below it, so what refers to it many times
    refers to its value and not to a copy of its expression."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column, width: int) -> Column:
    """Distinct hashes of the ``width``-word windows of a column of words."""
    window = lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, width)))
    return F.array_distinct(F.transform(F.slice(w, 1, F.greatest(F.size(w) - (width - 1), F.lit(0))), window))


def key_of(docs: DataFrame, text: str = "text") -> Column:
    """Tells apart the texts of rows with one doc_id."""
    return F.xxhash64(F.col("doc_id"), F.col(f"`{text}`"))


def _minima(df: DataFrame, bits: Column, part: int, turn: int, out: str) -> DataFrame:
    """Add the keys of a sketch of the column ``h``: the smallest hash of each bin, a bin being the leading ``bits``
    bits, hashed with the sketch's own name so that only sketches of one kind meet."""
    df = df.withColumn("_bits", bits).withColumn("_order", F.sort_array(F.transform("h", lambda x: F.xxhash64(x, F.lit(turn)))))
    first = F.expr("filter(_order, (x, i) -> i = 0 or shiftrightunsigned(x, 64 - _bits) != shiftrightunsigned(get(_order, i - 1), 64 - _bits))")
    return df.withColumn(out, F.transform(first, lambda x: F.xxhash64(x, F.col("_bits"), F.lit(part), F.lit(turn)))).drop("_bits", "_order")


def _sketches(df: DataFrame, parts: list[int], bits) -> DataFrame:
    """One row per bin minimum: the columns of ``df`` but ``h``, and ``minimum``."""
    names = []
    for part in parts:
        for turn in range(SIZES[part][2]):
            names.append(f"_m{part}_{turn}")
            df = _minima(df, bits(SIZES[part][1]), part, turn, names[-1])
    return df.withColumn("minimum", F.explode(pinned(F.concat(*names)))).drop("h", *names)


def _joined(large: DataFrame, small: DataFrame, on: str, broadcast_rows: int) -> DataFrame:
    """Broadcast ``small``, a written table, only while it is known to be short."""
    return large.join(F.broadcast(small) if small.count() <= broadcast_rows else small, on)


def _within(texts: DataFrame, items: DataFrame, width: int, parts: list[int], threshold: float, broadcast_rows: int) -> DataFrame:
    """Items of one width in ``texts`` (doc_id, doc_key, text): candidates by sketches, then only their texts are verified."""

    def hashed(some: DataFrame) -> DataFrame:
        cut = some.withColumn("w", pinned(words(F.col("text")))).select("doc_id", "doc_key", pinned(shingles(F.col("w"), width)).alias("h"))
        return cut.filter(F.size("h") > 0)

    sketched = []
    for part in parts:
        most = SIZES[part + 1][0] - 1 if part + 1 < len(SIZES) else 1 << 30
        own = items.filter(F.col("n_item").between(SIZES[part][0], most)).withColumn("size", F.explode(F.sequence(F.lit(0), F.lit(LARGEST))))
        sketched.append(_sketches(own.select("item_id", "item_key", "h", "size"), [part], lambda extra: F.col("size") + extra).drop("size"))
    known = sketched[0]
    for more in sketched[1:]:
        known = known.unionByName(more)
    size = F.least(F.ceil(F.log2(F.size("h").cast("double"))).cast("int"), F.lit(LARGEST))
    probes = _sketches(hashed(texts).select("doc_key", "h"), parts, lambda extra: size + extra)
    pairs = _joined(probes, written(known.select("item_key", "minimum").distinct(), "item-sketches"), "minimum", broadcast_rows).select("doc_key", "item_key").distinct()
    pairs = written(pairs, "candidates")
    found = written(pairs.select("doc_key").distinct(), "candidate-documents")
    verify = hashed(_joined(texts, found, "doc_key", broadcast_rows))
    listed = written(items.select("item_id", "item_key", "n_item", F.explode("h").alias("shingle")), "item-shingles")
    hits = _joined(verify.select("doc_id", "doc_key", F.explode("h").alias("shingle")), listed, "shingle", broadcast_rows)
    shared = hits.join(pairs, ["doc_key", "item_key"], "left_semi").groupBy("doc_id", "doc_key", "item_id", "item_key", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
    return shared.filter(F.col("n_shared") >= threshold * F.col("n_item")).select(
        "doc_id", "item_id", "doc_key", "n_shared", F.col("n_item").cast("long").alias("n_item"), (F.col("n_shared") / F.col("n_item")).alias("containment"))


def contained(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = 0.8, broadcast_rows: int = 1 << 20) -> DataFrame:
    """doc_id, item_id, doc_key, n_shared, n_item and containment of every item of which a document holds
    ``threshold`` or more of the shingles. ``doc_key`` is ``key_of`` the document."""
    w = items.select("item_id", pinned(words(F.col("text"))).alias("w")).filter(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    by_width = F.coalesce(*(F.when(F.col("width") == k, shingles(F.col("w"), k)) for k in range(1, WIDTH + 1)))
    known = written(w.withColumn("h", pinned(by_width)).select("item_id", "width", "h", F.size("h").alias("n_item"), F.xxhash64("width", "h").alias("item_key")).distinct(), "items")
    part = F.lit(len(SIZES) - 1)
    for i in range(len(SIZES) - 1, 0, -1):
        part = F.when(F.col("n_item") < SIZES[i][0], i - 1).otherwise(part)
    kinds = known.select("width", part.alias("part")).distinct().collect()  # a few numbers: widths times rows of SIZES
    texts = docs.select("doc_id", key_of(docs, text).alias("doc_key"), F.col(f"`{text}`").cast("string").alias("text"))
    empty = docs.select("doc_id").limit(0).join(items.select("item_id").limit(0), F.lit(True)).selectExpr(
        "doc_id", "item_id", "cast(0 as long) doc_key", "cast(0 as long) n_shared", "cast(0 as long) n_item", "cast(0 as double) containment")
    found = [_within(texts, known.filter(F.col("width") == k), k, sorted(r["part"] for r in kinds if r["width"] == k), threshold, broadcast_rows) for k in sorted({r["width"] for r in kinds})]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return found[0] if found else empty


def clean(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the columns of ``docs``."""
    bad = fresh(docs, "_bad")
    found = contained(docs, items, text, threshold).select(F.col("doc_key").alias(bad)).distinct()
    return docs.join(found, key_of(docs, text) == F.col(bad), "left_anti")
