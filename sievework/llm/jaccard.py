"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of ``width``-word shingles; texts with equal sets are one class and only its representative is joined.
Representatives are banded by MinHash: at a Jaccard similarity of 0.8 two share one of ``BANDS`` bands of ``ROWS``
values with probability 1 - (1 - 0.8 ** ROWS) ** BANDS, 0.99997, and such a pair passes all looks of the pruning with
0.9994, so one at exactly the threshold is tied with 0.9993 and closer ones more surely. Within a bucket MinHash values are compared
``STEP`` at a time; with m of k values equal the similarity has a Beta(m + 1, k - m + 1) posterior under a flat prior,
and a pair is dropped as soon as the probability of reaching the threshold falls below ``tolerance``. What is left of
a bucket leaves it as a spanning forest, and distributed union-find joins the forests into groups. In each group the
representatives' shingle sets are compared exactly, all against all, so no link inside a group is lost, and links and
classes are taken from exact similarities alone.

Large buckets and groups are dealt out as pairs of blocks of at most ``BLOCK`` members, each pair one unit of work, so
no task holds more than two blocks; pairs themselves are never rows.

Edge cases: words are split at white space and lower-cased; a text with fewer words than ``width`` has one shingle of
all its words; null and wordless texts have no shingles, no links and classes of their own; null ids are allowed, rows
that repeat id and text fall into one class; texts of any length are used whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.near import components, distinct, forest, mixed, rolled, signatures
from sievework.llm.shared import dropped, fresh, written

WIDTH, SIMILARITY, TOLERANCE = 5, 0.8, 1e-4
BANDS, ROWS, STEP, BLOCK = 20, 4, 10, 512
_HASHES = BANDS * ROWS


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's word windows."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    codes = np.fromiter((known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words), np.uint64, len(words))
    return distinct(rolled(codes, min(width, len(words))))


@lru_cache(8)
def least_matches(threshold: float, tolerance: float, n: int = _HASHES, step: int = STEP) -> tuple[int, ...]:
    """For each look at step, 2 * step, ... values: the least number of equal ones with which a pair may go on."""
    x = np.linspace(0, 1, 20_001)
    out = []
    for k in range(step, n + 1, step):
        least = 0
        for m in range(k + 1):
            with np.errstate(divide="ignore"):
                log = m * np.log(x) + (k - m) * np.log1p(-x) if 0 < m < k else (k * np.log(x) if m else k * np.log1p(-x))
            density = np.exp(log - log.max())
            if density[x >= threshold].sum() / density.sum() >= tolerance:
                break
            least = m + 1
        out.append(least)
    return tuple(out)


def survivors(left: np.ndarray, right: np.ndarray | None, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature tables (or of one, each pair once) that are never dropped."""
    other = left if right is None else right
    keep_a, keep_b = [], []
    for i in range(len(left)):
        j = np.arange(i + 1 if right is None else 0, len(other))
        equal = np.zeros(len(j), np.int32)
        for look, least in enumerate(least_matches(threshold, tolerance)):
            part = slice(look * STEP, (look + 1) * STEP)
            equal = equal + (other[j, part] == left[i, part]).sum(axis=1)
            on = equal >= least
            j, equal = j[on], equal[on]
            if not len(j):
                break
        keep_a.append(np.full(len(j), i))
        keep_b.append(j)
    return np.concatenate(keep_a), np.concatenate(keep_b)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of sorted batches, one table per run of equal ``keys``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([np.asarray(batch.column(x)) for x in keys])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            now = tuple(k[:, s].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _dealt(members: DataFrame, key: str, node: str, sizes: DataFrame) -> DataFrame:
    """Each member once for each pair of blocks that it is part of: columns i <= j, and ``own``, its block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    out = members.join(sizes, key).withColumn("own", F.pmod(F.xxhash64(node, F.lit("block")), blocks).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return out.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "n").repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "own")


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    i, own = np.asarray(t.column("i")), np.asarray(t.column("own"))
    return np.flatnonzero(own == i), np.flatnonzero(own != i)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, row key, class (hash of the shingle set; null without shingles) and MinHash signature."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                sets = [shingle_set(x.as_py(), width) for x in b.column("text")]
                full = [x for x in sets if len(x)]
                sig = iter(signatures(np.concatenate(full), np.array([len(x) for x in full]), _HASHES)) if full else iter(())
                cls = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(cls, pa.int64()), pa.array([next(sig).tobytes() if len(x) else None for x in sets], pa.binary())], ["doc_id", "row", "class", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(made, f"doc_id {kind}, row long, class long, signature binary")


def candidates(classes: DataFrame, similarity: float, tolerance: float) -> DataFrame:
    """(a, b): a spanning forest of the pairs of classes that banding finds and pruning leaves."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, _HASHES)
            out = np.empty((len(sig), BANDS), np.uint64)
            for b in range(BANDS):
                h = np.full(len(sig), b, np.uint64)
                for r in range(ROWS):
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r])
                out[:, b] = h
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel().view(np.int64)), pa.array(np.repeat(np.asarray(batch.column("class")), BANDS))], ["bucket", "class"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, ["bucket", "i", "j"]):
            nodes = np.asarray(t.column("class"))
            sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint32).reshape(-1, _HASHES)
            x, y = _sides(t)
            if len(y):
                p, q = survivors(sig[x], sig[y], similarity, tolerance)
                p, q = x[p], y[q]
            else:
                p, q = survivors(sig, None, similarity, tolerance)
            tree = forest(len(nodes), p, q)
            if tree:
                n, r = np.array(tree).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[n]), pa.array(nodes[r])], ["a", "b"])

    bands = written(classes.select("class", "signature").mapInArrow(banded, "bucket long, class long"), "bands")
    sizes = written(bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = bands.join(sizes.select("bucket"), "bucket").join(classes.select("class", "signature"), "class")
    return _dealt(members, "bucket", "class", sizes).select("bucket", "i", "j", "own", "class", "signature").mapInArrow(compared, "a long, b long").distinct()


def _intersections(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of common elements of each two sets, and sizes."""
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width, out = 8192, np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, [at, at + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[s:e], column[s:e] - at] = 1
        out += m @ m.T
    return out, sizes


def links(groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """For each block pair of each group: per class the number of exact links, and one link of a spanning forest or
    null. ``groups`` has node and root; ``sets`` has class and shingles."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, ["root", "i", "j"]):
            nodes = np.asarray(t.column("class"))
            same, sizes = _intersections([np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()])
            close = same >= similarity * (sizes[:, None] + sizes[None, :] - same)
            np.fill_diagonal(close, False)
            x, y = _sides(t)
            if len(y):  # pairs within a block are counted where i = j
                close[np.ix_(x, x)] = False
                close[np.ix_(y, y)] = False
            tree = dict(forest(len(nodes), *np.nonzero(np.triu(close))))
            counts = close.sum(axis=1)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(counts[some].astype(np.int64)), pa.array([int(nodes[tree[k]]) if k in tree else None for k in some.tolist()], pa.int64())], ["class", "n", "up"])

    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    members = groups.withColumnRenamed("node", "class").join(sets, "class")
    return _dealt(members, "root", "class", sizes).select("root", "i", "j", "own", "class", "shingles").mapInArrow(exact, "class long, n long, up long")


def join(docs: DataFrame, text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, row (hash of id and text), root (the class's name), class_id (least doc_id of the documents that links and equal sets connect;
    null if all ids are) and n_links (number of other texts, by shingle set, that are linked): one row per row."""
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    sketched = written(sketches(rows, width), "sketches")
    classes = sketched.filter("class is not null").groupBy("class").agg(F.min("row").alias("row"), F.min_by("signature", "row").alias("signature"))
    classes = written(classes, "classes")
    groups = written(components(written(candidates(classes, similarity, tolerance), "candidates")), "groups")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([b.column("class"), pa.array([shingle_set(x.as_py(), width).tobytes() for x in b.column("text")], pa.binary())], ["class", "shingles"])

    chosen = groups.select(F.col("node").alias("class")).join(classes.select("class", "row"), "class")
    # Texts are shuffled at every size: the chosen rows grow with the input, so a broadcast that fits today would not last.
    sets = written(rows.select("row", "text").join(chosen.hint("merge"), "row").dropDuplicates(["class"]).select("class", "text").mapInArrow(shingled, "class long, shingles binary"), "sets")
    found = written(links(groups, sets, similarity), "links")
    dropped(docs.sparkSession, sets)
    roots = components(found.filter("up is not null").select(F.col("class").alias("a"), F.col("up").alias("b")))
    counts = found.groupBy("class").agg(F.sum("n").alias("n_links"))
    tied = sketched.select("doc_id", "row", "class").join(roots.withColumnRenamed("node", "class"), "class", "left").join(counts, "class", "left")
    tied = tied.withColumn("root", F.coalesce("root", "class"))
    least = tied.filter("class is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return tied.join(least, "root", "left").select("doc_id", "row", F.coalesce("root", "row").alias("root"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def first_of_each(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` of each class, the one with the least id, with the columns of ``docs``; a row without an id
    only where its class has no other."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    row = fresh(docs, "_row")
    keep = join(docs, text, similarity=similarity).groupBy("root").agg(best.alias("best")).select(F.col("best.row").alias(row))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", F.col(f"`{text}`").cast("string")))
    return keyed.join(keep, row, "left_semi").dropDuplicates([row]).select(*(F.col(f"`{c}`") for c in docs.columns))
