"""What the near-duplicate operators share: shingle hashes, MinHash signatures and distributed union-find.

Edge cases: an array shorter than a window has no hashes; edges of a node with itself and repeated edges count once or
not at all; no edges give no components.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import dropped, written

_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` numbers from each place of an array, put together from those of powers of two."""
    if len(codes) < width:
        return np.zeros(0, np.uint64)
    base, part, size, out, done = 0x9E3779B97F4A7C15, codes.astype(np.uint64), 1, None, 0
    while True:
        if width & size:
            if out is None:
                out, done = part, size
            else:
                n = len(codes) - done - size + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + part[done : done + n]
                done += size
            if done == width:
                return mixed(out)
        part = part[:-size] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
        size *= 2


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; by sorting, which is faster here than numpy's table of hashes."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


@lru_cache(4)
def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1 << 32, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def signatures(hashes: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """MinHash values, uint32 of shape (len(sizes), n), of runs of ``hashes``; a run may not be empty."""
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), n), np.uint32)
    step = max(1, len(hashes))
    for k, a in enumerate(_multipliers(n)):
        out[:, k] = np.minimum.reduceat((hashes[:step] * a) >> np.uint64(32), starts)
    return out


def short_signatures(hashes: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """``signatures`` in 32-bit arithmetic: for short texts in slabs that stay in a core's cache."""
    starts = np.cumsum(sizes) - sizes
    low, out = (hashes >> np.uint64(32)).astype(np.uint32), np.empty((len(sizes), n), np.uint32)
    work = np.empty_like(low)
    for k, (a, b) in enumerate(np.random.default_rng(11).integers(1, 1 << 32, (n, 2), dtype=np.uint32)):
        np.bitwise_xor(low, b, out=work)
        np.multiply(work, a | np.uint32(1), out=work)
        out[:, k] = np.minimum.reduceat(work, starts)
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(node, root) of the components that the edges make of 0..n-1, roots themselves left out."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
    return [(x, top(x)) for x in range(n) if up[x] != x]


def thinned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect the same nodes."""
    names, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    tree = np.array(forest(len(names), places[: len(a)], places[len(a) :]), np.int64).reshape(-1, 2)
    return names[tree[:, 0]], names[tree[:, 1]]


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b), root being the least node of its component.

    Large-star and small-star rounds: each node hangs its larger neighbours, then its smaller ones, on the least
    neighbour it knows, until nothing changes. Rounds grow with the logarithm of the longest path. Each round is
    written to the shared folder; only counts and a checksum come to the driver."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        hung = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        last, now = now, written(hung.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
        dropped(edges.sparkSession, last)
        after = _mark(now)
        if after == before:
            break
        before = after
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()).groupBy("node").agg(F.min("root").alias("root"))
