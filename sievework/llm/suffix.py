"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that starts anywhere else too.

Suffixes are ordered only through ``length`` bytes, by radix passes from the most significant digit; after the last
pass a group of equal suffixes is exactly a repeated window, and groups of one leave after each pass.

* The first digit is read at one anchor per window: the window's smallest hash of ``first`` bytes, the leftmost of
  equals. Equal windows choose equal anchors, so one row per anchor (about one per ``(length - first) / 2`` bytes)
  stands for all its windows, and anchors whose digit occurs once end the search for all of them.
* Runs of windows with one anchor that occur whole in two places are repeated as they stand; of each kind of run one
  goes on, and only if another kind has the same anchor digit.
* The second digit is the core that ``block`` neighbouring windows of an anchor share: ``length - block + 1`` bytes,
  with its 128-bit hash. Blocks whose core occurs once leave.
* The last digit is what a window has beside its core, under ``block`` bytes in all.

Each pass counts by key with partial sums and joins the counts back, so a passage that stands in a third of all
documents is a large key of a skewed join that can be split, never one task's group. Tasks read texts in slabs of
2 ** 20 bytes. Anchors and cores are written to the shared folder between passes.

Edge cases: a null text counts as empty; texts under ``length`` bytes keep all; strings never cross documents; rows
that repeat both id and text are documents of their own, hence copies of each other; null ids and extra columns are
fine; a removed span may cut a character, so what is kept is bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import dropped, written

LENGTH, FIRST, BLOCK = 400, 200, 32
_BITS = 20
_BASE = 0x9E3779B97F4A7C15
_ROW = ["_row1", "_row2"]


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    n = 1 << _BITS
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _digits(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place."""
    up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    done, out = 1, x
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if width > done else out


def anchors(texts: list[bytes], length: int, first: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Slab by slab: text number, anchor place, first and last window start that chose it, and digit, as arrays."""
    most = (1 << _BITS) - length
    pieces: list[tuple[int, int, int]] = []
    held = 0
    for i, text in enumerate(texts):
        windows = len(text) - length + 1
        for begin in range(0, max(windows, 0), most):
            n = min(most, windows - begin)
            if held + n + length - 1 > 1 << _BITS:
                yield _slab(texts, pieces, length, first)
                pieces, held = [], 0
            pieces.append((i, begin, n))
            held += n + length - 1
    if pieces:
        yield _slab(texts, pieces, length, first)


def _slab(texts: list[bytes], pieces: list[tuple[int, int, int]], length: int, first: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts[i][b : b + n + length - 1] for i, b, n in pieces), np.uint8)
    digit = _digits(data, first)
    low = np.uint64((1 << _BITS) - 1)
    minima = _window_minima((digit & ~low) | np.arange(len(digit), dtype=np.uint64), length - first + 1)
    counts = np.array([n for _, _, n in pieces])
    offsets = np.cumsum([0] + [n + length - 1 for _, _, n in pieces[:-1]])
    piece = np.repeat(np.arange(len(pieces)), counts)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
    chosen = (minima[offsets[piece] + within] & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (piece[1:] != piece[:-1])]))
    last = np.concatenate([new[1:] - 1, [len(piece) - 1]])
    p = piece[new]
    begin = np.array([b for _, b, _ in pieces])[p]
    return np.array([i for i, _, _ in pieces])[p], chosen[new] - offsets[p] + begin, within[new] + begin, within[last] + begin, digit[chosen[new]].view(np.int64)


def _bytes(column: pa.Array) -> list[bytes]:
    return [(x.as_py() or "").encode() for x in column]


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def repeated(docs: DataFrame, length: int = LENGTH, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """Rows (_row1, _row2, low, high): the windows of a document that start from ``low`` to ``high`` occur elsewhere
    too. ``docs`` has text and the two row keys."""

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r1, r2 = (np.asarray(b.column(k)) for k in _ROW)
            for i, _, _, _, digit in anchors(_bytes(b.column("text")), length, first):
                yield _batch({"_row1": pa.array(r1[i]), "_row2": pa.array(r2[i]), "digit": pa.array(digit)})

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r1, r2, texts = np.asarray(b.column("_row1")), np.asarray(b.column("_row2")), _bytes(b.column("text"))
            wanted = [np.asarray(x.values) for x in b.column("digits")]
            rows: list[tuple] = []
            held = 0
            for i, anchor, low, high, digit in anchors(texts, length, first):
                ends = np.flatnonzero(np.diff(i, append=-1))
                live = np.concatenate([np.isin(digit[s : e + 1], wanted[i[e]]) for s, e in zip([0, *(ends[:-1] + 1)], ends, strict=True)])
                for n, a, lo, hi, d in zip(*(x[live].tolist() for x in (i, anchor, low, high, digit)), strict=True):
                    data = texts[n][lo : hi + length]
                    rows.append((r1[n], r2[n], a, lo, hi, d, xxhash.xxh3_128_digest(b"%d %d " % (a - lo, a - hi) + data), data))
                    held += len(data)
                    if held > 8 << 20:
                        yield _table(rows, RUNS)
                        held = 0
            if rows:
                yield _table(rows, RUNS)

    def third_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for r1, r2, a, lo, hi, n, data in zip(*(b.column(k).to_pylist() for k in ("_row1", "_row2", "a", "lo", "hi", "n", "data")), strict=True):
                for q in range((a - hi) // block, (a - lo) // block + 1):
                    x = a - q * block
                    core, p, z = x - lo, max(lo, x - block + 1), min(hi, x)
                    end = core - block + 1 + length
                    rows.append((r1, r2, xxhash.xxh3_128_digest(data[core:end]), x, x - z, x - p, data[p - lo : core], data[end : z - lo + length], n))
            if rows:
                yield _table(rows, CORES)

    spark = docs.sparkSession
    made = written(docs.select(*_ROW, "text").mapInArrow(first_pass, "_row1 long, _row2 long, digit long"), "anchors")
    often = made.groupBy("digit").count().filter("count > 1").select("digit")
    alive = made.join(often, "digit").groupBy(*_ROW).agg(F.collect_set("digit").alias("digits"))
    runs = written(docs.select(*_ROW, "text").join(alive, _ROW).mapInArrow(second_pass, RUNS), "runs")
    dropped(spark, made)
    # Runs that occur whole in two places are done. Of each kind of run one goes on, if its digit has other kinds.
    one = F.min(F.struct(*_ROW, "a", "lo")).alias("one")
    kinds = written(runs.groupBy("digit", "whole").agg(F.count("*").alias("n"), one), "kinds")
    whole = runs.select(*_ROW, "lo", "hi", "whole").join(kinds.filter("n > 1").select("whole"), "whole").select(*_ROW, F.col("lo").alias("low"), F.col("hi").alias("high"))
    several = kinds.groupBy("digit").count().filter("count > 1").select("digit")
    tried = kinds.join(several, "digit").select("one.*", "n")
    cores = written(runs.join(tried, [*_ROW, "a", "lo"]).select(*_ROW, "a", "lo", "hi", "n", "data").mapInArrow(third_pass, CORES), "cores")
    shared = cores.groupBy("core").count().filter("count > 1").select("core")
    window = F.md5(F.concat("core", F.encode(F.col("j").cast("string"), "utf-8"), F.expr("substring(left, length(left) - j + 1, j)"), F.expr(f"substring(right, 1, {block - 1} - j)")))
    spread = cores.join(shared, "core").withColumn("j", F.explode(F.sequence("near", "far"))).select(*_ROW, F.unhex(window).alias("window"), (F.col("x") - F.col("j")).alias("low"), "n")
    again = spread.groupBy("window").agg(F.sum("n").alias("m")).filter("m > 1").select("window")
    parts = written(spread.filter("n = 1").join(again, "window").groupBy(*_ROW).agg(F.array_sort(F.collect_set("low")).alias("lows")), "windows")
    return whole.unionByName(parts.select(*_ROW, F.explode("lows").alias("low")).withColumn("high", F.col("low")))


#: The windows of one anchor: from ``lo`` to ``hi`` in the document, and all their bytes.
RUNS = "_row1 long, _row2 long, a int, lo int, hi int, digit long, whole binary, data binary"
#: A block of windows: hash of the core, where it begins, how far before it the last and first window start, and the
#: bytes from the first window to the core and from the core to the end of the last. n: places of the run.
CORES = "_row1 long, _row2 long, core binary, x int, near int, far int, left binary, right binary, n long"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    out = pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))
    rows.clear()
    return out


def cut(data: bytes, windows: list[tuple[int, int]], length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``data``, and the removed spans, given ranges of window starts."""
    spans: list[list[int]] = []
    for low, high in sorted(windows):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high + length)
        else:
            spans.append([low, high + length])
    kept, at = [], 0
    for low, high in spans:
        kept.append(data[at:low])
        at = high
    return b"".join([*kept, data[at:]]), [(a, b) for a, b in spans]


def dedup(docs: DataFrame, text: str = "text", length: int = LENGTH, first: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (array of removed begin-end pairs) and kept (binary): one row per row of
    ``docs``."""
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"_row1": F.xxhash64("doc_id", "text"), "_row2": F.xxhash64("text", "doc_id", F.lit(1))})
    found = repeated(rows, length, first or length // 2, min(block, length // 4 or 1))
    windows = found.groupBy(*_ROW).agg(F.collect_list(F.struct("low", "high")).alias("windows"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, kept, spans = [], [], []
            for data, w in zip(_bytes(b.column("text")), b.column("windows").to_pylist(), strict=True):
                left, gone = cut(data, [(x["low"], x["high"]) for x in w or []], length)
                n.append(len(data))
                kept.append(left)
                spans.append([{"begin": a, "end": z} for a, z in gone])
            yield _batch({"doc_id": b.column("doc_id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array([x - len(k) for x, k in zip(n, kept, strict=True)], pa.int64()),
                          "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"
    return rows.join(windows, _ROW, "left").select("doc_id", "text", "windows").mapInArrow(finish, schema)
