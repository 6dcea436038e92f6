"""Line dedup: fuzzy lines by MinHash, one line kept per component over all documents.

Lines are compared lower-cased, with runs of white space as one space. Their shingles are ``width`` characters (a
shorter line is one shingle). Signatures are cut into ``bands`` of ``rows`` values; at a Jaccard similarity of 0.8 two
lines share a band with probability 1 - (1 - 0.8 ** rows) ** bands, 0.99995 by default. Each two lines of a band's
bucket are compared, unless they are known to be of one component. In a bucket of up to ``SMALL`` lines all pairs are
candidates; in a larger one each line is tied to the first ``HEADS`` and to the one before it. Candidates are verified by
the exact Jaccard similarity of the two lines' shingles, and distributed union-find joins what is left into components.
Then the larger buckets whose lines are not of one component yet are dealt out as pairs of blocks, and within those
every two lines of different components are compared, so no bucket's size takes links away. Of each component the line
that comes first by (doc_id, text hash, line number) stays.

Bands move as packed arrays, a share of all buckets in a row, and tasks leave out lines they have met before, which
takes the copies of a hot line out ahead of the shuffle. A share of too many entries is worked off in pieces, between
which only a large bucket's first lines are kept in memory; its others have gone out as rows by then.

Edge cases: lines without a visible character are kept as they are; a null text stays null; null ids come first; rows
that repeat both id and text are one document and end up alike; lines of any length are compared whole; lines are told
apart by 128-bit hashes; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.jaccard import _dealt, _runs, _sides
from sievework.llm.near import components, distinct, forest, mixed, rolled, short_signatures, thinned
from sievework.llm.shared import PACKED, by_part, dropped, packed, parts_of, written

WIDTH, BANDS, ROWS, SIMILARITY = 8, 14, 3, 0.8
#: Lines of a bucket of which all pairs are candidates, and those of a larger one to which each other line is tied.
SMALL, HEADS = 6, 2
_KEYS = ["_row1", "_row2"]


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingles(line: str, width: int) -> np.ndarray:
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return rolled(codes, min(width, max(1, len(codes))))


LISTED = "_row1 long, _row2 long, doc_id {kind}, numbers array<int>, keys array<long>, checks array<long>, fresh array<struct<key:long,check:long,line:string>>"


def listed(rows: DataFrame) -> DataFrame:
    """For each document the numbers of its visible lines with the two halves of their hashes, and the lines (in normal
    form) that its task had not met before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                numbers, names, ends = [], [], [0]
                fresh, new_names, new_ends = [], [], [0]
                if len(seen) > 400_000:
                    seen.clear()
                for text in batch.column("text").to_pylist():
                    for i, raw in enumerate(text.split("\n") if text else ()):
                        line = normal(raw)
                        if not line:
                            continue
                        h = xxhash.xxh3_128_digest(line)
                        numbers.append(i)
                        names.append(h)
                        if h not in seen:
                            seen.add(h)
                            new_names.append(h)
                            fresh.append(line)
                    ends.append(len(names))
                    new_ends.append(len(fresh))
                cuts, new_cuts = pa.array(ends, pa.int32()), pa.array(new_ends, pa.int32())
                keys, checks = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2).T.copy()
                new = np.frombuffer(b"".join(new_names), np.int64).reshape(-1, 2).T.copy()
                lines = pa.StructArray.from_arrays([pa.array(new[0]), pa.array(new[1]), pa.array(fresh, pa.string())], ["key", "check", "line"])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k) for k in (*_KEYS, "doc_id")), pa.ListArray.from_arrays(cuts, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(keys)), pa.ListArray.from_arrays(cuts, pa.array(checks)), pa.ListArray.from_arrays(new_cuts, lines),
                ], [*_KEYS, "doc_id", "numbers", "keys", "checks", "fresh"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(*_KEYS, "doc_id", "text").mapInArrow(read, LISTED.format(kind=kind))


def _paired(bucket: np.ndarray, key: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidates (a, b) among the members of buckets; places of members of large buckets, and of those that lead them;
    and the sorted members. Buckets in ``large`` are so from before."""
    order = np.lexsort((key, bucket))
    bucket, key = bucket[order], key[order]
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])
    bucket, key = bucket[new], key[new]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(starts, append=len(bucket))
    some = np.repeat((sizes > 1) | np.isin(bucket[starts], large), sizes)
    size, start = np.repeat(sizes, sizes)[some], np.repeat(starts, sizes)[some]
    at = np.flatnonzero(some)
    place = at - start
    big = (size > SMALL) | np.isin(bucket[at], large)
    left, right = [], []
    for d in range(1, SMALL):
        i = np.flatnonzero(~big & (place >= d))
        left.append(at[i] - d)
        right.append(at[i])
    for h in range(HEADS):
        i = np.flatnonzero(big & (place > h))
        left.append(start[i] + h)
        right.append(at[i])
    i = np.flatnonzero(big & (place > HEADS))
    left.append(at[i] - 1)
    right.append(at[i])
    return key[np.concatenate(left)], key[np.concatenate(right)], at[big], at[big & (place < HEADS)], bucket, key


def ties(lines: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Candidate pairs (a, b) of line keys, and each member ``a`` of a ``bucket`` in which these are not all pairs."""
    parts = parts_of(lines.sparkSession)
    step = (1 << 64) // parts + 1

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            bucket, key = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(bucket)
            return packed((bucket[order] // np.uint64(step)).astype(np.int64), [bucket[order], key[order]])

        for batch in batches:
            keys, texts, at = np.asarray(batch.column("key")), batch.column("line").to_pylist(), 0
            while at < len(texts):  # about 2 ** 17 characters at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 1 << 17):
                    size += len(texts[end])
                    end += 1
                found = _buckets(texts[at:end], width, bands, rows)
                held.append((found.ravel(), np.repeat(keys[at:end], bands)))
                count += len(held[-1][0])
                at = end
                if count > 1 << 20:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    state: dict = {}

    def tied(part: int, arrays: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        bucket, key = (np.concatenate([a, b]) for a, b in zip(arrays, state.pop("heads", (np.zeros(0, np.uint64), np.zeros(0, np.int64))), strict=True))
        known = state.pop("large", np.zeros(0, np.uint64))
        a, b, large, heads, bucket, key = _paired(bucket, key, known)
        if not last:
            rest = ~np.isin(bucket, bucket[large])
            state["heads"] = tuple(np.concatenate([x[heads], x[rest]]) for x in (bucket, key))
            state["large"] = distinct(np.concatenate([known, bucket[large]]))
        if len(a):
            a, b = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.nulls(int(new.sum()), pa.int64())], ["a", "b", "bucket"])
        if len(large):
            yield pa.RecordBatch.from_arrays([pa.array(key[large]), pa.nulls(len(large), pa.int64()), pa.array(bucket[large].view(np.int64))], ["a", "b", "bucket"])

    made = lines.select("key", "line").mapInArrow(banded, PACKED)
    return by_part(made, tied, [np.uint64, np.int64], "a long, b long, bucket long").distinct()


def _hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts of at least ``width`` characters, one after the other, and how many each has."""
    sizes = np.array([len(t) for t in texts])
    h = rolled(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64), width)
    whole = np.ones(int(sizes.sum()), bool)  # but shingles that would run into the next text
    ends = np.cumsum(sizes)
    for k in range(1, width):
        whole[ends - k] = False
    return h[whole[: len(h)]], sizes - width + 1


def _buckets(texts: list[str], width: int, bands: int, rows: int) -> np.ndarray:
    """Names of the buckets of each text, one a band."""
    long = np.array([len(t) >= width for t in texts])
    sig = np.empty((len(texts), bands * rows), np.uint32)
    if long.any():
        sig[long] = short_signatures(*_hashes([t for t, ok in zip(texts, long, strict=True) if ok], width), bands * rows)
    if not long.all():
        hashes = [shingles(t, width) for t, ok in zip(texts, long, strict=True) if not ok]
        sig[~long] = short_signatures(np.concatenate(hashes), np.array([len(x) for x in hashes]), bands * rows)
    out = np.empty((len(texts), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(texts), b, np.uint64)
        for r in range(rows):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + r])
        out[:, b] = h
    return out


def close(xs: list[str], ys: list[str], width: int, similarity: float) -> np.ndarray:
    """Whether the shingle sets of each two texts have at least ``similarity``; up to 1024 pairs. Texts under ``width``
    have one shingle, which different texts don't share. A pair's shingles are compared by 54 bits of their hashes."""
    out = np.zeros(len(xs), bool)
    some = np.flatnonzero([min(len(x), len(y)) >= width for x, y in zip(xs, ys, strict=True)])
    if not len(some):
        return out
    sides = []
    for texts in (xs, ys):
        h, n = _hashes([texts[i] for i in some], width)
        sides.append(distinct(np.repeat(np.arange(len(some), dtype=np.uint64), n) << np.uint64(54) | h >> np.uint64(10)))
    count = lambda x: np.bincount((x >> np.uint64(54)).astype(np.int64), minlength=len(some))
    x, y, both = count(sides[0]), count(sides[1]), count(np.intersect1d(*sides, assume_unique=True))
    out[some] = both >= similarity * (x + y - both)
    return out


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges (a, b) that connect what the pairs of at least ``similarity`` connect: each task thins its own out."""
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("key").alias("b"), F.col("line").alias("y")), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            a, b = thinned(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            xs, ys = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            a, b, at = np.asarray(batch.column("a")), np.asarray(batch.column("b")), 0
            while at < len(xs):
                end, size = at, 0
                while end < len(xs) and (end == at or end - at < 1024 and size < 1 << 18):
                    size += len(xs[end]) + len(ys[end])
                    end += 1
                on = close(xs[at:end], ys[at:end], width, similarity)
                held.append((a[at:end][on], b[at:end][on]))
                count += int(on.sum())
                at = end
            if count > 1 << 20:
                yield flush()
                count = 0
        if held:
            yield flush()

    return both.select("a", "b", "x", "y").mapInArrow(exact, "a long, b long").distinct()


def chosen(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """One line (key, check, line) for each of the distinct ``keys``."""
    return written(lines.join(keys, "key").dropDuplicates(["key"]), "lines")


def _common(texts: list[str], width: int, known: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size of each text's shingle set; and for each text of ``left`` with each of ``right`` the number of shingles that both
    have. Shingles whose texts are all of one component of ``known`` tell nothing of two components and are left out.
    Texts under ``width`` have one shingle. All are sorted as one array by hash and text, with the text in the low bits."""
    lengths = np.array([len(t) for t in texts])
    h, n = np.empty(0, np.uint64), np.ones(len(texts), np.int64)
    long = lengths >= width
    if long.any():
        h, n[long] = _hashes([t for t, ok in zip(texts, long.tolist(), strict=True) if ok], width)
    row = np.repeat(np.flatnonzero(long), n[long])
    if not long.all():
        short = np.flatnonzero(~long)
        h, row = np.concatenate([h, *(shingles(texts[i], width) for i in short.tolist())]), np.concatenate([row, short])
    bits = np.uint64(max(1, len(texts).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    h = distinct((h & ~low) | row.astype(np.uint64))
    row, h = (h & low).astype(np.int64), h >> bits
    sizes = np.bincount(row, minlength=len(texts))
    new = np.concatenate([[True], h[1:] != h[:-1]])
    starts = np.flatnonzero(new)
    of = known[row]
    across = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
    some = np.repeat(across, np.diff(starts, append=len(h)))
    row, column = row[some], np.cumsum(new[some]) - 1
    out, step, count = np.zeros((len(left), len(right)), np.float32), 2048, int(across.sum())
    for start in range(0, count, step):
        s, e = np.searchsorted(column, [start, start + step])
        m = np.zeros((len(texts), min(step, count - start)), np.float32)
        m[row[s:e], column[s:e] - start] = 1
        out += m[left] @ m[right].T
    return sizes, out


def bridges(members: DataFrame, roots: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links (a, b) between the components ``roots`` (node, root) that are missing among the ``members`` (bucket, key) of
    large buckets, by the exact similarity of each two lines: a spanning forest for each pair of blocks. Of buckets with
    the same members, as bands make them, one is compared. ``texts`` has the lines of all members."""
    placed = members.join(roots, F.col("key") == F.col("node"), "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    placed = written(placed, "members")
    marks = [F.bit_xor(F.xxhash64("key", F.lit(k))).alias(f"mark{k}") for k in (1, 2)]
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), *marks).filter("low <> high")
    sizes = written(sizes.groupBy("n", "mark1", "mark2").agg(F.min("bucket").alias("bucket")).select("bucket", "n"), "large")
    open_ = placed.join(sizes.select("bucket"), "bucket")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, ["bucket", "i", "j"]):
            root = np.asarray(t.column("root"))
            names, known = np.unique(root, return_inverse=True)
            if len(names) < 2:
                continue
            x, y = _sides(t)
            if not len(y):
                if t.column("i")[0].as_py() != t.column("j")[0].as_py():
                    continue  # the other block is empty, and this one is compared where i = j
                y = x
            elif not len(x):
                continue
            n, same = _common(t.column("line").to_pylist(), width, known, x, y)
            near = (same >= similarity * (n[x][:, None] + n[y][None, :] - same)) & (known[x][:, None] != known[y][None, :])
            p, q = np.nonzero(near)
            tree = forest(len(names), known[x[p]], known[y[q]])
            if tree:
                a, b = np.array(tree).T
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], ["a", "b"])

    dealt = _dealt(open_.join(texts.select("key", "line"), "key"), "bucket", "key", sizes)
    return dealt.select("bucket", "i", "j", "own", "root", "line").mapInArrow(exact, "a long, b long").distinct()


def _cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines of the given numbers, visible lines before, and lines taken out."""
    out: tuple[list, list, list] = ([], [], [])
    for text, numbers in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
        lines, away = (text or "").split("\n"), set(numbers or ())
        out[0].append("\n".join([x for i, x in enumerate(lines) if i not in away]) if away else text)
        out[1].append(sum(1 for x in lines if x and not x.isspace()))
        out[2].append(len(away))
    return pa.StructArray.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["text", "n_lines", "n_removed"])


def dedup(docs: DataFrame, text: str = "text", width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines that are not their component's first taken out of ``text``, and n_lines, n_removed
    (long): visible lines before, and lines taken out. Columns of ``docs`` of these two names give way."""
    spark, t = docs.sparkSession, F.col(f"`{text}`").cast("string")
    keys = [F.xxhash64("doc_id", t).alias("_row1"), F.xxhash64(t, "doc_id", F.lit(1)).alias("_row2")]
    places = written(listed(docs.select(*keys, "doc_id", t.alias("text"))), "places")
    lines = places.select(F.explode("fresh").alias("f")).select("f.*")
    tied = written(ties(lines, width, bands, rows), "ties")
    pairs, members = tied.filter("b is not null").select("a", "b"), tied.filter("b is null").select("bucket", F.col("a").alias("key"))
    texts = chosen(lines, pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    links = written(verified(pairs, texts, width, similarity), "links")
    roots = written(components(links), "roots")
    if not members.isEmpty():
        crossed = written(bridges(members, roots, texts, width, similarity), "links")
        if not crossed.isEmpty():
            more = components(crossed).select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = written(roots.join(more, "root", "full").select(F.coalesce("node", "root").alias("node"), F.coalesce("top", "root").alias("root")), "roots")
    named = written(roots.join(texts.select("key", "check"), F.col("node") == F.col("key")).select("key", "check", "root"), "named")
    dropped(spark, texts, tied, links)
    at = places.select("doc_id", *_KEYS, F.explode(F.arrays_zip("numbers", "keys", "checks")).alias("l")).select("doc_id", *_KEYS, F.col("l.numbers").alias("line_no"), F.col("l.keys").alias("key"), F.col("l.checks").alias("check"))
    # A component is named by its root and a zero, any other line by the two halves of its hash.
    # A row that repeats id and text has the place of the other one, so it counts in n but is never taken for another line.
    placed = at.join(named, ["key", "check"], "left").select(
        "doc_id", *_KEYS, "line_no", F.coalesce("root", "key").alias("name"), F.when(F.col("root").isNull(), F.col("check")).otherwise(F.lit(0)).alias("more"))
    placed = written(placed, "placed")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", *_KEYS, "line_no")
    firsts = placed.groupBy("name", "more").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("name", "more", "first")
    gone = placed.join(firsts, ["name", "more"]).filter(~place.eqNullSafe(F.col("first"))).groupBy(*_KEYS).agg(F.collect_set("line_no").alias("numbers"))
    gone = gone.select(F.struct(*_KEYS).alias("key"), "numbers")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.struct(*keys).alias("key"))
    cutter = F.arrow_udf(_cut, "struct<text:string,n_lines:long,n_removed:long>")
    cut = whole.join(gone, "key", "left").select("d", cutter(F.col("d").getField(text).cast("string"), F.col("numbers")).alias("c"))
    own = [F.col("c.text").alias(text) if c == text else F.col("d").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return cut.select(*own, "c.n_lines", "c.n_removed")
