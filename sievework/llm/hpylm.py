"""LM scoring by a hierarchical Pitman-Yor bigram model with sampled Chinese-restaurant seating.

Every word context is a restaurant; all share one parent, the unigram restaurant, whose own parent is uniform over the
training words and one unknown word. A table of a context restaurant is a customer of the parent. Seating is sampled
by Gibbs sweeps over all pairs at once, and then over all words of the parent: given the parent's predictive
probabilities and the other tables of its restaurant, the number of tables that a dish's customers sit at is drawn
anew. Up to ``EXACT`` customers the draw is from its exact conditional, by generalized Stirling numbers; the customers
beyond are seated in doubling blocks. A pair seen once sits at one table for certain: it takes no part in the sweeps,
and has its probability like every other pair. A draw depends on seed, sweep and dish alone, so neither partitions nor
a task that runs again change a score. Sweeps after ``burn`` are averaged in the predictive probabilities, from which
texts are scored.

Only counts move: tokens are counted by pair where they are read and summed by key. Counts, seating and scoring cover
all training documents. For scoring, the ``heavy`` most frequent words and pairs (a fixed number, hence of bounded
size) go to each task as sorted arrays; whatever a text holds beside them is joined by shuffle, so no word or pair is
left out at any size. A pair seen once is stored only if a held-out text holds it too: a training text's pair that the
table lacks was seen once, and then its context alone tells its probability.

Edge cases: a null text is empty and has only its end; words are told apart by a 64-bit hash; a null id hashes as an
empty one and so always has the same fold; rows are scored one by one, so repeated rows and ids stay apart; with no
training documents all words are unknown; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sievework.llm.near import mixed
from sievework.llm.shared import PACKED, by_part, dropped, freed, packed, parts_of, written

GAP = re.compile(rb"[\x20\x09-\x0D]")
END = -1  # the end of a text, as a word; also the context of a first word
UNKNOWN = 0  # what a word's hash never is
DISCOUNT, STRENGTH, EXACT = 0.75, 2.0, 32
HEAVY_WORDS, HEAVY_PAIRS = 1 << 19, 1 << 20


def held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes end a word, and a random number for each byte, capital letters like small ones."""
    ends = np.isin(np.arange(256), [0x20, *range(9, 14)])
    value = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
    value[65:91] = value[97:123]
    value[ends] = 0
    return ends, value


@lru_cache(1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _pieces(data: bytes, most: int) -> Iterator[bytes]:
    """``data`` cut behind words; a piece is longer than ``most`` only where a word is."""
    at = 0
    while len(data) - at > most:
        cut = GAP.search(data, at + most)
        if cut is None:
            break
        yield data[at : cut.end()]
        at = cut.end()
    yield data[at:]


def coded(texts: list[str | None], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of texts, each with its end, one text after the other; and how many each text has. A word's code is a
    hash of its bytes, worked out from running sums over many words at once."""
    ends, value = _letters()
    words: list[np.ndarray] = []
    texts_of: list[np.ndarray] = []
    held: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        data = np.frombuffer(b" ".join(held) + b" ", np.uint8)
        up, down = _powers(max(20, int(len(data)).bit_length() + 1))
        gap = ends[data]
        first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        last = np.flatnonzero(gap & ~np.concatenate([[True], gap[:-1]]))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * up[: len(data)], out=sums[1:])
        h = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)).view(np.int64)
        h[(h == END) | (h == UNKNOWN)] = 1
        begins = np.cumsum([0] + [len(x) + 1 for x in held[:-1]])
        words.append(h)
        texts_of.append(np.array(owner)[np.searchsorted(begins, first, side="right") - 1])
        held.clear()
        owner.clear()
        size = 0

    for i, text in enumerate(texts):
        for piece in _pieces((text or "").encode(), most):
            held.append(piece)
            owner.append(i)
            size += len(piece) + 1
            if size >= most:
                flush()
    if held:
        flush()
    n = len(texts)
    of = np.concatenate([*texts_of, np.arange(n)]) if texts_of else np.arange(n)
    all_words = np.concatenate([*words, np.full(n, END)]) if words else np.full(n, END)
    return all_words[np.argsort(of, kind="stable")], np.bincount(of, minlength=n)


def pair_code(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = mixed(mixed(context.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64))
    return h.view(np.int64)


def before(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The context of each word; ``starts`` are the places where texts begin."""
    out = np.concatenate([[END], words[:-1]])
    out[starts] = END
    return out


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, held = 0, 0
        for i, n in enumerate(batch.column("text").to_pylist()):
            held += len(n or "")
            if held > size:
                yield batch.slice(at, i + 1 - at)
                at, held = i + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def part_of(code: np.ndarray, parts: int) -> np.ndarray:
    return ((code.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _summed(c: np.ndarray, w: np.ndarray, n: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal pairs as one, by context: counts added, ``held`` where any was."""
    order = np.argsort(pair_code(c, w), kind="stable")
    order = order[np.argsort(c[order], kind="stable")]
    c, w, n, held = c[order], w[order], n[order], held[order]
    new = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])) if len(c) else np.zeros(0, np.int64)
    if not len(new):
        return c, w, n, held
    return c[new], w[new], np.add.reduceat(n, new), np.maximum.reduceat(held, new)


COUNTED = "kind int, context long, word long, n long, part int, arrays array<binary>"
COUNTED_NAMES = ["kind", "context", "word", "n", "part", "arrays"]


class _Box:
    """Numbers on their way to the parts of their keys: packed, a row a part, whenever there are ``most``."""

    def __init__(self, parts: int, most: int = 1 << 18) -> None:
        self.parts, self.most, self.held, self.count = parts, most, [], 0

    def put(self, key: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from self.send(part_of(key, self.parts), *arrays)

    def send(self, part: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((part, *arrays))
        self.count += len(part)
        if self.count > self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            part, *arrays = (np.concatenate(x) for x in zip(*self.held, strict=True))
            order = np.argsort(part, kind="stable")
            yield packed(part[order], [x[order] for x in arrays])
        self.held, self.count = [], 0


def count_pairs(docs: DataFrame, whole: bool = True) -> DataFrame:
    """Pairs of the training documents: those seen once (kind 3) as rows, all of them if ``whole``, else those that a held-out
    document holds too; packed by the part of the context those seen more than once (kind 0: context, word, n); and packed by
    their own part, for every word (kind 1) and every context (kind 2), partial sums of customers and of pairs seen once,
    over all pairs in either case."""
    spark = docs.sparkSession
    parts = parts_of(spark, 2)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, ...]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            c, w, n, held = _summed(*(np.concatenate(x) for x in zip(*rows, strict=True)))
            rows.clear()
            part = part_of(pair_code(c, w), parts)
            order = np.argsort(part, kind="stable")
            part, c, w, n, held = (x[order] for x in (part, c, w, n, held))
            # Contexts go as runs: each once for a part, with its number of pairs.
            new = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (part[1:] != part[:-1])]))
            ends = np.flatnonzero(np.concatenate([part[1:] != part[:-1], [True]])) + 1
            starts = np.concatenate([[0], ends[:-1]])
            first, last = np.searchsorted(new, starts), np.searchsorted(new, ends)
            runs = np.diff(new, append=len(c)).astype(np.int32)
            arrays = [
                [w[s:e].tobytes(), n[s:e].astype(np.int32).tobytes(), held[s:e].tobytes(), c[new[f:l]].tobytes(), runs[f:l].tobytes()]
                for s, e, f, l in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array(arrays, pa.list_(pa.binary()))], ["part", "arrays"])

        for batch in _slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if not texts:
                continue
            words, sizes = coded(texts)
            away = np.repeat(np.array([held_out(d) for d in ids]), sizes)
            rows.append((before(words, np.cumsum(sizes) - sizes), words, (~away).astype(np.int64), away.astype(np.int8)))
            total += len(words)
            if total > 2_000_000:
                yield flush()
                total = 0
        if rows:
            yield flush()

    kept: list[tuple[np.ndarray, ...]] = []
    boxes = [_Box(parts_of(spark, 1)) for _ in range(3)]

    def sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[new], np.add.reduceat(n, new), np.add.reduceat((n == 1).astype(np.int64), new)

    def named(kind: int, packs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in packs:
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, kind, np.int32)), none, none, none, *b.columns], COUNTED_NAMES)

    def reduced(part: int, arrays: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        w, n, held, c, runs = arrays
        kept.append((np.repeat(c, runs), w, n.astype(np.int64), held))
        if len(kept) > 1:
            kept[:] = [tuple(np.concatenate(x) for x in zip(*kept, strict=True))]
        kept[:] = [_summed(*kept[0])]
        if not last:
            return
        c, w, n, held = kept.pop()
        some = np.flatnonzero((n == 1) & ((held > 0) | whole))
        for at in range(0, len(some), 1 << 18):
            i = some[at : at + (1 << 18)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), 3, np.int32)), pa.array(c[i]), pa.array(w[i]), pa.array(n[i]), pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.list_(pa.binary()))], COUNTED_NAMES)
        c, w, n = c[n > 0], w[n > 0], n[n > 0]
        if len(n):
            more = n > 1
            for kind, box, found in zip(range(3), boxes, ((c[more], w[more], n[more]), sums(w, n), sums(c, n)), strict=True):
                yield from named(kind, box.put(found[0], *found))

    def finish() -> Iterator[pa.RecordBatch]:
        for kind, box in enumerate(boxes):
            yield from named(kind, box.flush())

    rows = docs.select("doc_id", "text").mapInArrow(counted, PACKED)
    return by_part(rows, reduced, [np.int64, np.int32, np.int8, np.int64, np.int32], COUNTED, finish=finish)


@lru_cache(2)
def _stirling(discount: float) -> np.ndarray:
    """Logs of generalized Stirling numbers S(c, t), c and t up to ``EXACT``."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0
    for c in range(1, EXACT + 1):
        for t in range(1, c + 1):
            grown = out[c - 1, t] + np.log(c - 1 - discount * t) if c - 1 > discount * t and t < c else -np.inf
            out[c, t] = np.logaddexp(out[c - 1, t - 1], grown)
    return out


def chance(key: np.ndarray, *turn: int) -> np.ndarray:
    """A number from 0 to 1 for each key and turn, the same wherever it is drawn."""
    h = key.view(np.uint64)
    for x in turn:
        h = mixed((h ^ np.uint64(x + 1)) * np.uint64(0x9E3779B97F4A7C15))
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53)


def draw_tables(n: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float, key: np.ndarray, *turn: int) -> np.ndarray:
    """Tables of each dish: ``n`` customers, ``others`` tables in its restaurant beside its own, ``base`` the parent's
    probability of it. Draws depend on ``key`` and ``turn`` alone, not on the rows beside."""
    t = np.ones(len(n), np.int64)
    known = _stirling(discount)
    small, luck = np.minimum(n, EXACT), chance(key, *turn)
    for c in range(2, EXACT + 1):
        some = np.flatnonzero(small == c)
        for part in np.array_split(some, max(1, len(some) // 100_000)):
            k = np.arange(1, c + 1)
            weight = known[c, 1 : c + 1][None, :] + k[None, :] * np.log(base[part])[:, None]
            weight += np.cumsum(np.log(strength + discount * (others[part][:, None] + k[None, :] - 1)), axis=1)
            weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
            t[part] = 1 + (weight < luck[part][:, None] * weight[:, -1:]).sum(axis=1)
    for i in np.flatnonzero(n > EXACT).tolist():
        rng = np.random.Generator(np.random.Philox(key=np.array([int(key[i]) & (1 << 64) - 1, sum((x + 1) << 20 * k for k, x in enumerate(turn))], np.uint64)))
        seated, tables = EXACT, int(t[i])
        while seated < n[i]:
            block = min(seated, int(n[i]) - seated)
            new = (strength + discount * (others[i] + tables)) * base[i]
            tables += int(rng.binomial(block, new / (new + seated - discount * tables)))
            seated += block
        t[i] = tables
    return t


def train(docs: DataFrame, sweeps: int = 4, burn: int = 1, discount: float = DISCOUNT, strength: float = STRENGTH, seed: int = 7, whole: bool = True) -> tuple[DataFrame, DataFrame, dict]:
    """Pairs (context, word, n, excess if ``whole``, ratio) with ``excess`` the averaged part of a pair's probability that its own
    customers give, and ``ratio`` that part against the one of a pair seen once in the same context; words (word, n, p,
    lift, alone): the count, the parent's averaged probability, what the word as a context passes to its parent, and
    the part of a pair seen once in that context (null where it is no context); and totals. A pair seen once sits at one
    table for certain, which counts in its context and in the parent. Without ``whole`` the pairs seen once that no
    held-out document holds are not listed, since ``alone`` says all about them."""
    spark = docs.sparkSession
    parts = parts_of(spark, 1)
    counted = written(count_pairs(docs, whole), "counts")

    def opened(part: int, rows: dict[int, list[list[bytes]]], sent: _Box) -> Iterator[pa.RecordBatch]:
        """The part's words; its contexts with their pairs, one table each; and what each word gets from them."""
        if 1 in rows:
            word, n, ones = _totalled(*_joined(rows[1], 3))
            yield _moved(WORDS, [part], [[word, n, ones, np.zeros_like(n), np.ones_like(n), np.zeros(len(n))]], len(n), int(n.sum()))
        if 2 in rows:
            context, c, ones = _totalled(*_joined(rows[2], 3))
            of, word, n = _joined(rows.get(0, []), 3)
            order = np.lexsort((word, of))
            of, word, n = of[order], word[order], n[order]
            run = np.searchsorted(of, context, side="right") - np.searchsorted(of, context)
            t = np.ones_like(n)
            yield _moved(PAIRS, [part], [[context, c, ones, run, word, n, t, np.zeros_like(n)]])
            yield from sent.put(*_sent(part, word, t))

    seated = written(_worked(counted.filter("kind < 3").select(F.col("kind").alias("side"), "part", "arrays"), opened, SUMS, parts), "seated")
    single = written(counted.filter("kind = 3").select("context", "word", "n"), "pairs")
    dropped(spark, counted)
    distinct, tokens = seated.agg(F.coalesce(F.sum("customers"), F.lit(0)), F.coalesce(F.sum("seats"), F.lit(0))).first()
    uniform = 1.0 / (distinct + 1)

    def parent(words: DataFrame, sums: DataFrame, total: int, sweep: int, last: tuple[float, float]) -> tuple[DataFrame, int, int]:
        """The unigram restaurant, whose customers are the contexts' tables, seated anew: its words, with what their tables
        leave them sent to the parts that named them; all its customers and tables. ``last`` is what the sweep before gave
        to every word alike and by which customers, to add its probabilities where it is kept."""

        def reseated(part: int, rows: dict[int, list[list[bytes]]], sent: _Box) -> Iterator[pa.RecordBatch]:
            word, n, ones, m, t, p = (np.frombuffer(x, k) for x, k in zip(rows[WORDS][0], _WORD, strict=True))
            if sweep - 1 > burn:
                p = p + (m - discount * t + last[0]) / last[1]
            source, named, s = _joined(rows.get(SUMS, []), 3)
            at = np.searchsorted(word, named)
            m = ones + np.bincount(at, s, len(word)).astype(np.int64)
            t = draw_tables(m, total - t, np.full(len(m), uniform), discount, strength, word, seed, sweep, 1)
            yield _moved(WORDS, [part], [[word, n, ones, m, t, p]], int(m.sum()), int(t.sum()))
            yield from sent.send(source, named, (m - discount * t)[at])

        found = written(_worked(words.filter(f"side = {WORDS}").unionByName(sums.filter(f"side = {SUMS}")), reseated, BASES, parts), "parent")
        return found, *found.agg(F.coalesce(F.sum("customers"), F.lit(0)), F.coalesce(F.sum("seats"), F.lit(0))).first()

    def shares(customers: int, total: int) -> tuple[float, float]:
        return (strength + discount * total) * uniform, strength + float(customers)

    words, customers, total = parent(seated, seated, distinct, 0, (0.0, 1.0))
    last, tables = shares(customers, total), seated
    spare: list[float] = []
    for sweep in range(1, sweeps + 1):

        def reseated(part: int, rows: dict[int, list[list[bytes]]], sent: _Box, sweep: int = sweep, last: tuple[float, float] = last) -> Iterator[pa.RecordBatch]:
            context, c, ones, run, word, n, t, seen = (np.frombuffer(x, np.int64) for x in rows[PAIRS][0])
            if not len(word):
                yield _moved(PAIRS, [part], [[context, c, ones, run, word, n, t, seen]])
                return
            named, left = (np.frombuffer(b"".join(x[i] for x in rows[BASES]), k) for i, k in enumerate((np.int64, np.float64)))
            order = np.argsort(named)
            base = ((left[order] + last[0]) / last[1])[np.searchsorted(named[order], word)]
            of = np.repeat(np.arange(len(context)), run)
            seats = (ones + np.bincount(of, t, len(context)).astype(np.int64))[of]
            t = draw_tables(n, seats - t, base, discount, strength, pair_code(context[of], word), seed, sweep, 0)
            yield _moved(PAIRS, [part], [[context, c, ones, run, word, n, t, seen + t * (sweep > burn)]])
            yield from sent.put(*_sent(part, word, t))

        old, tables = tables, written(_worked(tables.filter(f"side = {PAIRS}").unionByName(words.filter(f"side = {BASES}")), reseated, SUMS, parts), "tables")
        dropped(spark, old)
        old, (words, customers, total) = words, parent(words, tables, total, sweep, last)
        dropped(spark, old)
        last = shares(customers, total)
        if sweep > burn:
            spare.append(last[0] / last[1])
    kept = len(spare)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _states(batches):
            context, c, ones, run, _, _, _, seen = (np.frombuffer(a, np.int64) for a in x)
            t = np.bincount(np.repeat(np.arange(len(context)), run), seen / kept, len(context))
            for i in _steps(len(context)):
                yield pa.RecordBatch.from_arrays([pa.array(a[i]) for a in (context, (strength + discount * (t + ones)) / (strength + c), (1 - discount) / (strength + c))], ["word", "lift", "alone"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _states(batches):
            context, c, _, run, word, n, _, seen = (np.frombuffer(a, np.int64) for a in x)
            own = n - discount * seen / kept
            for i in _steps(len(word)):
                of = np.repeat(np.arange(len(context)), run)[i]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in (context[of], word[i], n[i], own[i] / (strength + c[of]), own[i] / (1 - discount))], ["context", "word", "n", "excess", "ratio"])

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _states(batches):
            word, n, _, m, t, p = (np.frombuffer(a, k) for a, k in zip(x, _WORD, strict=True))
            p = (p + (m - discount * t + last[0]) / last[1]) / kept
            for i in _steps(len(word)):
                yield pa.RecordBatch.from_arrays([pa.array(a[i]) for a in (word, n, p)], ["word", "n", "p"])

    state = tables.filter(f"side = {PAIRS}").select("arrays")
    lift = state.mapInArrow(contexts, "word long, lift double, alone double")
    model = written(words.filter(f"side = {WORDS}").select("arrays").mapInArrow(parents, "word long, n long, p double").join(lift, "word", "left"), "words-model")
    full, once = state.mapInArrow(listed, "context long, word long, n long, excess double, ratio double"), single.withColumn("ratio", F.lit(1.0))
    if whole:
        once = once.join(model.select(F.col("word").alias("context"), F.col("alone").alias("excess")), "context")
    else:
        full = full.drop("excess")
    full = written(full.unionByName(once), "pairs-model")
    dropped(spark, single, tables, words)
    return full, model, {"tokens": tokens, "distinct": distinct, "unseen": sum(spare) / kept}


#: What the rows of a sweep hold: words with n, pairs seen once, customers, tables and the sum of p; what they get from a
#: part (the part, word, tables); contexts (customers, pairs seen once, pairs) with their pairs (word, n, tables, and their
#: sum over the kept sweeps); and what a word's own customers leave it in the parent, sent to a part that has it.
WORDS, SUMS, PAIRS, BASES = 10, 11, 12, 13
MOVED = "side int, part int, arrays array<binary>, customers long, seats long"
_WORD = [np.int64] * 5 + [np.float64]


def _joined(rows: list[list[bytes]], n: int) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x[i] for x in rows), np.int64) for i in range(n)]


def _totalled(key: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new], *(np.add.reduceat(x[order], new) for x in counts)


def _sent(part: int, word: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words, as keys; and the part that names them, the words, and how many tables they have in it."""
    if not len(word):
        return word, word, word, t
    word, s = _totalled(word, t)
    return word, np.full(len(word), part, np.int64), word, s


def _moved(side: int, part: list[int], arrays: list[list[np.ndarray]], customers: int | None = None, seats: int | None = None) -> pa.RecordBatch:
    rows = pa.array([[x.tobytes() for x in a] for a in arrays], pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([side], pa.int32()), pa.array(part, pa.int32()), rows, pa.array([customers], pa.int64()), pa.array([seats], pa.int64())], ["side", "part", "arrays", "customers", "seats"])


def _worked(rows: DataFrame, work, side: int, parts: int) -> DataFrame:
    """``work`` on each part with its rows by side, and a box whose numbers go out as rows of ``side``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, box = None, {}, _Box(parts)

        def labelled() -> Iterator[pa.RecordBatch]:
            for b in work(now, held, box):
                yield from out(b)

        def out(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if "side" in b.schema.names:
                yield b
            else:
                none = pa.nulls(b.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, side, np.int32)), *b.columns, none, none], ["side", "part", "arrays", "customers", "seats"])

        for batch in batches:
            column = batch.column("arrays")
            for i, (p, kind) in enumerate(zip(batch.column("part").to_pylist(), batch.column("side").to_pylist(), strict=True)):
                if p != now and held:
                    yield from labelled()
                    held = {}
                now = p
                held.setdefault(kind, []).append(column[i].as_py())
        if held:
            yield from labelled()
        for b in box.flush():
            yield from out(b)

    return rows.select("side", "part", "arrays").repartition("part").sortWithinPartitions("part").mapInArrow(run, MOVED)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for b in batches:
        for x in b.column("arrays"):
            yield x.as_py()


def _steps(n: int, size: int = 1 << 18) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, at + size)


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows with the highest ``n``, at most ``most``: those above a count that a histogram of a few thousand bins tells, so
    that nothing is sorted in one task."""
    bins = table.groupBy(F.floor(F.log2("n") * 32).alias("bin")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    least, total = None, 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        total += b["rows"]
        if total > most:
            break
        least = b["least"]
    return table.filter(F.col("n") >= least) if least is not None else table.limit(0)


def _keys(ids: list, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 96-bit name of each row, by id and text: the same wherever it is worked out."""
    made = b"".join(hashlib.blake2b(repr((d, t is None)).encode() + (t or "").encode(), digest_size=12).digest() for d, t in zip(ids, texts, strict=True))
    both = np.frombuffer(made, np.dtype([("a", "<i8"), ("b", "<i4")]))
    return both["a"].copy(), both["b"].copy()


def _lookups(parts: int, code: np.ndarray, odds: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[list[int], list[list[bytes]]]:
    """Tokens whose pair is looked up, by part of the pair; in a part a row's name stands once, with its number of tokens."""
    part = part_of(code, parts)
    order = np.lexsort((k2, k1, part))
    part, code, odds, k1, k2 = (x[order] for x in (part, code, odds, k1, k2))
    new = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (part[1:] != part[:-1])]))
    ends = np.flatnonzero(np.concatenate([part[1:] != part[:-1], [True]])) + 1
    starts = np.concatenate([[0], ends[:-1]])
    first, last = np.searchsorted(new, starts), np.searchsorted(new, ends)
    runs = np.diff(new, append=len(code)).astype(np.int32)
    arrays = [
        [code[s:e].tobytes(), odds[s:e].astype(np.float32).tobytes(), k1[new[f:l]].tobytes(), k2[new[f:l]].tobytes(), runs[f:l].tobytes()]
        for s, e, f, l in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist(), strict=True)]
    return part[starts].tolist(), arrays


def score(docs: DataFrame, text: str = "text", heavy_words: int = HEAVY_WORDS, heavy_pairs: int = HEAVY_PAIRS, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per row of ``docs``.

    A token's probability is ``alone * (ratio + odds)``: ``alone`` is what a pair seen once has in its context, ``odds`` what
    the parent gives against that. Texts are read once for frequent words, and again for the others where there are any: tokens go to their pair's
    part with code and odds only. A pair of a training document that the model doesn't list was seen once, so its ratio
    is 1; for a held-out document it is 0."""
    spark = docs.sparkSession
    parts = parts_of(spark, 2)
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text"))
    pairs, words, totals = train(rows, whole=False, **options)
    top_words = _frequent(words, heavy_words).select("word", "n", "p", F.coalesce("lift", F.lit(1.0)).alias("lift"), F.coalesce("alone", F.lit(0.0)).alias("alone")).toArrow()
    all_words = totals["distinct"] <= heavy_words
    top_pairs = _frequent(pairs, heavy_pairs).select("context", "word", "ratio").toArrow()
    code = pair_code(np.asarray(top_pairs.column("context")), np.asarray(top_pairs.column("word")))
    order, worder = np.argsort(code), np.argsort(np.asarray(top_words.column("word")))
    shared = spark.sparkContext.broadcast((
        code[order], np.asarray(top_pairs.column("ratio"))[order],
        *(np.asarray(top_words.column(k))[worder] for k in ("word", "n", "p", "lift", "alone")),
    ))
    n_total, v, unseen = totals["tokens"], totals["distinct"], totals["unseen"]
    base_log = float(np.log10(n_total + 0.1 * (v + 1)))
    kind = docs.schema["doc_id"].dataType
    kind_arrow = to_arrow_type(kind)

    def find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, x), max(0, len(table) - 1))
        return at, (table[at] == x) if len(table) else np.zeros(len(x), bool)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Per slice: ids, fold, codes of words with their contexts, sizes, text of each token, names."""
        for batch in _slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if texts:
                w, sizes = coded(texts)
                yield batch.column("doc_id"), np.array([held_out(d) for d in ids]), before(w, np.cumsum(sizes) - sizes), w, sizes, np.repeat(np.arange(len(texts)), sizes), _keys(ids, texts)

    names = ["part", "side", "arrays", "k1", "k2", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    fields = f"part int, side int, arrays array<binary>, k1 long, k2 int, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def chunk(side: int, part: list[int], arrays: list[list[bytes]]) -> pa.RecordBatch:
        nothing = [pa.nulls(len(part), t) for t in (pa.int64(), pa.int32(), kind_arrow, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([side] * len(part), pa.int32()), pa.array(arrays, pa.list_(pa.binary())), *nothing], names)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ratio, known, n, p, lift, alone = shared.value
        late: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for ids, away, c, w, sizes, doc, (k1, k2) in read(batches):
            wi, w_in = find(known, w)
            ci, c_in = find(known, c)
            both = pair_code(c, w)
            pi, p_in = find(codes, both)
            pick = lambda table, at, have, other: np.where(have, table[at], other) if len(table) else np.full(len(have), other)
            count = pick(n, wi, w_in, 0)
            up = pick(lift, ci, c_in, 1.0) * pick(p, wi, w_in, unseen)
            own = pick(alone, ci, c_in, 0.0)
            # What is known here is settled here: frequent pairs, and words after what is no context of the training texts.
            named = (w_in | all_words) & (c_in | all_words)
            later = named & ~p_in & (own > 0)
            prob = np.log10(pick(ratio, pi, p_in, 0.0) * own + up)
            prob[later] = np.log10(own[later])
            total = lambda x: np.bincount(doc[named], x[named], len(sizes)).astype(float)
            none = pa.nulls(len(sizes), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([
                pa.array(part_of(k1, parts).astype(np.int32)), pa.array(np.full(len(sizes), 2, np.int32)), none, pa.array(k1), pa.array(k2), ids, pa.array(away), pa.array(sizes.astype(np.int64)),
                pa.array(total((count > 0).astype(float)).astype(np.int64)), pa.array(total(np.log10(count + 0.1) - base_log)), pa.array(total(prob))], names)
            odds = up[later] / own[later]
            of = doc[later]
            late.append((both[later], np.where(away[of], -odds, odds), k1[of], k2[of]))
            waiting += len(of)
            if waiting > 1_000_000:
                yield chunk(1, *_lookups(parts, *(np.concatenate(x) for x in zip(*late, strict=True))))
                late.clear()
                waiting = 0
        if waiting:
            yield chunk(1, *_lookups(parts, *(np.concatenate(x) for x in zip(*late, strict=True))))

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = pair_code(np.asarray(b.column("context")), np.asarray(b.column("word")))
            part = part_of(codes, parts)
            order = np.argsort(part, kind="stable")
            part, codes, ratio = part[order], codes[order], np.asarray(b.column("ratio"))[order]
            ends = np.flatnonzero(np.concatenate([part[1:] != part[:-1], [True]])) + 1 if len(part) else np.zeros(0, np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
            yield chunk(0, part[starts].tolist(), [[codes[s:e].tobytes(), ratio[s:e].tobytes()] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])

    every = rows.mapInArrow(looked_up, fields).unionByName(pairs.select("context", "word", "ratio").mapInArrow(model, fields))
    extra = None
    if not all_words:
        def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value[2]
            for _, away, c, w, _, doc, (k1, k2) in read(batches):
                i = np.flatnonzero(~(find(known, w)[1] & find(known, c)[1]))
                yield pa.RecordBatch.from_arrays([pa.array(k1[doc[i]]), pa.array(k2[doc[i]]), pa.array(away[doc[i]]), pa.array(c[i]), pa.array(w[i])], ["k1", "k2", "away", "context", "word"])

        rest = rows.mapInArrow(beyond, "k1 long, k2 int, away boolean, context long, word long").groupBy("k1", "k2", "away", "context", "word").agg(F.count("*").alias("k"))
        after = words.select(F.col("word").alias("context"), "lift", "alone")
        rest = written(rest.join(words.select("word", "n", "p"), "word", "left").join(after, "context", "left").select(
            "k1", "k2", "away", "context", "word", "k", F.coalesce("n", F.lit(0)).alias("n"), "alone", (F.coalesce("lift", F.lit(1.0)) * F.coalesce("p", F.lit(float(unseen)))).alias("up")), "rest")

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    k1, k2, away, c, w, k, own, up = (b.column(x).to_numpy(zero_copy_only=False) for x in ("k1", "k2", "away", "context", "word", "k", "alone", "up"))
                    odds = np.where(away.astype(bool), -up / own, up / own)
                    yield chunk(1, *_lookups(parts, *(np.repeat(x, k) for x in (pair_code(c, w), odds, k1, k2))))

        every = every.unionByName(rest.filter("alone is not null").mapInArrow(asked, fields))
        extra = rest.groupBy("k1", "k2").agg(
            F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("n_known"), F.sum(F.col("k") * (F.log10(F.col("n") + 0.1) - base_log)).alias("base_score"),
            F.sum(F.col("k") * F.log10(F.coalesce("alone", "up"))).alias("score"))
    dropped(spark, words)
    freed(spark)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, listed, table = None, [], None
        for b in batches:
            columns = [b.column(k) for k in names[3:]]
            docs_here = np.flatnonzero(np.asarray(b.column("side")) == 2)
            if len(docs_here):
                yield pa.RecordBatch.from_arrays([x.take(pa.array(docs_here)) for x in columns], names[3:])
            for part, side, arrays in zip(b.column("part").to_pylist(), b.column("side").to_pylist(), b.column("arrays"), strict=True):
                if part != now:
                    now, listed, table = part, [], None
                if side == 2:
                    continue
                parts_here = arrays.as_py()
                if side == 0:
                    listed.append(parts_here)
                    continue
                if table is None:
                    codes, ratio = (np.concatenate([np.frombuffer(x[i], t) for x in listed] or [np.zeros(0, t)]) for i, t in enumerate((np.int64, np.float64)))
                    order = np.argsort(codes)
                    table, listed = (codes[order], ratio[order]), []
                code, odds, k1, k2, runs = (np.frombuffer(x, t) for x, t in zip(parts_here, (np.int64, np.float32, np.int64, np.int32, np.int32), strict=True))
                at, have = find(table[0], code)
                away = odds < 0
                ratio = np.where(have, table[1][at], np.where(away, 0.0, 1.0)) if len(table[0]) else np.where(away, 0.0, 1.0)
                prob = np.add.reduceat(np.log10(ratio + np.abs(odds).astype(np.float64)), np.cumsum(runs) - runs)
                nothing = [pa.nulls(len(k1), t) for t in (kind_arrow, pa.bool_(), pa.int64(), pa.int64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), *nothing, pa.array(prob)], names[3:])

    sums = every.repartition("part").sortWithinPartitions("part", "side").mapInArrow(matched, fields.partition("arrays array<binary>, ")[2])
    if extra is not None:
        sums = sums.unionByName(extra, allowMissingColumns=True)
    # Rows of equal id and text share their name and so their sums, which are theirs in equal shares.
    found = sums.groupBy("k1", "k2").agg(
        F.count("n_tokens").alias("copies"), F.first("doc_id", True).alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        *(F.sum(k).alias(k) for k in ("n_known", "base_score", "score")))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"), F.lit(n_total).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"))


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, n_tokens, and perplexity by the base and by the model."""
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), *(F.pow(F.lit(10.0), -F.sum(k) / F.sum("n_tokens")).alias(f"{k}_perplexity") for k in ("base_score", "score")))
