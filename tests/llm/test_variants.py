"""Spelling variants against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter

from sievework.llm import queries, variants
from tests.duck import same


def close(a, b):
    """Whether two different words differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for d, t in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            c = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if c % 31 == 0:
                run = run[: c % len(run)] + run[c % len(run) + 1 :]
            seen[run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 7 and c >= 2}
    out, form = {}, {}
    for w in n:
        others = [x for x in n if abs(len(x) - len(w)) < 2 and x != w and close(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = [w, form[w], w, n[w], len(others), n[best] if form[w] else None]
    for w in out:
        while form[out[w][2]]:
            out[w][2] = form[out[w][2]]
    return sorted(map(tuple, out.values()))


def found(spark, docs):
    df = variants.variants(spark.createDataFrame(docs, "doc_id long, text string"))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_words_equal_brute_force(spark):
    """Few letters and short words: repeats of a letter, edits at both ends, chains of forms, two-byte letters."""
    r = random.Random(5)
    base = ["".join(r.choice("abé") for _ in range(r.randint(7, 13))) for _ in range(30)]
    docs = []
    for d in range(300):
        text = []
        for _ in range(60):
            w = list(base[min(int(r.expovariate(0.3)), 29)])
            for _ in range(r.choice((0, 0, 0, 0, 1, 1, 2))):
                i = r.randrange(len(w) + 1)
                w[i : i + r.choice((0, 1))] = r.choice(("", "a", "b", "é"))
            text.append("".join(w).upper() if r.random() < 0.1 else "".join(w))
        docs.append((d, r.choice((" ", "-", "3")).join(text)))
    want = plain(docs)
    assert sum(x[4] for x in want) > 500 and sum(x[1] is not None for x in want) > 50
    assert sum(x[1] is not None and x[2] != x[1] for x in want) > 0
    assert found(spark, docs) == want


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (None, "Letters LETTERS letters"), (3, "letters " * 20 + "lettars lettars"), (4, "x" * 50_000 + " " + "x" * 50_000), (4, "short ones"), (5, "word7 ×××÷÷÷ÀÀÀ÷"), (5, "word7 ×××÷÷÷ÀÀÀ÷")]
    assert found(spark, docs) == plain(docs)
    assert found(spark, []) == []
    df = spark.createDataFrame([("a", "letters letters", 1, 2)], "doc_id string, text string, word int, n int")
    assert variants.variants(df).count() == 1


def test_query_equals_sql(spark):
    same(spark, queries.QUERIES["op12_spelling_variants"], queries.SQL["op12_spelling_variants"], "/root/testdata/sf0.001")


def test_no_table_is_broadcast(spark, monkeypatch):
    """Sides that look small when compressed were gathered by the driver, which ran out of memory."""
    made, written = [], variants.written
    monkeypatch.setattr(variants, "written", lambda df, name: made.append(df) or written(df, name))
    docs = spark.createDataFrame([(1, "letters " * 30 + "lettars lettars letters")], "doc_id long, text string")
    made.append(variants.variants(docs))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in made]
    assert sum(p.count("SortMergeJoin") for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)
