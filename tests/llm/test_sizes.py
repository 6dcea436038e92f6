"""What the work of op3 and op5 may not grow with: rows a word and a part, calls a line."""

import numpy as np

from sievework.llm import hpylm, lines


def test_partial_sums_are_a_row_a_part_not_a_row_a_word(spark):
    """Partial sums of words and contexts went out as a row for each word in each part of the pairs."""
    texts = [" ".join(f"w{(i * 7 + k * k) % 501}" for k in range(60)) for i in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = hpylm.count_pairs(docs).filter("kind in (1, 2)").collect()
    assert 0 < len(found) <= 2 * parts * parts
    got: dict[int, int] = {}
    for r in found:
        if r["kind"] == 1:
            for w, n in zip(np.frombuffer(r["arrays"][0], np.int64).tolist(), np.frombuffer(r["arrays"][1], np.int64).tolist(), strict=True):
                got[w] = got.get(w, 0) + n
    want: dict[int, int] = {}
    for i, t in enumerate(texts):
        if not hpylm.held_out(i):
            for w in hpylm.coded([t])[0].tolist():
                want[w] = want.get(w, 0) + 1
    assert got == want


def test_shingles_of_a_block_are_hashed_in_one_call(monkeypatch):
    """Common shingles between components equal those of plain sets, without a call for each line."""
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcde "), 300))
    texts = [base[k : k + 120] + "xyz" * (k % 4) for k in range(0, 90, 3)] + ["short", "tiny", "abc"]
    known = np.arange(len(texts)) % 4
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} or {t} for t in texts]
    real = lines.shingles
    monkeypatch.setattr(lines, "shingles", lambda t, w: real(t, w) if len(t) < w else 1 / 0)
    left, right = np.arange(0, 20), np.arange(5, len(texts))
    sizes, same = lines._common(texts, 8, known, left, right)
    assert sizes.tolist() == [len(s) for s in sets]
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            if known[x] != known[y]:
                assert same[i, j] == len(sets[x] & sets[y])
