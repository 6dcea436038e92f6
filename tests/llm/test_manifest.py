"""The manifest against a plain tree, and its edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sievework.llm import manifest, queries
from tests.duck import same

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def plain(rows):
    """The contract row by row; rows are (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, t, g, s, n in rows:
        groups.setdefault("" if g is None else "=" + g, []).append((d, t, g, s, n))
    trees, order = {}, sorted(groups, key=lambda g: g.encode())
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        trees[g] = levels([leaf(r[0], r[3], r[2], r[4], r[1]) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (d, t, lang, s, n) in enumerate(groups[g]):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) if t is not None else None
            now = leaf(d, s, lang, n, low if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else t)
            proof, own = "", trees[g][0][i]
            for tree, at in ((trees[g], i), (top, k)):
                for nodes in tree[:-1]:
                    run = at // 8 * 8
                    left, right = "".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])
                    proof, now, at = proof + left + right, h(left, now, right), at // 8
            out.append((d, own, trees[g][-1][0], top[-1][0], h(proof), now, now == top[-1][0]))
    return sorted(out, key=repr)


def query(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_dataset_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def some(n, lang="en", start=0, step=1):
    return [(start + step * i, f"Text {i} Ä", lang, f"s{i % 3}", i) for i in range(n)]


@pytest.mark.parametrize("rows", [
    some(1), some(8), some(9), some(64), some(65), some(513), some(5000, step=977) + some(3, "de"),
    [*some(3, None), *some(2, ""), *some(9, "é"), *some(4, "z")],
    [(None, None, None, None, None), (None, "A", None, "x", 1), (None, "A", None, "x", 1), (7, "", "en", None, 0), (7, "B", "en", None, 1), (7, "B", "en", None, 1)],
    [(d, f"T{d}", "en", "s", 1) for d in (-(1 << 63), -1, 0, 1, (1 << 63) - 1, 1 << 40, -(1 << 40))],
    [(1, "Q" * 300_000, "en", "s", 1), (2, "É", "en", "s", 1)],
    [(i, "t", f"l{i:03d}", "s", 1) for i in range(70)],
])
def test_rows_equal_a_plain_tree(spark, rows, tmp_path):
    assert query(spark, rows, tmp_path) == plain(rows)


def test_many_ties_and_many_equal_rows_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "BUCKET", 8)
    monkeypatch.setattr(manifest, "PIECE", 4)
    rows = [(5, f"t{i}", "en", "s", i) for i in range(700)] + [(None, f"t{i}", "en", "s", i) for i in range(40)] + [(9, "same", "en", "s", 1)] * 21
    assert query(spark, rows, tmp_path) == plain(rows)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert query(spark, [], tmp_path) == []
    df = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "x", 6)], "id long, h string, g string, r long")
    got = manifest.prove(df, "id", "g", "h", ["r"])
    assert got.columns == ["id", "h", "r", "subroot", "root", "path"]
    assert [r[0] for r in got.select(manifest.fold(F.col("h"), F.col("path")) == F.col("root")).collect()] == [True, True]
    assert {(r.id, r.r) for r in got.collect()} == {(1, 5), (2, 6)}


def test_a_moved_row_or_field_is_told(spark):
    one = {leaf(1, "ab", None), leaf(1, "a", "b"), leaf("1", "ab", "-"), leaf(None, "ab", 1)}
    assert len(one) == 4
    df = spark.range(1).select(manifest.leaf(F.lit(1), F.lit("ä"), F.lit(None)).alias("x"))
    assert df.first().x == leaf(1, "ä", None)


def test_query_equals_sql(spark):
    same(spark, queries.QUERIES["op13_dataset_manifest"], queries.SQL["op13_dataset_manifest"], "/root/testdata/sf0.001")
