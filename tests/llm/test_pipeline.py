import corpus_pipeline as cp
from sievework.llm import decontam, jaccard, lines, quality
from sievework.llm.shared import written

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "near_copies", "decontamination", "tokens"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    kept = docs
    for name, stage in cp.STAGES:
        before, kept = kept, written(stage(spark, kept, SF), name)
        if name != "tokens":
            assert kept.columns == columns and kept.count() <= before.count()
        if name == "quality_rules":
            want = {r["doc_id"] for r in quality.score(before).filter("kept").collect()}
            assert {r["doc_id"] for r in kept.collect()} == want
        if name == "line_dedup":
            assert kept.count() == before.count()
            again = lines.dedup(kept)
            assert again.filter("n_removed > 0").count() == 0
        if name == "near_copies":
            sets = {r["doc_id"]: set(jaccard.shingle_set(r["text"]).tolist()) for r in before.collect()}
            left = [r["doc_id"] for r in kept.collect()]
            close = lambda a, b: len(a & b) >= 0.8 * len(a | b) and a and b
            assert not any(close(sets[a], sets[b]) for i, a in enumerate(left) for b in left[:i])
            for d in sets.keys() - set(left):
                assert any(close(sets[d], s) for k, s in sets.items() if k != d)
        if name == "decontamination":
            items = [frozenset(zip(*(w[i:] for i in range(5)), strict=False)) for w in (_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
            for r in before.collect():
                w = _words(r["text"])
                have = set(zip(*(w[i:] for i in range(5)), strict=False))
                leaks = any(len(have & s) >= 0.8 * len(s) for s in items)
                assert leaks == (r["doc_id"] not in {x["doc_id"] for x in kept.select("doc_id").collect()})
    assert kept.count() == before.count() and {"ids", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(kept.columns)
    from pyspark.sql import functions as F

    assert kept.filter(F.sha2("text", 256) != F.col("decoded_sha256")).count() == 0
    assert decontam.WIDTH == 5


def _words(text):
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
