import json

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievework.operators import intake, report
from sievework.sources import tables


def test_json_sources(spark, tmp_path):
    schema = StructType([StructField("id", IntegerType()), StructField("t", StringType())])
    (tmp_path / "a.json").write_text(json.dumps({"version": 1, "records": [{"id": 1, "t": "x"}, {"id": 2}]}, indent=1))
    assert [tuple(r) for r in tables.records(spark, str(tmp_path / "a.json"), schema).collect()] == [(1, "x"), (2, None)]
    assert tables.optional(spark, f"file://{tmp_path}/none.json", schema).count() == 0
    (tmp_path / "b.jsonl").write_text('{"id": 1, "t": "a"}\n\nnot json\n{"id": 1, "t": "b"}\n')
    good, bad = tables.lines(spark, str(tmp_path / "b.jsonl"), schema)
    assert sorted(r["t"] for r in good.collect()) == ["a", "b"] and [r["value"] for r in bad.collect()] == ["not json"]
    seq = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id int, t string, seq int")
    assert tables.latest(seq, "id", "seq").first()["t"] == "b"
    assert tables.harvest(spark, str(tmp_path / "b.jsonl"), '"[ab]"').count() == 2


def test_utterances_and_articles(spark):
    index = spark.createDataFrame([("p1", "Ann", "2026-01-01 10:00", "Old")], "post_id string, author string, time string, title string")
    batch = spark.createDataFrame([("p1", "x", "t", "u", "b", 1), ("p2", "ANN", "2026-01-01 10:00:30", "Old", "b", 2), ("p3", "Bo", "t", "T", "", 3), ("p4", "Bo", "t2", "T", "b", 4), ("p4", "Cy", "t", "U", "b", 5)],
        "post_id string, author string, time string, title string, body string, seq int")
    got = {(r["post_id"], r["seq"]): r["outcome"] for r in intake.new_utterances(batch, index).collect()}
    assert got == {("p1", 1): "duplicate", ("p2", 2): "duplicate", ("p3", 3): "title_only", ("p4", 4): "new", ("p4", 5): "duplicate"}
    stored = spark.createDataFrame([("0" * 64, "http://a/1")], "sha256 string, url string")
    arts = spark.createDataFrame([("HTTP://A/1#x", "t", 1), ("", "t", 2), ("http://a/2", " ", 3), ("http://a/3", "t", 4), ("http://a/4", "t", 5)], "url string, text string, seq int")
    got = {r["seq"]: r["outcome"] for r in intake.article_outcomes(arts, stored).collect()}
    assert got == {1: "duplicate", 2: "no_link", 3: "no_text", 4: "stored", 5: "duplicate"}


def test_cutoff_and_discoveries(spark):
    listing = spark.createDataFrame([(1, "2026-01-05"), (2, "2026-01-03"), (3, "2025-12-30"), (4, "2025-12-01")], "page int, day string")
    assert {r["page"] for r in intake.pages_to_cutoff(listing, "page", "day", "2026-01-01").collect()} == {1, 2, 3}
    d = intake.discoveries({"b": listing.select(F.col("page").alias("k")), "a": listing.limit(1).select(F.col("page").alias("k"))}, "k")
    assert sorted(r["paths"] for r in d.collect())[-1] == "b"


def test_messages_and_digest(spark):
    text = "\n".join(["ab"] * 5 + ["x" * 25])
    got = spark.createDataFrame([(text,)], "t string").select(report.messages(F.col("t"), 10).alias("m")).first()["m"]
    assert got == ["ab\nab\nab", "ab\nab", "x" * 10, "x" * 10, "x" * 5]
    df = spark.createDataFrame([("g", i) for i in range(5)], "g string, i int")
    assert report.digest(df, "g", F.concat(F.lit("row "), "i"), ["i"], 3).first()["text"] == "row 0\nrow 1\nrow 2\n+2 more"


def test_ties_of_acquisitions_go_by_event(spark, tmp_path):
    """Copies of an event under higher ids, which come first in the file."""
    from sievework.plans.claims import best_acquisitions

    ids = [i + 1000 * k for k in (2, 1, 0) for i in (7, 5, 12, 10)]
    rows = [(i, i % 1000 % 2, 1.5) for i in ids]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(map(tuple, best_acquisitions(spark, str(tmp_path)).collect())) == [(0, 10), (1, 5)]
