"""Reports in order, seeded draws, and rules that a text of the reference's own form fixes."""

import csv
import json

from pyspark.sql import functions as F

from sievework.functions import learning
from sievework.operators import report, sample


def test_reports_follow_date_and_id(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"2026-01-{1 + i * 13 % 28:02d}", "al", f'T "{i}", x', "u", None if i == 3 else "text\nmore", ["a.png"] if i % 2 else []) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, date string, author string, title string, url string, text string, images array<string>").repartition(5)
    report.written(df, f"{tmp_path}/r")
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] or "", str(r[0])))]
    posts = [json.loads(x)["id"] for f in sorted((tmp_path / "r" / "posts").glob("part-*")) for x in f.read_text().splitlines()]
    assert posts == want
    index = [x for f in sorted((tmp_path / "r" / "index").glob("part-*")) for x in csv.DictReader(f.open(), escapechar="\\")]
    assert [x["title"] for x in index] == [f'T "{i}", x' for i in want] and index[want.index(3)]["chars"] == "0"
    text = "".join(f.read_text() for f in sorted((tmp_path / "r" / "markdown").glob("part-*")))
    assert [int(x.split('"')[1]) for x in text.splitlines() if x.startswith("## ")] == want and text.count("图片链接: a.png") == 100


def test_draws_are_whole_and_repeatable(spark):
    df = spark.createDataFrame([("a", f"u{i % 30}") for i in range(90)] + [("b", "u1"), ("c", "u1"), (None, "u1")], "author string, url string")
    one = sorted(map(tuple, sample.drawn(df, "author", "url", "s", {"a": 10, "b": 3}).collect()))
    assert len(one) == 11 and one == sorted(map(tuple, sample.drawn(df.repartition(3), "author", "url", "s", {"a": 10, "b": 3}).collect()))
    assert sample.drawn(df, "author", "url", "s", 2).count() == 5


def test_first_person_after_a_backslash_or_an_s_but_not_after_a_blank(spark):
    cases = [("我买了", True), ("，我买了", True), ("x 我买了", False), ("\\我买了", True), ("TSLAs我买了", True), ("今天我买了", False)]
    df = spark.createDataFrame([(c, w) for c, w in cases], "c string, w boolean").withColumn("who", learning.attribution(F.lit(""), F.lit(""), F.col("c"))["who"])
    assert all((x.who == "author_action") == x.w for x in df.collect())
