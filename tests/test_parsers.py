from pyspark.sql import functions as F

from sievework.operators import sample
from sievework.sources import parse

PAGE = """<p><a class="post" href="./12.html">First &amp; best</a> - <span class="b"><a>Jo</a></span> 10/12/2026 08:09:10</p>
<p><a class="post" href="/x/13.html">Stray</a></p><p><a class="post" href="/x/14.html">Re: First</a> <span class="b"><a>JO</a></span> (3 bytes) 10/13/2026 postreply 01:02:03</p>
<p><a class="post" href="/x/15.html">Other</a> <span class="b"><a>Al</a></span></p>"""


def test_board_entries(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "k int, html string")
    got = [(r["k"], r["position"], r["post_id"], r["title"], r["published_at"], r["kind"]) for r in parse.board(pages, "k", "html", "jo").orderBy("k", "position").collect()]
    assert got == [(1, 0, "12", "First & best", "10/12/2026 08:09:10", "post"), (1, 1, "14", "Re: First", "10/13/2026 01:02:03", "reply")]


def test_reply_tree_from_depths(spark):
    rows = [("t", 0, 0, "a"), ("t", 1, 1, "b"), ("t", 2, 1, "c"), ("t", 3, 3, "d"), ("t", 4, 0, "e"), ("u", 0, 2, "f")]
    got = {r["node"]: r["parent"] for r in parse.tree(spark.createDataFrame(rows, "thread string, pos int, depth int, node string"), "thread", "pos", "depth", "node").collect()}
    assert got == {"a": "t", "b": "a", "c": "a", "d": "c", "e": "t", "f": "u"}


def test_passes_equal_a_greedy_walk(spark):
    import hashlib

    rows = [(i, f"a{i * i % 7}", i % 3 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, author string, flag boolean")
    steps = [("flagged", F.col("flag"), 12), ("rest", ~F.col("flag"), 9), ("any", F.lit(True), 20)]
    got = [(r["step"], r["author"], r["id"]) for r in sample.passes(df, "author", "id", steps, 5, "s").collect()]
    order, used, taken, want = sorted(rows, key=lambda r: (hashlib.sha256(f"s|{r[0]}".encode()).hexdigest(), r[0])), {}, set(), []
    for (name, _, n), ok in zip(steps, (lambda r: r[2], lambda r: not r[2], lambda r: True), strict=True):
        k = 0
        for r in order:
            if k < n and ok(r) and r[0] not in taken and used.get(r[1], 0) < 5:
                used[r[1]] = used.get(r[1], 0) + 1
                taken.add(r[0])
                want.append((name, r[1], r[0]))
                k += 1
    assert sorted(got) == sorted(want)


def test_passages_of_any_length(spark):
    from sievework.functions import extract

    docs = [(1, "one two three four five six"), (None, "seven two three four x"), (2, "clean text here"), (2, "one two three four five six"), (3, "a tiny mark"), (4, None)]
    marks = [("two three four",), ("e four five",), ("ny ma",), ("",), (None,)]
    got = [(r["k"], r["text"]) for r in extract.without_passages(spark.createDataFrame(docs, "k int, text string"), spark.createDataFrame(marks, "text string"), "k", "text").collect()]
    assert sorted(got, key=repr) == sorted([(2, "clean text here"), (4, None)], key=repr)


ARTICLE = """<html><head><title>x</title></head><body><h1>Site</h1><div class="blog_title big"><h1>The &amp; title</h1></div><span class="time">2026-3-04 10:00</span>
<div class="articleContent"><p>One<br>two</p><script>bad()</script><div class="share">no <img src="no.png"></div><img data-src="a.png" src="data:x"><img src="/b.png"><img src="/b.png"></div><p>outside</p></body></html>"""


def test_articles(spark):
    url = "https://h.example/myblog/5/202601/9.html"
    rows = [(1, ARTICLE, url), (2, "<h1>only a title</h1>", url), (3, None, None), (4, "<h1>T</h1><article>b</article>", url), (5, "<h1>T</h1><article>b</article> 13/45/2026", "u"), (6, "", url)]
    got = {r["k"]: (r["title"], r["text"], r["day"], r["images"]) for r in parse.articles(spark.createDataFrame(rows, "k int, html string, url string"), "k", "html", "url").collect()}
    nothing = (None, None, None, None)
    assert got == {
        1: ("The & title", "One\ntwo", "2026-03-04", ["https://h.example/myblog/5/202601/a.png", "https://h.example/b.png"]), 2: nothing, 3: nothing, 4: ("T", "b", "2026-01-01", []), 5: ("T", "b", "", []), 6: nothing}


def test_tree_of_odd_rows(spark):
    rows = [("t", 0, None, "a", "old"), ("t", 1, 1, None, None), ("t", 2, 2, "c", ""), (None, 0, 1, "d", "x")]
    made = spark.createDataFrame(rows, "thread string, pos int, depth int, node string, parent string")
    got = {(r["thread"], r["pos"]): r["parent"] for r in parse.tree(made, "thread", "pos", "depth", "node").collect()}
    assert got == {("t", 0): "t", ("t", 1): "a", ("t", 2): None, (None, 0): None}
    assert parse.tree(made.limit(0), "thread", "pos", "depth", "node").count() == 0


def test_tree_of_a_long_thread(spark):
    n = 20_000
    rows = spark.range(n).selectExpr("'t' as thread", "id as pos", "cast(id % 7 as int) as depth", "id as node")
    got = parse.tree(rows, "thread", "pos", "depth", "node")
    assert got.filter("parent != case when depth = 0 then 't' else cast(node - 1 as string) end").count() == 0
    assert got.count() == n


def test_lines_are_appended(spark, tmp_path):
    from sievework.operators import sets

    path = str(tmp_path / "log")
    for i in (1, 2):
        sets.append_lines(spark.createDataFrame([(i, None)], "n int, note string"), path)
    assert sorted(r["n"] for r in spark.read.json(path).collect()) == [1, 2]


def test_digests_of_all_documents(spark, tmp_path):
    """Every document has a digest, whatever its id, also without a source or a number, and five entries with all fields."""
    from sievework.plans.laid import digest_entries

    rows = [(0, "a", 5), (1, None, None), (2, "b", 700), (5, "c", None)]
    spark.createDataFrame(rows, "doc_id long, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = digest_entries(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted([0, 1, 2, 5] * 5)
    of = {r.id_begin: r for r in got if r.doc_id == 5 and r.text != "Re three"}
    assert {k: (r.id_chars, r.published_at, r.body_status, r.body_bytes) for k, r in of.items()} == {
        "5": (1, "2026-01-02 03:04:00", "body_exported", 9), "5r202601020506": (23, "2026-01-02 05:06:00", "body_exported", 11), "5r202601030506": (18, "2026-01-03 05:06:00", "title_only", 0), "95r202601030202": (19, "2026-01-03 02:02:00", "body_missing", 0)}


def test_pages_stay_in_arrow(spark):
    """More pages than become strings at once, in order and with nulls; the batch itself isn't turned into pandas."""
    from pyspark.util import PythonEvalType

    pages = [None if i % 9 == 0 else f"<title>T{i} - s</title><p>one {i}<br>two" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string").coalesce(1).select("i", parse.page_text("h").alias("p"))
    assert [(r.i, r.p.title, r.p.text) for r in df.orderBy("i").collect()] == [(i, *parse.read_page(x)) for i, x in enumerate(pages)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}" in plan
