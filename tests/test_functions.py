import datetime as dt
import math
import random

from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.functions import stats as S
from sievework.functions import text as T
from sievework.operators import feed, recon, sample, state
from sievework.plans.laid import CUES
from sievework.sources import parse


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return row.select(column.alias("r")).first()["r"]


def test_unicode_space_and_keys(spark):
    assert one(spark, T.ustrip(F.col("s")), s="　 a b ") == "a b"
    a = one(spark, T.content_key(F.lit("a"), F.lit(None), F.lit("b")))
    b = one(spark, T.content_key(F.lit("a"), F.lit("b"), F.lit(None)))
    assert a != b and len(a) == 20
    assert one(spark, T.folded_url(F.col("u")), u="HTTP://A.Example/B?C#d") == "http://a.example/B?C"
    assert one(spark, T.video_id(F.col("u")), u="https://youtu.be/abcdefghijk?t=3") == "abcdefghijk"


def test_sentences_and_chunks(spark):
    assert one(spark, T.sentences(F.col("s")), s="First one. Second one!Third one\nab") == ["First one.", "Second one!", "Third one"]
    long = "word, " * 100
    parts = one(spark, T.chunked(F.col("s")), s=long)
    assert all(0 < len(p) <= 160 for p in parts) and "".join(parts).replace(" ", "") == long.replace(" ", "")
    assert one(spark, T.chunked(F.col("s")), s="x" * 400) == ["x" * 160, "x" * 160, "x" * 80]


def test_dates(spark):
    assert one(spark, T.month_of(F.col("s")), s="3/9/2024") == "2024-03"
    assert one(spark, T.month_of(F.col("s")), s="soon") == "unknown"
    assert one(spark, T.free_date(F.col("s")), s="on 2026年1月2日 we") == dt.date(2026, 1, 2)
    assert one(spark, T.free_date(F.col("s")), s="2026-13-77") is None
    ts = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, T.days_between(ts("2026-01-01 23:00:00"), ts("2026-01-02 01:00:00"))) == 0
    assert one(spark, T.days_between(ts("2026-01-02 01:00:00"), ts("2026-01-01 23:00:00"))) == -1
    for hours, kind in ((-5, "near_publication_observed"), (36, "near_publication_observed"), (72, "delayed_capture"), (72.1, "backfill_proven")):
        assert one(spark, T.gap_class(F.lit(hours))) == kind
    assert one(spark, T.when(F.col("s")), s="2026-01-02T03:04:05Z") == one(spark, T.when(F.col("s")), s="2026-01-02 03:04:05")
    assert one(spark, T.when(F.col("s")), s="nothing") is None


def test_statistics(spark):
    low, high = S.wilson(F.lit(21), F.lit(21))
    assert (one(spark, low), one(spark, high)) == (0.845, 1.0)
    assert one(spark, S.wilson(F.lit(0), F.lit(0))[0]) is None
    assert one(spark, S.kappa(F.lit(1.0), F.lit(1.0))) is None and one(spark, S.kappa(F.lit(1.0), F.lit(1.0), 1.0)) == 1.0
    assert one(spark, S.ratio(F.lit(1), F.lit(0))) is None


def test_detect_orders_and_borders(spark):
    got = one(spark, X.detect(F.col("s"), {"alpha works": "AW", "阿": "AA"}, ["ZZ", "BE", "LONG"], cased=("BE",)), s="be long, Alpha Works 阿; zz xBEx")
    assert got == ["AW", "AA", "LONG", "ZZ"]


def test_claims(spark):
    text = "I bought ABC today. If ABC falls I am adding more! What about XYZ? They say he sold XYZ. I won't sell ABC."
    found = X.claims(T.sentences(F.col("s")), lambda s: X.detect(s, {}, ["ABC", "XYZ"]), CUES, skip=r"(?i)\bthey say\b", unless=r"\bI\b")
    got = [(c["symbol"], c["stance"], c["conditional"]) for c in one(spark, found, s=text)]
    assert got == [("ABC", "buy", False), ("ABC", "add", True), ("ABC", "hold", False)]


def test_upsert_is_idempotent_and_append_only(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "id int, title string, signals string")
    new = spark.createDataFrame([(2, "changed", "s", 1), (2, "late", "t", 2), (3, "c", None, 3)], "id int, title string, signals string, seq int")
    once = feed.upsert(base, new, "id", ["signals"])
    assert {tuple(r) for r in once.collect()} == {(1, "a", "x", "kept"), (2, "b", "s", "enriched"), (3, "c", None, "added")}
    twice = feed.upsert(once.drop("outcome"), new, "id", ["signals"])
    assert {tuple(r)[:3] for r in twice.collect()} == {tuple(r)[:3] for r in once.collect()}
    assert {r["outcome"] for r in twice.collect()} == {"kept"}
    assert feed.violations(base, once, "id", ["title"]).count() == 0


def test_counters(spark):
    d = lambda *r: spark.createDataFrame(list(r), "day string, key string, count long, paid boolean")
    got = feed.merge_counters(d(("1", "k", 3, False)), d(("1", "k", 5, True)), d(("1", "k", 4, False), ("0", "k", 9, False)), ["day", "key"], "day", 1)
    assert [tuple(r) for r in got.collect()] == [("1", "k", 6, True)]


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id", "id % 7 as g")
    a = sample.per_stratum(df.repartition(1), ["g"], "s", "id", 0.1)
    b = sample.per_stratum(df.repartition(7), ["g"], "s", "id", 0.1)
    assert recon.same_rows(a, b).count() == 0


def test_capped_greedy_equals_loop(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice("ab"), rnd.choice("xyz")) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, stratum string, author string")
    quotas = spark.createDataFrame([("a", 5), ("b", 6)], "stratum string, quota long")
    got = {r["key"] for r in sample.capped_greedy(df, "stratum", "author", "id", quotas, 3, "s").collect()}
    import hashlib

    used, want = {}, set()
    for s, q in (("a", 5), ("b", 6)):
        n = 0
        for i, _, a in sorted((r for r in rows if r[1] == s), key=lambda r: (hashlib.sha256(f"s|{r[0]}".encode()).hexdigest(), r[0])):
            if n < q and used.get(a, 0) < 3:
                used[a] = used.get(a, 0) + 1
                n += 1
                want.add(i)
    assert got == want


def test_continuity_and_backoff(spark):
    listing = spark.createDataFrame([("b", i, i // 3 + 1) for i in range(12)] + [("n", 1, 1)], "board string, entry int, page int")
    anchors = spark.createDataFrame([("b", 7), ("b", 11)], "board string, entry int")
    got = {r["board"]: (r["anchor_page"], r["scan_pages"], r["complete"]) for r in state.continuity(listing, anchors, "board", "entry", "page", 2).collect()}
    assert got == {"b": (3, 4, False), "n": (None, None, True)}
    assert [one(spark, T.backoff_seconds(F.lit(n))) for n in (0, 3, 9)] == [5, 40, 300]


def test_page_text_and_markdown(spark):
    title, text = parse.read_page("<html><title>A &amp; B - Site</title><nav>no</nav><p>one<br>two</p><script>x</script>")
    assert title == "A & B" and text == "one\ntwo"
    assert parse.read_page(None) == (None, "")
    m = one(spark, parse.markdown_article(F.col("s")), s="# Head\nSource: http://x\nDate: 2026-01-02\n---\nBody\nmore")
    assert (m["title"], m["url"], m["published"], m["body"]) == ("Head", "http://x", "2026-01-02", "Body\nmore")


def test_zip_members(spark):
    import io
    import zipfile

    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n in ("b.md", "a.txt", ".hid.md", "__MACOSX/x.md", "c.exe"):
            z.writestr(n, n)
    df = spark.createDataFrame([("p", b.getvalue())], "path string, content binary")
    assert [r["name"] for r in parse.zip_members(df).collect()] == ["a.txt", "b.md"]
    assert [r["name"] for r in parse.zip_members(df, most_files=1).collect()] == [None]


def test_kappa_multi(spark):
    from sievework.operators.evaluate import kappa_multi

    pairs = [("a", "a")] * 3 + [("a", "b")] * 2 + [("c", "c")]
    got = kappa_multi(spark.createDataFrame(pairs, ["x", "y"]), "x", "y").first()
    o, e = 4 / 6, (5 * 3 + 0 * 2 + 1) / 36
    assert math.isclose(got["kappa"], round((o - e) / (1 - e), 3), abs_tol=1e-3)
