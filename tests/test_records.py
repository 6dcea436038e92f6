"""Mixed file drops, whole records, lists in print, and declared revisions."""

import io
import zipfile

from pyspark.sql import functions as F

from sievework.operators import feed, records
from sievework.sources import drop, tables


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_one_bad_file_of_each_kind_neither_fails_nor_vanishes(spark, tmp_path):
    files = {
        "a.md": b"Title: T\n---\nbody", "bad.md": b"\xff\xfe broken", "a.html": b"<title>H</title><p>x</p>", "bad.html": b"\xc3(", "a.json": b'{"a": [1]}', "bad.json": b"{", "empty.json": b"", "a.jsonl": b'{"a":1}\n\nbroken\r\n[2]', "bad.jsonl": b"\xff",
        "a.zip": archive({"sub/in.md": "text in zip", "x.bin": "?", "n.zip": b"PK", "__MACOSX/a.md": "no", "sub/.b.md": "no"}), "bad.zip": b"PK\x03\x04 truncated", "empty.zip": archive({}), "noise.exe": b"MZ", "none": b"", "empty.txt": b"",
    }
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for i, (name, data) in enumerate(files.items()):
        (tmp_path / "in" / ("sub" if i % 2 else "") / name).write_bytes(data)
    whole = drop.routed(drop.files(spark, f"{tmp_path}/in"), "{}").withColumn("path", F.regexp_extract("path", "[^/]*$", 0))
    rows = {(x.path, x.member, x.text): (x.kind, x.title, x.reason) for x in whole.collect()}
    assert rows == {
        ("a.md", None, "body"): ("markdown", "T", None), ("bad.md", None, None): ("markdown", None, "not UTF-8"), ("a.html", None, "x"): ("html", "H", None), ("bad.html", None, None): ("html", None, "not UTF-8"),
        ("a.json", None, '{"a": [1]}'): ("json", None, None), ("bad.json", None, "{}"): ("json", None, "malformed JSON"), ("empty.json", None, "{}"): ("json", None, "malformed JSON"),
        ("a.jsonl", None, '{"a":1}'): ("lines", None, None), ("a.jsonl", None, "broken"): ("lines", None, "malformed line"), ("a.jsonl", None, "[2]"): ("lines", None, None), ("bad.jsonl", None, None): ("lines", None, "not UTF-8"),
        ("a.zip", "sub/in.md", "text in zip"): ("markdown", None, None), ("a.zip", "x.bin", None): ("unknown", None, "unknown kind"), ("a.zip", "n.zip", None): ("archive", None, "archive in an archive"),
        ("bad.zip", None, None): ("archive", None, "bad archive: BadZipFile"), ("empty.zip", None, None): ("archive", None, "empty archive"), ("noise.exe", None, None): ("unknown", None, "unknown kind"), ("none", None, None): ("unknown", None, "unknown kind"),
        ("empty.txt", None, ""): ("markdown", None, None),
    }
    good, bad = drop.parted(whole)
    assert {x.path for x in good.collect()} | {x.path for x in bad.collect()} == set(files)
    assert {x.path for x in bad.filter("kind = 'json'").collect()} == {"bad.json", "empty.json"} <= {x.path for x in good.collect()}


def test_lists_in_print(spark):
    cases = [
        ("[]", []), ("[ ]", []), ("['a']", ["a"]), ('["it\'s", \'say "hi"\']', ["it's", 'say "hi"']), (r"['it\'s', 'a\\b']", ["it's", "a\\b"]), ("['a, b', 'c]']", ["a, b", "c]"]), ("[1, None, x y ]", ["1", None, "x y"]), ("['a',]", ["a"]),
        ("['a' 'b']", None), ("[,]", None), ("text", None), ("['a'", None), (None, None), ("", None), ("['" + "x" * 50_000 + "']", ["x" * 50_000]), ("[" + ", ".join(["'q'"] * 5000) + "]", ["q"] * 5000), ("['line\nbreak']", ["line\nbreak"]),
    ]
    got = {x.i: x.l for x in spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string").select("i", tables.coerced_list("c").alias("l")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_declared_revisions(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "x"), (4, "", None), (5, "a", "x")], "id int, title string, url string")
    new = spark.createDataFrame([(1, "b", "y", ["title"]), (2, "b", "x", None), (3, "a", "x", []), (4, "new", "new", None)], "id int, title string, url string, revised array<string>")
    assert sorted(tuple(x) for x in feed.undeclared(old, new, "id", ["title", "url"], "revised").collect()) == [("1", "changed", "url"), ("2", "changed", "title"), ("5", "lost", "")]


def test_records_of_bare_posts(spark):
    df = spark.createDataFrame([("al", None, None, None), ("al", " T ", "今天卖出了部分VGT在117.57，大约占VGT总仓位的4%", "http://x/1#frag"), ("麻你", "T", "今天卖出了部分VGT在117.57，大约占VGT总仓位的4%", "u")], "author string, title string, text string, url string")
    a, b, c = sorted(records.posts(df, "board", "post", "now", "n").collect(), key=lambda x: (x.url != "", x.url == "u", x.url))
    assert (a.title, a.url, a.published_at, a.content_chars, a.images_count, a.symbols, a.claims, a.thread_context, a.themes_hint) == ("", "", "", 0, 0, [], [], None, ["其他研究"])
    assert (b.title, b.url, b.symbols, b.author_actions) == ("T", "http://x/1", ["VGT"], [])
    assert [(x.symbol, x.action_type, x.size_pct) for x in c.author_actions] == [("VGT", "SELL_EXECUTED", 4.0)] and a.id != b.id != c.id
    assert records.posts(df.limit(0), "board", "post", "now", "n").count() == 0
