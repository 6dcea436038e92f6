"""Template deduction: planted sites with and without landmarks, vectors against brute force, and edge cases."""

import html
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievework.llm import queries, template

WORDS = "river stone winter copper lantern harbor meadow thunder velvet orchard marble canyon ember willow falcon glacier".split()


def sentence(r, n=12):
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


def plain_site(r, i, host):
    """No landmark and no telling class: only the template shows what belongs to the site."""
    paragraphs = [sentence(r, r.randint(8, 30)) for _ in range(r.randint(3, 9))]
    title = sentence(r, 5)
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"http://{host}/{i}", f"""<html><head><title>{title}</title></head><body><div class="q1"><div class="q2">The Daily Stone</div><div class="q3">All the news of the river valley since 1901, every day anew.</div></div>
    <div class="q4"><a href="/">Home</a><a href="/b">Sports and leisure</a></div><div class="q5">We store small files on your device to count visits.</div>
    <div class="k"><h1>{title}</h1><div class="b">{body}</div></div><div class="q6"><ul>{"".join(f'<li><a href="/{k}">{sentence(r, 6)}</a></li>' for k in range(r.randint(2, 5)))}</ul></div>
    <div class="q7">Printed by the Stone company. All rights reserved.</div></body></html>""", "\n".join([title, *paragraphs])


def blog_site(r, i, host):
    """Landmarks, an advert and comments inside, entities, open tags."""
    paragraphs = [sentence(r, r.randint(8, 20)) for _ in range(r.randint(2, 6))]
    comments = "".join(f'<li><p>{sentence(r, 20)}</p></li>' for _ in range(r.randint(0, 12)))
    return f"https://{host}/{i}?x=1", f"""<!doctype html><body class="has-sidebar"><header class="site-header"><h1>My blog</h1></header><nav><ul><li>{sentence(r, 2)}<li>{sentence(r, 2)}</ul></nav>
    <div class="cookie-notice">{sentence(r)}</div><div class="wrap sidebar-right"><article><header><h2>Fish &amp; chips &#8212; {i}</h2></header><p>{paragraphs[0]}<p>{'<p>'.join(paragraphs[1:])}
    <div class="ad">{sentence(r)}</div><script>var a = "<p>no</p>"</script></article><aside>{sentence(r)}</aside><form><p>Mail</p><input></form>
    <section id="comments"><h3>{r.randint(1, 9)} Comments</h3><ol>{comments}</ol></section></div><footer>&copy; {sentence(r, 3)}</footer>""", "\n".join([f"Fish & chips — {i}", *paragraphs])


@pytest.fixture(scope="module")
def sites(spark):
    r, rows = random.Random(3), []
    for k, (make, n) in enumerate([(plain_site, 12), (blog_site, 9), (plain_site, 5), (blog_site, 1), (plain_site, 30)]):
        rows += [make(r, i, f"host{k}.example.org") for i in range(n)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return {x.page_id: x.text for x in template.extract(df).collect()}


def test_articles_of_planted_sites(spark, sites):
    got = run(spark, [(u, h) for u, h, _ in sites])
    wrong = [(u, got[i], want) for i, (u, _, want) in enumerate(sites) if got[i] != want]
    assert not wrong, wrong[:2]


def test_hosts_dealt_out_give_the_same(spark, sites, monkeypatch):
    rows = [(u, h) for u, h, _ in sites]
    small = run(spark, rows)
    monkeypatch.setattr(template, "SENT", -1)
    assert run(spark, rows) == small


def test_vectors_equal_brute_force(spark, sites):
    """Tokens agree in (pages, exclusive or) exactly if their counts agree on all pages."""
    vectors = defaultdict(Counter)
    rows = [(u.split("/")[2], h) for u, h, _ in sites]
    memo = {}
    for page, (host, h) in enumerate(rows):
        for t, _, c, _, _ in template.tokens(h, memo):
            vectors[host, t][page] = c
    df = spark.createDataFrame([(h, x) for h, x in rows], "host string, html string").select("host", F.xxhash64("html").alias("page"), "html")
    each = df.mapInArrow(template._tokenized, template.PAGE).select("host", "page", F.explode("tokens").alias("x")).select("host", "page", "x.*")
    got = each.groupBy("host", "t").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("page", "c")).alias("v")).collect()
    assert {(x.host, x.t) for x in got} == set(vectors)
    ours, theirs = defaultdict(set), defaultdict(set)
    for x in got:
        ours[x.host, x.n, x.v].add(x.t)
        theirs[x.host, tuple(sorted(vectors[x.host, x.t].items()))].add(x.t)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_template_holds_constant_texts_and_no_article(spark, sites):
    pages = spark.createDataFrame([("h", h) for u, h, _ in sites if "host4" in u], "host string, html string")
    (row,) = template.templates(pages).collect()
    known = {x.token: x.text for u, h, _ in sites if "host4" in u for x in template.read(h, {})[1] if x.token in set(memoryview(row.template).cast("q"))}
    assert set(known.values()) == {"The Daily Stone", "All the news of the river valley since 1901, every day anew.", "HomeSports and leisure", "We store small files on your device to count visits.", "Printed by the Stone company. All rights reserved."}


def test_copies_of_one_page_are_no_template(spark, sites):
    u, h, want = next(x for x in sites if "host0" in x[0])
    got = run(spark, [("http://copies.example.org/1", sites[12][1])] * 8 + [(u, h)])
    assert {got[i] for i in range(8)} == {sites[12][2]} and got[8]


def test_a_passage_of_many_articles_stays(spark):
    r = random.Random(8)
    rows = [(f"http://a.example.org/{i}", "<body><article><h1>" + sentence(r) + "</h1>" + "".join(f"<p>{sentence(r)}</p>" for _ in range(i % 3 + 1)) + "<p>The passage that all share.</p></article></body>") for i in range(9)]
    assert all(t.endswith("\nThe passage that all share.") for t in run(spark, rows).values())


def test_edge_cases(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(None, None), ("", ""), ("x", "just text &amp; more\n\n here"), ("http://[odd", "<p"), ("http://a/1", "<p>a < b &lt; c</p>"), ("http://a/2", "<article><p title='x > y'>in  side<br>it</article>after"),
            ("http://a/3", "<p>" + "word " * 200_000 + "</p>"), ("http://a/4", "<nav>menu</nav>"), ("http://a/5", "<!-- open"), ("http://a/6", "<script>open"), ("http://a/7", "<article><h1>T</h1><p>x<h2>Comments</h2><p>y</article>"), ("http://b/1", deep), ("http://a/4", "<nav>menu</nav>")]
    got = run(spark, rows)
    assert [got[i] for i in (0, 1, 2, 4, 5, 7, 8, 9, 10, 12)] == ["", "", "just text & more here", "a < b < c", "in side it", "", "", "", "T\nx", ""]
    assert len(got[6]) == 999_999 and got[11] == "deep"
    assert run(spark, []) == {}
    clash = spark.createDataFrame([("u", "<p>a</p>", 1, {"k": 1}, "t", "d")], "url string, html string, host int, row map<string,int>, text string, _deal string")
    out = template.extract(clash)
    assert out.columns == ["url", "html", "host", "row", "_deal", "text", "n_chars"] and tuple(out.first()) == ("u", "<p>a</p>", 1, {"k": 1}, "d", "a", 1)


def test_query_equals_its_plain_form(spark):
    """On the given pages, whose articles are marked, by a pattern over the article element."""
    sf = "/root/testdata/sf0.001"
    for x in queries.op11_html_extraction(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", x.html, re.S)[1].replace("<br>", " ")
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", inner))
        want = "\n".join(p for p in parts if p)
        assert (x.text, x.n_chars) == (want, len(want))
