"""Main text of web pages by template deduction over the pages of a host.

A page's tokens are its block elements and its blocks of text, each told apart by the path of elements above it. A
token's occurrence vector, its count on each page, is kept as its number of pages and the exclusive or of the hashes of
(page, count): two tokens have equal vectors if these agree, and partial results merge in any order, so a host of any
size is spread over all tasks. Tokens of a host with equal vectors form an equivalence class. A class of three tokens
or more that half of the host's pages hold is valid if its tokens come in one order on all these pages and lie in one
gap of the root class (the tokens that each page holds once); valid classes nest into the host's template. Text of the
template isn't content; what is left are its slots. The slot that holds the article is the ``article`` or ``main``
element where a page has one, else the element of the template under which most text of the host's slots lies.
Elements made for something else (menus, forms, notices, comments) are left out by tag, role, class and heading.

Repeated pages of a host count once, so copies of one page don't make its text a template. Hosts with fewer than three
different pages have no template, and their pages are read by their elements alone.

Edge cases: a null or empty page gives an empty text; a null or odd address counts as a host of its own name, the empty
one; broken markup is closed as browsers do, roughly; text without markup is one block; an empty table gives no rows;
other columns pass through, but those called as the output, which are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import written

#: Pages that a template needs, tokens that a class needs, and the share of pages (one in so many) that it's found on.
PAGES, MEMBERS, SHARE = 3, 3, 2
#: Bytes of templates that go to all tasks; more are joined by host, each host dealt out to ``DEALT`` parts.
SENT = 64 << 20
DEALT = 64

# ---- fixed values of HTML and of the words that sites use for parts that aren't the article ----
BLOCKS = frozenset((
    "html", "body", "head", "article", "section", "nav", "aside", "header", "footer", "main", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul",
    "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption",
    "form", "fieldset", "legend", "address", "hr", "center", "details", "summary", "dialog", "menu", "hgroup", "search",
))
VOID = frozenset(("hr",))
UNSEEN = frozenset(("head", "nav", "aside", "footer", "form", "dialog", "menu", "search", "fieldset"))
RAW = "script|style|textarea|title|noscript|iframe|template|svg|math|select|button|object|canvas|video|audio|xmp|noembed|noframes"
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"))
HINTS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead",
    "footer", "sidebar", "aside", "widget", "widgets", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login",
    "social", "share", "sharing", "related", "recommended", "recommendations", "pager", "pagination", "toolbar", "search", "copyright", "comment", "comments", "commentlist", "disqus", "respond", "replies", "discussion",
))
SITE_HEAD = frozenset(("header", "topbar"))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CUE = re.compile(r"\W*(\d+\s+)?(reader )?(comments?|kommentare?|comentarios?|commentaires?|leave a (reply|comment)|related( (articles?|posts?|stories|links|content|reading))?|more (from|stories|articles)\b.*|you (may|might) also like)(\s*\(?\d+\)?)?\W*", re.I)
# ---- end of fixed values ----

TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*>|[^>]*>)|<!\[CDATA\[(.*?)\]\]>|<[!?/][^>]*>|([^<]+|<)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]))""", re.I)
WORD = re.compile(r"[A-Za-z][a-z]*")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
WALLS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",)}

#: Marks of tokens: a text, an element for something else or below one, a main heading.
TEXT, GONE, HEADING = 1, 2, 4


def _h(*parts: str | int) -> int:
    """64-bit signed hash."""
    n = xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)))
    return n - (1 << 64) if n >> 63 else n


class Element:
    """An open element: its place among all elements of the page, its path's hash, and what it is."""

    __slots__ = ("chars", "dropped", "kind", "n", "path", "tag", "up", "whole")

    def __init__(self, n: int, tag: str, path: int, up: Element | None, dropped: str, kind: str) -> None:
        self.n, self.tag, self.path, self.up, self.dropped, self.kind = n, tag, path, up, dropped, kind
        self.chars, self.whole = 0, False


class Block:
    __slots__ = ("at", "link", "text", "token")

    def __init__(self, at: Element, text: str, link: int) -> None:
        self.at, self.text, self.link = at, text, link
        self.token = _h("text", at.path, text)


def _nature(tag: str, attributes: str) -> tuple[str, str, str]:
    """The element's name in paths, why it is left out (unseen or hinted, else empty), and whether it is the article."""
    named, words, role, hidden, kind = [tag], set(), "", False, tag if tag in ("article", "main") else ""
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id"):
            named.append(re.sub(r"\d+", "0", value))
            words.update(w.lower() for w in WORD.findall(value))
            words.update(w.lower() for w in re.findall(r"[A-Za-z]+", value))
        elif key == "role":
            role = value.lower()
        elif key == "itemprop" and value == "articleBody":
            kind = kind or "main"
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            hidden = True
    kind = "main" if role == "main" else "article" if role == "article" and not kind else kind
    if hidden or tag in UNSEEN or role in ROLES:
        return "/".join(named), "unseen", kind
    if tag not in ("html", "body", "main") and (words & HINTS):
        return "/".join(named), "hinted", kind
    return "/".join(named), "site head" if tag == "header" or words & SITE_HEAD and tag not in ("html", "body", "main", "article") else "", kind


def read(source: str | None, memo: dict) -> tuple[list[Element], list[Block]]:
    """Block elements and blocks of text, in page order. ``memo`` remembers what tags say."""
    root = Element(0, "", 0, None, "", "")
    elements, blocks, stack = [root], [], [root]
    text, link_chars, link = [], 0, 0

    def end() -> None:
        nonlocal link_chars
        found = " ".join("".join(text).split())
        if found:
            blocks.append(Block(stack[-1], found, min(link_chars, len(found))))
        text.clear()
        link_chars = 0

    for m in TOKEN.finditer(source or ""):
        plain = m[6] or m[5]
        if plain:
            plain = html.unescape(plain) if "&" in plain and m[6] else plain
            text.append(plain)
            if link:
                link_chars += len(plain)
            continue
        tag = (m[3] or "").lower()
        if tag == "a":
            link = 0 if m[2] else len(stack)
        elif tag == "br":
            text.append(" ")
        if not tag or not (tag in BLOCKS or "-" in tag):
            continue
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    end()
                    del stack[i:]
                    break
        else:
            end()
            closes, walls = CLOSES.get(tag, ("p",)), WALLS.get(tag, ())
            if stack[-1].tag == "p":
                stack.pop()
            if tag in CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in walls:
                        break
                    if stack[i].tag in closes:
                        del stack[i:]
                        break
            up = stack[-1]
            key = (up.path, tag, m[4])
            if key not in memo:
                if len(memo) > 100_000:
                    memo.clear()
                name, why, kind = _nature(tag, m[4])
                memo[key] = _h("tag", up.path, name), why, kind
            path, why, kind = memo[key]
            elements.append(Element(len(elements), tag, path, up, why, kind))
            if tag not in VOID and not m[4].endswith("/>"):
                stack.append(elements[-1])
        if link > len(stack):
            link = 0
    end()
    _settle(elements, blocks)
    return elements, blocks


def _settle(elements: list[Element], blocks: list[Block]) -> None:
    """Hints that cover the article itself don't count, nor does a header inside it."""
    total = 0
    for b in blocks:
        e = b.at
        while e is not None:
            e.chars += len(b.text)
            e = e.up
        total += len(b.text)
    for e in elements:
        if e.kind:
            up = e.up
            while up is not None:
                up.whole = True
                up = up.up
    for e in elements:
        inside = e.up
        while inside is not None and not inside.kind:
            inside = inside.up
        if e.dropped == "site head":
            e.dropped = "" if inside is not None or e.whole or e.chars * 2 > total and e.tag != "header" else "unseen"
        elif e.dropped == "hinted":
            # comments inside comments stay what they are
            above, outer = e.up, False
            while above is not None:
                outer = outer or above.dropped == "hinted"
                above = above.up
            if not outer and not e.kind and (e.whole or e.chars * 3 > total * 2):
                e.dropped = ""


def _dropped(e: Element | None) -> bool:
    while e is not None:
        if e.dropped:
            return True
        e = e.up
    return False


def tokens(source: str | None, memo: dict) -> list[tuple[int, int, int, int, int]]:
    """A page's tokens in the order they first occur: hash, hash of the element above, count, marks and letters outside
    links."""
    elements, blocks = read(source, memo)
    out: dict[int, list[int]] = {}
    at = 0
    for e in elements[1:]:
        while at < len(blocks) and blocks[at].at.n < e.n:
            at = _count(out, blocks, at)
        old = out.get(e.path)
        if old:
            old[1] += 1
        else:
            out[e.path] = [e.up.path, 1, (GONE if _dropped(e) else 0) | (HEADING if e.tag == "h1" else 0), 0]
    while at < len(blocks):
        at = _count(out, blocks, at)
    return [(t, *x) for t, x in out.items()]


def _count(out: dict[int, list[int]], blocks: list[Block], at: int) -> int:
    b = blocks[at]
    old = out.get(b.token)
    if old:
        old[1] += 1
        old[3] += len(b.text) - b.link
    else:
        out[b.token] = [b.at.path, 1, TEXT | (GONE if _dropped(b.at) else 0), len(b.text) - b.link]
    return at + 1


def host(url: Column) -> Column:
    """The address's host in small letters, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


PAGE = "host string, page long, tokens array<struct<t:long,p:long,c:int,f:int,w:int>>"


def _tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict = {}
    kind = pa.list_(pa.struct([("t", pa.int64()), ("p", pa.int64()), ("c", pa.int32()), ("f", pa.int32()), ("w", pa.int32())]))
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            rows = [[dict(zip("tpcfw", x, strict=True)) for x in tokens(s, memo)] for s in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), part.column("page"), pa.array(rows, kind)], ["host", "page", "tokens"])


def _with_hosts(pages: DataFrame, hosts: DataFrame, bytes_of: Column, how: str) -> DataFrame:
    """Pages beside what is known of their host: it goes to all tasks if it is small, else each host is dealt out."""
    size = hosts.agg(F.sum(bytes_of + F.octet_length("host") + 16)).first()[0] or 0
    if size <= SENT:
        return pages.join(F.broadcast(hosts), "host", how)
    copies = hosts.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    plain = [F.col(f"`{c}`") for c, kind in pages.dtypes if kind in ("string", "bigint")]
    deal = F.pmod(F.xxhash64(*plain), F.lit(DEALT)).cast("int")
    return pages.withColumn("_deal", deal).join(copies, ["host", "_deal"], how).drop("_deal")


def _classes(members: list[dict], size: int) -> dict[int, tuple[int, bool]]:
    """Tokens of one host in large and frequent classes: the class, numbered, and whether it is the root class. A text is
    in a class only if the elements above it occur as often on each page, up to one that is in the class."""
    by: dict[tuple[int, int], list[dict]] = {}
    tags = {m["t"]: m for m in members if not m["f"] & TEXT}
    for m in members:
        by.setdefault((m["n"], m["v"]), []).append(m)
    out = {}
    for number, ((n, _), own) in enumerate(sorted(by.items())):
        if len(own) < MEMBERS:
            continue
        ids = {m["t"] for m in own}
        for m in own:
            if m["f"] & TEXT:
                up = tags.get(m["p"])
                while up is not None and up["lo"] == up["hi"] and up["n"] == n and up["t"] not in ids:
                    up = tags.get(up["p"])
                if m["lo"] != m["hi"] or up is None or up["t"] not in ids:
                    continue
            out[m["t"]] = number, n == size and m["lo"] == m["hi"] == 1
    return out


def _per_host(work: Callable[[dict], tuple], schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(r) for r in batch.to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each host, summed within a batch: the least and largest rank and gap of each token of a class (kind 0), and the
    slots' letters under each element with the number of pages that have it, and ``r1`` set for main headings (kind 1)."""
    cache: dict[str, dict] = {}
    for batch in batches:
        sums: dict[tuple, list] = {}
        for r in batch.to_pylist():
            if r["host"] not in cache:
                if len(cache) > 10_000:
                    cache.clear()
                cache[r["host"]] = {c["t"]: (c["k"], c["r"]) for c in r["classes"]}
            classes, ranks, gap = cache[r["host"]], {}, 0
            ups = {x["t"]: x["p"] for x in r["tokens"] if not x["f"] & TEXT}
            headings = {x["t"] for x in r["tokens"] if x["f"] & HEADING}
            under = dict.fromkeys(ups, 0)
            for x in r["tokens"]:
                if (own := classes.get(x["t"])) is not None:
                    k, is_root = own
                    rank = ranks[k] = ranks.get(k, -1) + 1
                    gap += is_root
                    s = sums.setdefault((r["host"], 0, x["t"]), [rank, rank, gap, gap, 0, 0, 0])
                    s[0], s[1], s[2], s[3] = min(s[0], rank), max(s[1], rank), min(s[2], gap), max(s[3], gap)
                if x["f"] & TEXT and not x["f"] & GONE and own is None:
                    e = x["p"]
                    while e in under:
                        under[e] += x["w"]
                        e = ups[e]
            for e, w in under.items():
                s = sums.setdefault((r["host"], 1, e), [0, int(e in headings), 0, 0, 0, 0, ups[e]])
                s[4] += w
                s[5] += 1
        columns = [*zip(*sums, strict=True)] if sums else [[], [], []]
        values = [*zip(*sums.values(), strict=True)] if sums else [[]] * 7
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*columns, *values], kinds, strict=True)], ["host", "kind", "t", "r0", "r1", "g0", "g1", "w", "n", "p"])


def _template(row: dict) -> tuple[str, bytes, int]:
    """The texts of a host's valid classes, and the element that holds its articles (0 if none stands out)."""
    classes = {c["t"]: c["k"] for c in row["classes"]}
    texts = {c["t"] for c in row["classes"] if c["x"]}
    seen = [x for x in row["seen"] if x["kind"] == 0]
    bad = {classes[x["t"]] for x in seen if x["r0"] != x["r1"] and x["t"] in classes}
    # a class whose tokens change places is taken apart: its texts aren't template
    known = sorted(x["t"] for x in seen if x["t"] in texts and classes[x["t"]] not in bad and x["g0"] == x["g1"])
    nodes = {x["t"]: x for x in row["seen"] if x["kind"] == 1}
    below: dict[int, list[dict]] = {}
    for x in nodes.values():
        below.setdefault(x["p"], []).append(x)
    at, chars = 0, sum(x["w"] for x in below.get(0, []))
    while chars and (best := max(below.get(at, []), key=lambda x: (x["w"], x["t"]), default=None)) and best["w"] * 5 >= chars * 3:
        # a lone kind of block, such as a paragraph, is no container; a main heading belongs to the text beside it
        if at and (not below.get(best["t"]) or any(x["r1"] and x["w"] for x in below[at])):
            break
        at, chars = best["t"], best["w"]
    return row["host"], np.array(known, np.int64).tobytes(), at


def templates(pages: DataFrame) -> DataFrame:
    """host, ``template`` (hashes of its texts) and ``content`` (hash of the path of the element with the articles) of
    hosts that have enough pages; ``pages`` has host and html."""
    digest = F.xxhash64("html").alias("page")
    read = pages.filter("html is not null").select("host", digest, "html").mapInArrow(_tokenized, PAGE)
    once = written(read.groupBy("host", "page").agg(F.first("tokens").alias("tokens")), "page-tokens")
    sizes = once.groupBy("host").agg(F.count("*").alias("size")).filter(F.col("size") >= PAGES)
    each = once.select("host", "page", F.explode("tokens").alias("x")).select("host", "page", "x.*")
    counted = each.groupBy("host", "t").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("page", "c")).alias("v"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("p").alias("p"), F.min("f").alias("f"))
    frequent = _with_hosts(counted.filter(F.col("n") >= PAGES), sizes, F.lit(8), "inner").filter(F.col("n") * SHARE >= F.col("size"))
    # at most SHARE times the tokens of an average page
    of_host = frequent.groupBy("host", "size").agg(F.collect_list(F.struct("t", "p", "n", "v", "lo", "hi", "f")).alias("members"))
    found = "array<struct<t:long,k:int,r:boolean,x:boolean>>"

    def classes(r: dict) -> tuple:
        text = {m["t"]: bool(m["f"] & TEXT) for m in r["members"]}
        return r["host"], r["size"], [{"t": t, "k": k, "r": root, "x": text[t]} for t, (k, root) in _classes(r["members"], r["size"]).items()]

    shape = pa.schema([("host", pa.string()), ("size", pa.int64()), ("classes", pa.list_(pa.struct([("t", pa.int64()), ("k", pa.int32()), ("r", pa.bool_()), ("x", pa.bool_())])))])
    known = written(of_host.mapInArrow(_per_host(classes, shape), f"host string, size long, classes {found}"), "page-classes")
    joined = _with_hosts(once, known.select("host", "classes"), F.size("classes") * 16, "inner")
    sums = joined.mapInArrow(_checked, "host string, kind int, t long, r0 long, r1 long, g0 long, g1 long, w long, n long, p long").groupBy("host", "kind", "t").agg(
        F.min("r0").alias("r0"), F.max("r1").alias("r1"), F.min("g0").alias("g0"), F.max("g1").alias("g1"), F.sum("w").alias("w"), F.sum("n").alias("n"), F.min("p").alias("p"))
    kept = _with_hosts(sums, known.select("host", "size"), F.lit(8), "inner").filter((F.col("kind") == 0) | (F.col("n") * SHARE >= F.col("size")))
    seen = kept.groupBy("host").agg(F.collect_list(F.struct("kind", "t", "r0", "r1", "g0", "g1", "w", "p")).alias("seen"))
    shape = pa.schema([("host", pa.string()), ("template", pa.binary()), ("content", pa.int64())])
    return seen.join(known, "host").mapInArrow(_per_host(_template, shape), "host string, template binary, content long")


def main_text(source: str | None, template: frozenset[int], content: int, memo: dict) -> str:
    """Blocks of the article, in page order, one a line."""
    elements, blocks = read(source, memo)
    kept, cut = [], set()
    for b in blocks:
        known = b.token in template
        if (known or b.at.tag in HEADINGS) and len(b.text) < 80 and CUE.fullmatch(b.text):
            # what follows a heading such as "Comments" in the same element belongs to it
            cut.add(b.at.up.n if b.at.chars == len(b.text) and b.at.up is not None else b.at.n)
            continue
        e, gone = b.at, known
        while e is not None and not gone:
            gone = bool(e.dropped) or e.n in cut
            e = e.up
        if not gone:
            kept.append(b)

    def above(b: Block) -> Iterator[Element]:
        e = b.at
        while e is not None:
            yield e
            e = e.up

    for kind in ("article", "main"):
        held: dict[int, list[Block]] = {}
        for b in kept:
            own = [e.n for e in above(b) if e.kind == kind]
            if own and (kind == "main" or len(own) == 1):
                held.setdefault(own[-1], []).append(b)
        if held:
            return "\n".join(b.text for b in max(held.values(), key=lambda bs: (sum(len(b.text) for b in bs), -bs[0].at.n)))
    # without landmarks blocks that are links are menus
    kept = [b for b in kept if b.link * 2 <= len(b.text)]
    own = [b for b in kept if any(e.path == content for e in above(b))] if content else []
    if own:
        return "\n".join(b.text for b in own)
    return "\n".join(b.text for b in _under_most(kept))


def _under_most(kept: list[Block]) -> list[Block]:
    """Blocks under the lowest element that holds three fifths of the text of the one above, down to a lone block or to
    where the main heading is."""
    at = 0
    while True:
        sums: dict[int, int] = {}
        for b in kept:
            chain = [e.n for e in _chain(b.at)]
            if at in chain and chain.index(at):
                child = chain[chain.index(at) - 1]
                sums[child] = sums.get(child, 0) + len(b.text)
        best = max(sums, key=lambda n: (sums[n], -n), default=None)
        inner = [b for b in kept if best is not None and any(e.n == best for e in _chain(b.at))]
        if best is None or sums[best] * 5 < sum(len(b.text) for b in kept) * 3 or (at and (all(b.at.n == best for b in inner) or any(b.at.tag == "h1" and b.at.up.n == at for b in kept))):
            return kept
        at, kept = best, inner


def _chain(e: Element | None) -> list[Element]:
    out = []
    while e is not None:
        out.append(e)
        e = e.up
    return out


def extract(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each, and ``n_chars``, its code points."""
    read = pages.select(F.struct("*").alias("row"), host(F.col(url)).alias("host"), F.col(source).alias("html"))
    known = written(templates(read), "page-templates")
    joined = _with_hosts(read, known, F.length("template"), "left").select("row", "html", "template", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        sets: dict[bytes, frozenset[int]] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = []
                for page, template, content in zip(*(part.column(c).to_pylist() for c in ("html", "template", "content")), strict=True):
                    if (template or b"") not in sets:
                        if len(sets) > 10_000:
                            sets.clear()
                        sets[template or b""] = frozenset(np.frombuffer(template or b"", np.int64).tolist())
                    texts.append(main_text(page, sets[template or b""], content or 0, memo))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["row", "text", "n_chars"])

    schema = read.select("row", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    out = [F.col(f"row.`{c}`") for c in pages.columns if c.lower() not in ("text", "n_chars")]
    return joined.mapInArrow(run, schema).select(*out, "text", "n_chars")
