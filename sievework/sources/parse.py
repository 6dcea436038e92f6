"""Parsers of documents that already lie in a table. Nothing here reads a network."""

from __future__ import annotations

import datetime
import html
import io
import posixpath
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievework.functions import text as T

#: Elements whose text nobody reads.
HIDDEN = frozenset(("script", "style", "nav", "header", "footer", "form", "noscript"))


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.titles: dict[str, list[str]] = {"title": [], "h1": []}
        self.hidden: list[str] = []
        self.inside: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden.append(tag)
        elif tag in self.titles and not self.titles[tag]:
            self.inside = tag
        if tag in ("br", "p", "div", "li", "h1", "h2", "h3", "tr"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in self.hidden:
            del self.hidden[self.hidden.index(tag) :]
        if tag == self.inside:
            self.inside = None

    def handle_data(self, data):
        if self.inside:
            self.titles[self.inside].append(data)
        if not self.hidden and self.inside != "title":
            self.parts.append(data)


def read_page(source: str | None) -> tuple[str | None, str]:
    """Title (the title element before " - ", else the first h1) and visible text, blank lines squeezed."""
    p = _Page()
    p.feed(source or "")
    p.close()
    title = "".join(p.titles["title"]).split(" - ")[0].strip() or "".join(p.titles["h1"]).strip()
    lines = (regex.sub(r"[^\S\n]+", " ", x).strip() for x in "".join(p.parts).split("\n"))
    return title or None, regex.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


#: Pages that a worker holds as Python strings at once.
PAGES_AT_ONCE = 64


def page_text(column: str | Column) -> Column:
    """Struct of title and text of an HTML column. A batch stays in Arrow; few of its pages at a time become strings."""

    @F.arrow_udf("title string, text string")
    def read(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in pages:
            for start in range(0, len(batch), PAGES_AT_ONCE):
                found = [read_page(x) for x in batch.slice(start, PAGES_AT_ONCE).to_pylist()]
                yield pa.StructArray.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], ["title", "text"])

    return read(column)


def markdown_article(text: Column) -> Column:
    """Struct of title, url, published and body of a Markdown article whose first lines, up to ``---``, are
    ``name: value``; only the first 12 lines count as a head."""
    lines = F.split(text, "\n")
    bar = F.array_position(F.transform(F.slice(lines, 1, 12), lambda x: F.trim(x)), "---").cast("int")
    head = F.when(bar > 0, F.slice(lines, F.lit(1), bar - 1)).otherwise(F.slice(lines, 1, 12))
    field = lambda names: F.get(F.filter(F.transform(head, lambda x: F.trim(F.regexp_extract(x, rf"(?i)^(?:[-*>#\s]*)(?:{names})\s*[:：]\s*(.+)$", 1))), lambda x: x != ""), F.lit(0))
    heading = F.get(F.filter(F.transform(head, lambda x: F.regexp_extract(x, r"^#\s+(.+)$", 1)), lambda x: x != ""), F.lit(0))
    body = F.when(bar > 0, F.array_join(F.slice(lines, bar + 1, F.size(lines)), "\n")).otherwise(text)
    return F.struct(F.coalesce(field("title"), heading).alias("title"), field("url|source").alias("url"), field("date|published").alias("published"), F.trim(body).alias("body"))


def zip_members(files: DataFrame, content: str = "content", suffixes: tuple[str, ...] = (".md", ".txt", ".html", ".jsonl"), most_files: int = 300, most_bytes: int = 30 << 20) -> DataFrame:
    """(path, name, text) of the members of zip archives with a listed suffix; hidden files are left out. An archive
    beyond a limit gives one row with a null name, so it is seen and not silently cut."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, data in zip(batch["path"], batch[content], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    infos = [i for i in z.infolist() if not i.is_dir() and i.filename.lower().endswith(suffixes) and not i.filename.startswith("__MACOSX") and not posixpath.basename(i.filename).startswith(".")]
                    if len(infos) > most_files or sum(i.file_size for i in infos) > most_bytes:
                        rows.append((path, None, None))
                        continue
                    rows += [(path, i.filename, z.read(i).decode("utf-8", "replace")) for i in sorted(infos, key=lambda i: i.filename)]
            yield pd.DataFrame(rows, columns=["path", "name", "text"])

    return files.select("path", content).mapInPandas(unpack, "path string, name string, text string")


def clean_text(column: str | Column) -> Column:
    """Fetched text: character references read, carriage returns as line feeds, blanks squeezed, two line feeds at most in
    a row, no white space around. Null stays null."""
    column = F.col(column) if isinstance(column, str) else column

    @F.pandas_udf("string")
    def unescaped(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if x is None else html.unescape(x) for x in batch], dtype=object)

    # only texts with a reference leave the engine
    plain = F.when(F.contains(column, F.lit("&")), unescaped(column)).otherwise(column)
    return T.ustrip(F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, "\r", "\n"), r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def page_state(page: Column, link: str, trace: str) -> Column:
    """What a listing page that came with status 200 is worth: ``links`` if it has any, ``empty`` if it has none but shows a
    trace of what it should list, else ``unrecognised``: a changed layout or an error page isn't zero new articles."""
    source = F.coalesce(page, F.lit(""))
    return F.when(source.rlike(link), "links").when(source.rlike(trace), "empty").otherwise("unrecognised")


def list_entries(source: str, link: str = r'<a[^>]+href="([^"]+)"[^>]*>([^<]*)</a>') -> list[tuple[str, str]]:
    """(href, text) of the links of a listing page, in order, each href without its fragment once."""
    seen: dict[str, str] = {}
    for href, label in regex.findall(link, source or ""):
        seen.setdefault(html.unescape(href).split("#")[0], html.unescape(label).strip())
    return list(seen.items())


def links(pages: DataFrame, key: str, column: str) -> DataFrame:
    """(key, position, href, label): one row per link of a listing page."""

    @F.pandas_udf("array<struct<href:string,label:string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: [{"href": h, "label": t} for h, t in list_entries(x)])

    return pages.select(key, F.posexplode(find(column)).alias("position", "l")).select(key, "position", "l.href", "l.label")


def atom_entries(text: Column) -> Column:
    """Array of (video_id, published, updated, title) of the entries of an Atom text that have a video id."""
    field = lambda x, tag: F.regexp_extract(x, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    entries = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?s)<entry>(.*?)</entry>"), F.lit(1))
    made = F.transform(entries, lambda x: F.struct(field(x, "yt:videoId").alias("video_id"), field(x, "published").alias("published"), field(x, "updated").alias("updated"), field(x, "title").alias("title")))
    return F.filter(made, lambda e: e["video_id"] != "")


_TAG = regex.compile(r"<[^>]+>")


def _plain(source: str) -> str:
    return regex.sub(r"\s+", " ", html.unescape(_TAG.sub(" ", source))).strip()


def board_entries(source: str | None, author: str) -> list[dict]:
    """Entries of a board's list page by one author: post id, link, title, time and whether it is a reply. An entry's
    author tag stands between its link and the next one; without one it isn't anybody's."""
    links = list(regex.finditer(r'<a\b[^>]*class="[^"]*\bpost\b[^"]*"[^>]*>(.*?)</a>', source or "", regex.S))
    out = []
    for link, after in zip(links, [*links[1:], None], strict=False):
        rest = source[link.end() : after.start() if after else len(source)]
        who = regex.search(r'<span\b[^>]*class="[^"]*\bb\b[^"]*"[^>]*>\s*<a\b[^>]*>(.*?)</a>', rest, regex.S)
        href = regex.search(r'href="([^"]*)"', link[0])
        number = regex.search(r"(\d+)\.html", href[1]) if href else None
        if not who or not number or _plain(who[1]).casefold() != author.casefold():
            continue
        time = regex.search(r"(\d{2}/\d{2}/\d{4})\s*(postreply)?\s*(\d{2}:\d{2}:\d{2})", _plain(rest), regex.I)
        out.append({
            "post_id": number[1], "href": html.unescape(href[1]), "title": _plain(link[1]), "published_at": f"{time[1]} {time[3]}" if time else "",
            "kind": "reply" if time and time[2] else "post"})
    return out


def board(pages: DataFrame, key: str, column: str, author: str) -> DataFrame:
    """One row per entry of an author on list pages."""

    @F.pandas_udf("array<struct<post_id:string,href:string,title:string,published_at:string,kind:string>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: board_entries(x, author))

    return pages.select(key, F.posexplode(read(column)).alias("position", "e")).select(key, "position", "e.*")


def tree(replies: DataFrame, thread: str, position: str, depth: str, node: str) -> DataFrame:
    """``replies`` with ``parent``: the last node before that lies one level higher, or, where levels are skipped, at any
    higher level; the thread itself for the others. Threads are sorted and walked row by row; what is held is one path,
    as long as a thread is deep, so a thread of any length does. A null depth counts as 0; a ``parent`` that is there is
    replaced."""
    replies = replies.drop("parent")
    out = StructType([*replies.schema.fields, StructField("parent", StringType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, path = None, []
        for batch in batches:
            parents = []
            for t, d, n in zip(*(batch.column(c).to_pylist() for c in (thread, depth, node)), strict=True):
                d = 0 if d is None else d
                if (t,) != now:
                    now, path = (t,), []
                while path and path[-1][0] >= d:
                    path.pop()
                above = path[-1][1] if path else t
                parents.append(None if above is None else str(above))
                path.append((d, n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parents, pa.string())], [*batch.schema.names, "parent"])

    return replies.repartition(thread).sortWithinPartitions(thread, position).mapInArrow(walk, out)


#: Where an article's title, body and time stand, the first that is there; (tag, attribute, value), null for any,
#: and the class or element that it stands in.
TITLE_AT = (
    (None, "id", "titleName"), (None, "class", "titleName"), ("h1", "class", "article-title"),
    ("h1", None, None, ".blog_title"), ("h1", None, None, "article"), ("h1", None, None))
BODY_AT = (
    (None, "id", "articalContent"), (None, "id", "articleContent"), (None, "class", "articalContent"), (None, "class", "articleContent"),
    (None, "class", "article-content"), (None, "class", "blog_content"), ("article", None, None))
TIME_AT = ((None, "id", "time"), (None, "class", "time"), (None, "class", "blog_time"), (None, "class", "article-time"), ("time", None, None))
#: Elements without an end, and classes whose text is no part of an article.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
ASIDE = frozenset(("share", "ad", "adsbygoogle"))


class _Article(HTMLParser):
    """Text and images of the first element at each of the wanted places, and the beginning of the whole text."""

    def __init__(self, places) -> None:
        super().__init__(convert_charrefs=True)
        self.places = places
        self.open: list[tuple[str, bool, list, set]] = []
        self.text: dict = {}
        self.images: dict = {}
        self.all: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        names = a.get("class", "").split()
        hidden = tag in ("script", "style", "noscript") or bool(ASIDE & set(names))
        if tag == "img":
            source = a.get("data-src") or a.get("data-original") or a.get("src")
            if source and not source.startswith("data:") and not any(x[1] for x in self.open):
                for place in self._inside():
                    self.images[place].append(source)
        elif tag == "br":
            self.handle_data("\n")
        if tag in VOID:
            return
        around = set().union(*(x[3] for x in self.open))
        has = {"id": [a.get("id")], "class": names}
        at = [p for p in self.places if p not in self.text and (p[0] or tag) == tag and (p[1] is None or p[2] in has[p[1]]) and around.issuperset(p[3:])]
        for place in at:
            self.text[place], self.images[place] = [], []
        self.open.append((tag, hidden, at, {tag, *("." + n for n in names)}))

    def _inside(self):
        return [p for x in self.open for p in x[2]]

    def handle_endtag(self, tag):
        if any(x[0] == tag for x in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(x[1] for x in self.open):
            self.all.append(data)
            for place in self._inside():
                self.text[place].append(data)


def _dated(text: str) -> str | None:
    for pattern, order in ((r"(20\d{2})[-年/](\d{1,2})[-月/](\d{1,2})", (0, 1, 2)), (r"(\d{1,2})/(\d{1,2})/(20\d{2})", (2, 0, 1))):
        found = regex.search(pattern, text)
        if found:
            try:
                return datetime.date(*(int(found.groups()[i]) for i in order)).isoformat()
            except ValueError:
                continue
    return None


def read_article(source: str | None, url: str | None) -> dict | None:
    """Title, text, images and day of an article page, or null without a title or a body. The day is that of the time
    element, of the page's first 2,500 characters or of the URL, else the first of the month that the URL names."""
    p = _Article((*TITLE_AT, *BODY_AT, *TIME_AT))
    p.feed(source or "")
    p.close()
    url = url or ""
    title, body, time = (next((x for x in at if x in p.text), None) for at in (TITLE_AT, BODY_AT, TIME_AT))
    if title is None or body is None:
        return None
    lines = [x.strip() for x in "\n".join(p.text[body]).split("\n")]
    whole = regex.sub(r"\s+", " ", " ".join(x.strip() for x in p.all if x.strip()))
    month = regex.search(r"/(20\d{2})(0[1-9]|1[0-2])/", url)
    day = _dated(" ".join(["".join(p.text.get(time, [])), whole[:2500], url])) or (f"{month[1]}-{month[2]}-01" if month else "")
    return {"title": _plain(html.escape(" ".join(p.text[title]))), "text": "\n".join(x for x in lines if x), "day": day, "images": list(dict.fromkeys(urljoin(url, x) for x in p.images[body]))}


def articles(pages: DataFrame, key: str, column: str, url: str) -> DataFrame:
    """(key, url, title, text, day, images) of article pages; a page without a title or a body has a null title, so that a
    missed structure is seen and isn't taken for an empty article."""

    @F.pandas_udf("title string, text string, day string, images array<string>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sources, urls in batches:
            rows = [read_article(s, u) or {} for s, u in zip(sources, urls, strict=True)]
            yield pd.DataFrame([[r.get(k) for k in ("title", "text", "day", "images")] for r in rows], columns=["title", "text", "day", "images"])

    return pages.select(key, url, read(column, url).alias("a")).select(key, url, "a.*")
