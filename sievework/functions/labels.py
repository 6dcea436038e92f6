"""Column functions that grade, gate, validate and shape records and labels. Lists of allowed values are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T

#: What a label's fields may hold.
ENUMS = {
    "stance": ("buy", "add", "sell", "trim", "hold", "avoid", "bullish", "bearish"), "status": ("executed", "planned", "conditional", "opinion"),
    "instrument": ("stock", "sell_put", "covered_call", "leaps", "other"), "holder": ("author", "author_system"), "ticker_source": ("text", "context"),
}
#: What a label's fields hold where nothing is given.
DEFAULTS = {"instrument": "stock", "holder": "author", "ticker_source": "text"}
SYMBOL = r"^[A-Z]{1,5}(\.[A-Z])?$"
#: Words of macro topics, lower-cased.
MACRO = {
    "利率/Fed": ["federal reserve", "fed ", "interest rate", "rate cut", "rate hike", "yield", "treasury", "fomc"],
    "通胀": ["inflation", "cpi", "ppi"],
    "美元": ["dollar", "usd", "dxy"],
    "黄金": ["gold", "precious metal"],
    "加密资产": ["bitcoin", "btc", "crypto", "ethereum"],
    "经济周期": ["recession", "soft landing", "hard landing", "economy", "economic"],
    "流动性": ["liquidity", "money supply", "financial conditions"],
}


def holds_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def topics(text: Column, groups: dict[str, list[str]]) -> Column:
    """Names of the groups any of whose words the lower-cased text holds, in the groups' order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*(F.when(holds_any(low, words), name) for name, words in groups.items())))


def cleaned(text: Column, noise: list[str]) -> Column:
    """Squeezed lines without empty ones and without those that, in either case, are a noise line."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]", -1), T.squeeze)
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~F.lower(x).isin(noise)), "\n")


def units(text: Column, least: int = 25) -> Column:
    """Sentences after an end mark with white space, and at line ends; squeezed, ``least`` characters or longer."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)([。！？.!?])\s+", "$1\n"), r"\n+", -1)
    return F.filter(F.transform(parts, T.squeeze), lambda s: F.length(s) >= least)


def points(text: Column, words: list[str], most: int = 3, chars: int = 120, least: int = 25) -> Column:
    """The first ``most`` distinct beginnings of sentences that hold one of the words."""
    hit = F.filter(units(text, least), lambda s: holds_any(F.lower(s), words))
    return F.slice(F.array_distinct(F.transform(hit, lambda s: F.substring(s, 1, chars))), 1, most)


def capitals(text: Column, stop: list[str]) -> Column:
    """Sorted distinct runs of two to five capitals that stand alone, but for stop words."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z])[A-Z]{2,5}(?![A-Za-z])"), F.lit(0))
    return F.array_sort(F.array_except(F.array_distinct(found), F.array(*map(F.lit, stop)).cast("array<string>")))


def thread_key(kind: Column, parent: Column, url: Column, key: Column) -> Column:
    from_url = T.null_if_empty(F.regexp_extract(F.coalesce(url, F.lit("")), r"/(\d+)\.html", 1))
    return F.concat(F.coalesce(T.null_if_empty(kind), F.lit("?")), F.lit(":"), F.coalesce(T.null_if_empty(parent), from_url, key.cast("string")))


def identified(title: Column, author: Column, page: Column, least: int = 2, most: int = 12) -> Column:
    """Whether a page is about a title: ``least`` of its first words stand in the page, or its author does."""
    low = F.lower(page)
    words = F.slice(F.regexp_extract_all(title, F.lit(r"[A-Za-z0-9一-鿿]{2,}"), F.lit(0)), 1, most)
    name = F.lower(F.trim(F.substring_index(F.coalesce(author, F.lit("")), "/", 1)))
    return (F.size(F.filter(words, lambda w: F.contains(low, F.lower(w)))) >= least) | ((name != "") & F.contains(low, name))


def own_words(lines: Column) -> Column:
    """A reply's own lines: without edit notes, and without the quoted block that ends with a time after a lone "于"."""
    kept = F.filter(lines, lambda x: ~F.trim(x).rlike("^本帖于.*编辑$"))
    at = lambda i: F.trim(F.get(kept, i))
    quoted = F.coalesce(at(F.lit(0)).isin("回答:", "回答："), F.lit(False))
    ends = F.filter(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(kept) - 1)), lambda i: at(i).rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$") & (at(i - 1) == "于"))
    rest = F.when(~quoted, kept).when(F.size(ends) > 0, F.slice(kept, F.get(ends, F.lit(0)) + 2, F.size(kept))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.filter(F.transform(rest, lambda x: F.trim(x)), lambda x: x != ""), "\n")


#: Words that tell a transcript and a structured summary, a time in a text, and lengths that a grade takes.
TRANSCRIPT = ("transcript", "script", "full transcript", "字幕", "逐字稿")
STRUCTURED = ("detailed brief", "detailed walkthrough", "show notes", "原片", "跳到", "infographic")
TIMED = r"(?m)(?:^|\s)(?:\d{1,2}:)?\d{1,2}:\d{2}(?:\s|$)"
FULL_CHARS, BRIEF_CHARS, SOME_CHARS = 1800, 650, 500


def timed(text: Column) -> Column:
    """Whether a text holds a time such as 1:02 or 1:02:03 by itself."""
    return F.coalesce(text.rlike(TIMED), F.lit(False))


def grade(domain: Column, text: Column, full: list[str], brief: list[str]) -> Column:
    """Q2 for a full transcript of a listed provider, Q3 for a structured summary of another, Q4 for ``SOME_CHARS`` or more,
    else Q5."""
    low, n = F.lower(F.coalesce(text, F.lit(""))), F.length(F.coalesce(text, F.lit("")))
    transcript, structured = (holds_any(low, list(words)) for words in (TRANSCRIPT, STRUCTURED))
    return (
        F.when(domain.isin(full) & (n >= FULL_CHARS) & (transcript | timed(text)), "Q2").when(domain.isin(brief) & (n >= BRIEF_CHARS) & (structured | timed(text)), "Q3")
        .when(n >= SOME_CHARS, "Q4").otherwise("Q5")
    )


def admitted(role: Column, quality: Column, origin: Column, text: Column, rule_allowed: Column, structured: Column) -> Column:
    """Whether content may enter, by origin, then role, then quality. Text of white space only never does."""
    q = F.upper(F.coalesce(T.null_if_empty(quality), F.lit("Q5")))
    no = F.lit(False)
    return (
        F.when(T.ustrip(F.coalesce(text, F.lit(""))) == "", no)
        .when(F.coalesce(origin, F.lit("")).isin("owner_supplied_summary", "gemini_video_understanding"), (q == "Q3") & F.coalesce(structured, no))
        .when(role == "rule_supply", q.isin("Q1", "Q2") & F.coalesce(rule_allowed, no)).when(role == "market_context", q.isin("Q1", "Q2", "Q3", "Q4"))
        .otherwise(q.isin("Q1", "Q2"))
    )


def flags(**conditions: Column) -> Column:
    """Names of the conditions that hold."""
    return F.array_compact(F.array(*(F.when(c, name) for name, c in conditions.items())))


def clean_labels(labels: Column) -> Column:
    """Struct of the labels that fit the schema, distinct by symbol, stance and status, and how many didn't fit.
    ``labels`` is an array of structs of symbol and the fields of ``ENUMS``; missing fields take their default."""

    def shaped(x: Column) -> Column:
        field = lambda k: F.coalesce(T.null_if_empty(F.trim(x[k])), F.lit(DEFAULTS.get(k)).cast("string"))
        return F.struct(F.regexp_replace(F.upper(F.coalesce(F.trim(x["symbol"]), F.lit(""))), r"^\$+", "").alias("symbol"), *(field(k).alias(k) for k in ENUMS))

    def fits(x: Column) -> Column:
        ok = x["symbol"].rlike(SYMBOL)
        for k, allowed in ENUMS.items():
            ok = ok & F.coalesce(x[k].isin(list(allowed)), F.lit(False))
        return ok

    every = F.transform(F.coalesce(labels, F.array().cast("array<struct<symbol:string,stance:string,status:string,instrument:string,holder:string,ticker_source:string>>")), shaped)
    good = F.filter(every, fits)
    same = lambda a, b: (a["symbol"] == b["symbol"]) & (a["stance"] == b["stance"]) & (a["status"] == b["status"])
    firsts = F.filter(good, lambda x, i: ~F.exists(F.slice(good, F.lit(1), i), lambda y: same(x, y)))
    return F.struct(firsts.alias("labels"), (F.size(every) - F.size(good)).cast("long").alias("dropped"))


def harmless(action: Column, trades: list[str]) -> Column:
    """False only for an output that proposes a trade."""
    return ~F.lower(F.trim(F.coalesce(action, F.lit("")))).isin(trades)


def paused(url: Column, today: Column, until: str, domain: str) -> Column:
    """Whether a host (or a host under it) may not be asked until a day."""
    host = T.host(F.coalesce(url, F.lit("")))
    return (today < F.lit(until).cast("date")) & ((host == domain) | host.endswith("." + domain))


def symbol(text: Column) -> Column:
    """A ticker-shaped text in capitals without its dollar signs, else null; nothing is guessed."""
    s = F.upper(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"^\$+", ""))
    return F.when(s.rlike(r"^[A-Z][A-Z0-9.\-]{0,9}$"), s)


def members_only(title: Column) -> Column:
    return F.coalesce(title, F.lit("")).rlike(r"(?i)会员|members?[ -]?only|member exclusive")


def items(title: Column, excerpt: Column, key: Column) -> Column:
    """Title and excerpt of a record as items of their own; the excerpt only if it says more than the title."""
    t, e = T.ustrip(F.coalesce(title, F.lit(""))), T.ustrip(F.coalesce(excerpt, F.lit("")))

    def item(kind: str, text: Column) -> Column:
        name = F.substring(F.sha2(F.concat(F.lit(f"{kind}|"), key.cast("string")), 256), 1, 16)
        return F.struct(name.alias("item_id"), F.lit(kind).alias("kind"), F.sha2(text, 256).alias("text_sha256"), F.substring(text, 1, 40).alias("locator"))

    return F.array_compact(F.array(F.when(t != "", item("title", t)), F.when((e != "") & (e != t), item("excerpt", e))))


def model_item(title: Column, excerpt: Column, parent_author: Column, parent_title: Column) -> Column:
    """What a model reads of a record: title, or title and excerpt where they differ; and whom it answers."""
    t, e = T.ustrip(F.coalesce(title, F.lit(""))), T.ustrip(F.coalesce(excerpt, F.lit("")))
    return F.struct(F.when((e == "") | (e == t), t).otherwise(F.concat(t, F.lit("\n"), e)).alias("text"), F.when(parent_title != "", F.concat(F.coalesce(parent_author, F.lit("None")), F.lit(": "), parent_title)).alias("context"))


def text_form(kind: Column, excerpt: Column) -> Column:
    return F.when(kind == "video", "video").when(F.coalesce(excerpt, F.lit("")) != "", "title_plus_excerpt").otherwise("title_only")


def answer_status(labels: Column, note: Column) -> Column:
    return F.when(labels > 0, "claim").when(note == "needs_article_check", "needs_article_check").otherwise("none")


def page_class(status: Column, parsed: Column, page_author: Column, author: Column, chars: Column, images: Column) -> Column:
    """Why a record has a title only, from what its page shows now."""
    return (
        F.when(status != 200, "http_error").when(~parsed, "selector_miss")
        .when(F.lower(F.coalesce(page_author, F.lit(""))) != F.lower(F.coalesce(author, F.lit(""))), "author_mismatch")
        .when(F.coalesce(chars, F.lit(0)) > 0, "body_now_present").when(F.coalesce(images, F.lit(0)) > 0, "image_only").otherwise("genuinely_empty")
    )


def sniffed(name: Column, text: Column) -> Column:
    """The kind of an export, by its marks and then its suffix."""
    t = F.coalesce(text, F.lit(""))
    topic = F.contains(t, F.lit("**楼主**")) & F.contains(t, F.lit("## 跟帖")) & F.contains(t, F.lit("## 主帖"))
    return F.when(topic, "topic").when(F.lower(name).rlike(r"\.(md|markdown|txt)$"), "markdown").when(F.lower(name).rlike(r"\.html?$"), "html").when(F.lower(name).endswith(".jsonl"), "jsonl").otherwise("unknown")


def summary_claims(text: Column, tickers_stop: list[str], most: int = 20, chars: int = 160, least: int = 6) -> Column:
    """Lines of a pasted summary that hold a ticker or a number, with the first ticker, or else the nearest one above."""
    raw = F.transform(F.split(text, r"[\n。；;]+", -1), lambda x: F.trim(F.regexp_replace(x, r"^[\s\-•*#>0-9.、()（）一二三四五六七八九十]+", "")))
    lines = F.filter(raw, lambda x: F.length(x) >= least)
    ticker = lambda x: F.get(F.filter(F.regexp_extract_all(x, F.lit(r"(?<![A-Za-z0-9])[A-Z]{2,5}(?![A-Za-z0-9])"), F.lit(0)), lambda t: ~t.isin(tickers_stop)), F.lit(0))
    state = F.struct(F.lit(None).cast("string").alias("above"), F.array().cast("array<struct<claim:string,symbol:string,context_symbol:string>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        own = ticker(x)
        row = F.struct(F.substring(x, 1, chars).alias("claim"), own.alias("symbol"), F.when(own.isNull(), a["above"]).alias("context_symbol"))
        told = own.isNotNull() | x.rlike(r"\d")
        return F.struct(F.coalesce(own, a["above"]).alias("above"), F.when(told, F.concat(a["out"], F.array(row))).otherwise(a["out"]).alias("out"))

    return F.slice(F.aggregate(lines, state, step, lambda a: a["out"]), 1, most)


def has_ticker(symbols: Column, claims: Column) -> Column:
    """Whether a record names anything to score: a symbol or a claim."""
    return (F.coalesce(F.size(symbols), F.lit(0)) > 0) | (F.coalesce(F.size(claims), F.lit(0)) > 0)


def refusals(author: Column, wanted: Column, url: Column, shape: str, title: Column) -> Column:
    """Why a single post may not be taken in, all reasons in order: an address of another shape, another author, no title."""
    return flags(
        url_shape=~F.coalesce(url, F.lit("")).rlike(shape), author_mismatch=~F.coalesce(F.lower(F.trim(author)) == F.lower(F.trim(wanted)), F.lit(False)), no_title=T.ustrip(F.coalesce(title, F.lit(""))) == "")
