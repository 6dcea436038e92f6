"""Column functions over answers of models and people: the JSON inside an answer, its claims and macro notes, its text,
submissions by command, and fetch results with their defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import labels as L
from sievework.functions import text as T

#: What is read of an answer; a method's parameters stay JSON text.
ANSWER = """summary_zh string, symbols array<string>, claims array<struct<claim:string,stance:string,price:string,timestamp:string,evidence_mode:string,confidence:string,symbol:string>>,
 macro array<struct<indicator:string,value:string,expectation:string,period:string,timestamp:string>>, methods array<struct<name:string,explicit_parameters:string>>, invalidations array<struct<symbol:string,condition:string>>"""
#: A fetch result's fields where nothing is given, then those of a bare text that is there.
FETCH = {"status": "metadata_only", "quality": "Q5", "provider": "metadata_only", "content_origin": "metadata_only"}
FETCHED = {"quality": "Q1", "provider": "injected_test", "content_origin": "test_transcript"}
VIDEO = r"(?:youtube\.com/(?:watch\?(?:[^ ]*&)?v=|shorts/|live/)|youtu\.be/)([A-Za-z0-9_-]{11})"


def text_leaves(answer: Column) -> Column:
    """Distinct texts that JSON holds under the name ``text`` at any depth, in the order they stand in; blank ones are left
    out. Invalid JSON gives those that can be read; null gives none."""
    raw = F.regexp_extract_all(F.coalesce(answer, F.lit("")), F.lit(r'"text"\s*:\s*("(?:[^"\\]|\\.)*")'), F.lit(1))
    read = F.transform(raw, lambda x: F.get(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"), F.lit(0)))
    return F.array_distinct(F.filter(read, lambda x: x.isNotNull() & (T.ustrip(x) != "")))


def inner_json(answer: Column) -> Column:
    """From the first brace to the last of the texts of an answer; null where there is none."""
    return T.null_if_empty(F.regexp_extract(F.array_join(text_leaves(answer), "\n"), r"(?s)(\{.*\})", 1))


def _field(x: Column, name: str, chars: int) -> Column:
    return F.when(x[name] != "", F.substring(T.ustrip(x[name]), 1, chars)).alias(name)


def model_claims(answer: Column, most: int = 20, chars: int = 120) -> Column:
    """The first claims of an answer (a struct as ``ANSWER``) that say something, cut; a ticker that the answer doesn't list
    too is kept and marked."""
    listed = F.transform(F.coalesce(answer["symbols"], F.array().cast("array<string>")), L.symbol)
    told = F.filter(F.slice(answer["claims"], 1, most), lambda c: T.ustrip(F.coalesce(c["claim"], F.lit(""))) != "")

    def shaped(c: Column) -> Column:
        sym = L.symbol(c["symbol"])
        check = F.when(sym.isNotNull(), F.when(F.coalesce(F.array_contains(listed, sym), F.lit(False)), "listed").otherwise("not_in_symbols"))
        return F.struct(*(_field(c, k, chars) for k in ("claim", "stance", "price", "timestamp", "evidence_mode", "confidence")), sym.alias("symbol"), check.alias("symbol_check"))

    return F.coalesce(F.transform(told, shaped), F.array())


def model_macro(answer: Column, most: int = 8, chars: int = 120) -> Column:
    told = F.filter(F.slice(answer["macro"], 1, most), lambda m: T.ustrip(F.coalesce(m["indicator"], F.lit(""))) != "")
    return F.coalesce(F.transform(told, lambda m: F.struct(*(_field(m, k, chars) for k in ("indicator", "value", "expectation", "period", "timestamp")))), F.array())


def rendered(answer: Column, most: int = 6) -> Column:
    """An answer as text: summary, claims, macro notes, the first methods and what would prove it wrong."""
    said = lambda x, other="": F.coalesce(T.null_if_empty(x), F.lit(other))
    claim = lambda c: F.concat(F.lit("- ["), F.array_join(F.filter(F.array(c["timestamp"], c["symbol"], c["stance"], c["price"]), lambda x: x != ""), " "), F.lit("] "), c["claim"])
    macro = lambda m: F.concat(F.lit("宏观："), m["indicator"], F.lit(" "), said(m["value"]), F.lit("（预期 "), said(m["expectation"], "—"), F.lit("）"), said(m["period"]))
    method = lambda m: F.concat(F.lit("方法："), m["name"], F.lit(" 参数 "), said(m["explicit_parameters"], "{}"))
    wrong = lambda v: F.concat(F.lit("失效条件："), said(v["symbol"]), F.lit(" "), v["condition"])
    none = F.array().cast("array<string>")
    first = lambda k, need: F.filter(F.slice(answer[k], 1, most), lambda x: x[need] != "")
    parts = F.concat(
        F.array(F.concat(F.lit("[Gemini 视频理解 · 未验证] "), T.ustrip(said(answer["summary_zh"])))), F.transform(model_claims(answer), claim), F.transform(model_macro(answer), macro),
        F.coalesce(F.transform(first("methods", "name"), method), none), F.coalesce(F.transform(first("invalidations", "condition"), wrong), none))
    return T.ustrip(F.array_join(parts, "\n"))


def submission_text(excerpt: Column, claims: Column) -> Column:
    """A person's summary as text: ``claims`` is an array as ``labels.summary_claims`` gives it."""
    tag = lambda c: F.coalesce(T.null_if_empty(c["symbol"]), T.null_if_empty(c["context_symbol"]))
    line = lambda c: F.concat(F.lit("- "), F.coalesce(F.concat(F.lit("["), tag(c), F.lit("] ")), F.lit("")), c["claim"])
    return F.array_join(F.concat(F.array(F.concat(F.lit("[Owner 提交摘要 · 未核实] "), T.ustrip(F.coalesce(excerpt, F.lit(""))))), F.coalesce(F.transform(claims, line), F.array().cast("array<string>"))), "\n")


def command(text: Column, least: int = 50) -> Column:
    """Struct of video id, summary and reason of a ``/yt`` message; the reason is null where the message is accepted. The
    summary is what stands before and behind the link."""
    all_of = T.ustrip(F.coalesce(text, F.lit("")))
    body = T.ustrip(F.substring(all_of, 4, 1 << 30))
    video = T.null_if_empty(F.regexp_extract(body, VIDEO, 1))
    link = F.regexp_extract(body, VIDEO, 0)
    at = F.instr(body, link)
    before = F.regexp_extract(F.substring(body, F.lit(1), at - 1), "(?s)^(.* )[^ ]*$", 1)
    after = F.regexp_replace(F.substring(body, at + F.length(link), F.length(body)), r"(?U)^\S+", "")
    summary = T.ustrip(F.concat(before, F.lit(" "), after))
    reason = F.when(~F.lower(all_of).startswith("/yt"), "no_command").when(video.isNull(), "no_link").when(F.length(summary) < least, "too_short")
    return F.struct(F.when(reason.isNull(), video).alias("video_id"), F.when(reason.isNull(), summary).alias("summary"), reason.alias("reason"))


def fetch_result(text: Column, status: Column, bare: Column, **given: Column) -> Column:
    """A fetch result with all its fields. ``bare`` tells a plain (text, status) pair, whose text alone decides what the
    others hold, from a record, whose given fields count and whose missing ones take their default."""
    there = F.coalesce(text, F.lit("")) != ""
    pick = lambda k: F.when(bare, F.when(there, FETCHED[k]).otherwise(FETCH[k])).otherwise(F.coalesce(given.get(k, F.lit(None).cast("string")), F.lit(FETCH[k])))
    allowed = F.when(bare, there).otherwise(F.coalesce(given.get("rule_candidate_allowed", F.lit(None).cast("boolean")), F.lit(False)))
    state = F.coalesce(F.when(bare, T.null_if_empty(status)).otherwise(status), F.lit(FETCH["status"]))
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), state.alias("status"), *(pick(k).alias(k) for k in FETCHED), allowed.alias("rule_candidate_allowed"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"))


def listed_reply(author: Column, entry_key: Column, url: Column, title: Column, published: Column, parent: Column) -> Column:
    """A reply as its list shows it: the title is its text, and nothing of the page behind its link is its author's."""
    at = F.date_format(F.try_to_timestamp(published, F.lit("MM/dd/yyyy HH:mm:ss")), "yyyy-MM-dd HH:mm:ss")
    words = F.coalesce(title, F.lit(""))
    return F.struct(
        F.concat(F.lit("reply-"), F.coalesce(entry_key, F.lit(""))).alias("id"), F.coalesce(url, F.lit("")).alias("url"), words.alias("title"), author.alias("author"), F.coalesce(at, published, F.lit("")).alias("date"), words.alias("text"),
        F.lit("reply").alias("kind"), entry_key.alias("source_entry_key"), parent.alias("parent_post_id"), F.lit("list_visible_reply_text").alias("attribution_fallback"))
