"""Rules over rows that state their outcome: each function gives a table and the SQL beside it the expected one."""

from __future__ import annotations

from pyspark.sql import functions as F
from sievework.functions import answers as A
from sievework.functions import claims as C
from sievework.functions import dates as D
from sievework.functions import labels as L
from sievework.functions import text as T
from sievework.sources import parse, threads
from sievework.plans.registry import values

CASES = {}


def query(sql):
    def add(f):
        CASES[f.__name__] = f, sql
        return f

    return add


TOPIC = """# The root

- **楼主**：Jo　**时间**：2025-12-30 09:10
- **参与的目标用户**：Jo, Al
- **链接**：https://b.example/inv/100.html

## 主帖

root text
本帖于 2025-12-31 编辑

## 跟帖

- [first](https://b.example/inv/101.html) — **Al** ⭐ 12-30 10:00 (7 bytes)
  > 回答:
  > parent
  > 于
  > 2025-12-30 09:10
  > own words
  - [second](https://b.example/inv/102.html) — Zed 01-02 11:00
    > not a target
    - [third](https://b.example/inv/103.html) — **Al** ⭐ 01-03 12:00
- [fourth](https://b.example/inv/104.html) — **Jo** ⭐ 01-04 13:00 (9 bytes)
"""


#: (case, post id, kind, time, text, status, bytes, parent, answers)
ENTRIES = [
    (1, "100", "post", "2025-12-30 09:10:00", "The root\nroot text", "body_exported", None, None, "101,104"), (1, "101", "reply", "2025-12-30 10:00:00", "first\nown words", "body_exported", 7, "100", "102"),
    (1, "103", "reply", "2026-01-03 12:00:00", "third", "title_only", 0, "102", None), (1, "104", "reply", "2026-01-04 13:00:00", "fourth", "body_missing", 9, "100", None),
]


@query(f"with r(case_id, post_id, kind, published_at, text, body_status, body_bytes, parent_id, answers) as (values {values(ENTRIES)}) select * from r")
def topic_entries(spark, sf):
    docs = spark.createDataFrame([(1, TOPIC), (2, "# no topic"), (3, None), (4, "")], "case_id int, text string")
    return threads.topics(docs, "case_id", "text").select(
        "case_id", "post_id", "kind", "published_at", "text", "body_status", "body_bytes", F.col("parent.post_id").alias("parent_id"), F.array_join(F.transform("replies", lambda x: x["post_id"]), ",").alias("answers"))


DIGEST = """# Jo 的发言整理

## Topic A
楼主 Jo · 2026-01-02 03:04 · [原帖](https://b.example/inv/7.html)
### 2026-01-02 03:04 · Topic A
the body

![image](https://b.example/i.png)
### 2026-01-02 05:06 · Re one
> 回复 Al「Some title」：quoted
answer
### 2026-01-02 05:06 · Re two
（标题即全文）
## Topic B
### 2026-01-03 01:01 · no root yet
lost
楼主 Al · 2026-01-03 00:00 · [原帖](https://b.example/inv/8.html)
### 2026-01-03 02:02 · Hm
（正文未抓到，见原帖）
"""


_H = "2026-01-02 05:06:00"


#: (case, id begins with, length of id, kind, time, text, status, bytes, author of the parent, title of the parent)
UTTERANCES = [
    (1, "7", 1, "post", "2026-01-02 03:04:00", "Topic A\nthe body", "body_exported", 8, None, None), (1, "7r202601020506", 23, "reply", _H, "Re one\nanswer", "body_exported", 6, "Al", "Some title"),
    (1, "7r202601020506", 23, "reply", _H, "Re two", "title_only", 0, "Jo", "Topic A"), (1, "8r202601030202", 18, "reply", "2026-01-03 02:02:00", "Hm", "body_missing", 0, "Al", "Topic B"),
]


@query(f"with r(case_id, id_begin, id_chars, kind, published_at, text, body_status, body_bytes, parent_author, parent_title) as (values {values(UTTERANCES)}) select * from r")
def digest_entries(spark, sf):
    docs = spark.createDataFrame([(1, DIGEST), (2, "# Jo 的发言整理"), (3, None)], "case_id int, text string")
    return threads.digests(docs, "case_id", "text").select(
        "case_id", F.regexp_extract("post_id", r"^(\d+(?:r\d{12})?)", 1).alias("id_begin"), F.length("post_id").alias("id_chars"), "kind", "published_at", "text", "body_status", "body_bytes", F.col("parent.author").alias("parent_author"), F.col("parent.title").alias("parent_title"))


#: (case, JSON, the JSON inside)
LEAVES = [
    (1, '{"candidates": [{"content": {"parts": [{"text": "so: {\\"a\\": 1,"}, {"text": " "}, {"text": "\\"b\\": \\"x\\"} done"}]}}]}', '{"a": 1,\n"b": "x"}'), (2, '{"text": "no braces"}', None), (3, None, None), (4, "", None), (5, "not json", None),
    (6, '[{"text": "{1}"}, {"text": "{1}"}, {"note": "\\"text\\": \\"{2}\\""}]', "{1}"),
]


@query(f"with r(case_id, j, want) as (values {values(LEAVES)}) select case_id, want as inner_json from r")
def nested_answers(spark, sf):
    return spark.createDataFrame([x[:2] for x in LEAVES], "case_id int, j string").select("case_id", A.inner_json(F.col("j")).alias("inner_json"))


_ANSWER = '{"summary_zh": " S ", "symbols": ["$nvda", "TSLA"], "claims": [{"claim": " up ", "symbol": "NVDA", "stance": "buy", "price": ""}, {"claim": " "}, {"claim": "c2", "symbol": "amd", "timestamp": "1:02"}, {"claim": "c3", "symbol": "no symbol!"}], "macro": [{"indicator": "CPI", "value": "3", "period": "May"}, {"value": "9"}], "methods": [{"name": "MA", "explicit_parameters": {"n": 5}}], "invalidations": [{"symbol": "TSLA", "condition": "below 200"}]}'


#: (case, answer, claims as symbol:check, text)
SHAPED = [
    (1, _ANSWER, "NVDA:listed,AMD:not_in_symbols,:", '[Gemini 视频理解 · 未验证] S\n- [NVDA buy] up\n- [1:02 AMD] c2\n- [] c3\n宏观：CPI 3（预期 —）May\n方法：MA 参数 {"n":5}\n失效条件：TSLA below 200'),
    (2, "{}", "", "[Gemini 视频理解 · 未验证]"), (3, '{"claims": null, "macro": []}', "", "[Gemini 视频理解 · 未验证]"),
]


@query(f"with r(case_id, j, claims, text) as (values {values(SHAPED)}) select case_id, claims, text from r")
def model_answers(spark, sf):
    r = spark.createDataFrame([x[:2] for x in SHAPED], "case_id int, j string").withColumn("a", F.from_json("j", A.ANSWER))
    tags = F.transform(A.model_claims(F.col("a")), lambda c: F.concat(F.coalesce(c["symbol"], F.lit("")), F.lit(":"), F.coalesce(c["symbol_check"], F.lit(""))))
    return r.select("case_id", F.array_join(tags, ",").alias("claims"), A.rendered(F.col("a")).alias("text"))


_LONG = "NVDA grows 20 percent; margins of the maker rise and more is said here"


#: (case, message, video, summary, reason)
COMMANDS = [
    (1, f"/yt https://youtu.be/abcdefghijk?t=5 {_LONG}", "abcdefghijk", _LONG, None), (2, f"/YT {_LONG}\nsee https://www.youtube.com/watch?a=1&v=ABCDEFGHIJK&t=9 end", "ABCDEFGHIJK", f"{_LONG}\nsee   end", None),
    (3, "hello", None, None, "no_command"), (4, "/yt no link", None, None, "no_link"), (5, "/yt https://youtu.be/abcdefghijk short", None, None, "too_short"), (6, None, None, None, "no_command"),
]


@query(f"with r(case_id, t, video_id, summary, reason) as (values {values(COMMANDS)}) select case_id, video_id, summary, reason from r")
def summary_commands(spark, sf):
    return spark.createDataFrame([x[:2] for x in COMMANDS], "case_id int, t string").select("case_id", A.command(F.col("t")).alias("c")).select("case_id", "c.*")


#: (case, summary, text)
SUBMITTED = [(1, "NVDA grows 20 percent\nmargins rise 3 points", "[Owner 提交摘要 · 未核实] NVDA grows 20 percent\nmargins rise 3 points\n- [NVDA] NVDA grows 20 percent\n- [NVDA] margins rise 3 points"), (2, "", "[Owner 提交摘要 · 未核实] ")]


@query(f"with r(case_id, t, text) as (values {values(SUBMITTED)}) select case_id, text from r")
def submission_texts(spark, sf):
    r = spark.createDataFrame([x[:2] for x in SUBMITTED], "case_id int, t string")
    return r.select("case_id", A.submission_text(F.col("t"), L.summary_claims(F.col("t"), ["AI"])).alias("text"))


#: (case, text, status, bare, quality given; status, quality, provider, allowed, chars)
FETCHES = [
    (1, "abc", "available", True, None, "available", "Q1", "injected_test", True, 3), (2, "", None, True, None, "metadata_only", "Q5", "metadata_only", False, 0), (3, "abcd", None, False, "Q2", "metadata_only", "Q2", "metadata_only", False, 4),
    (4, None, "blocked", False, None, "blocked", "Q5", "metadata_only", False, 0),
]


@query(f"with r(case_id, t, s, bare, q, status, quality, provider, allowed, chars) as (values {values(FETCHES)}) select case_id, status, quality, provider, allowed, chars from r")
def fetch_results(spark, sf):
    r = spark.createDataFrame([x[:5] for x in FETCHES], "case_id int, t string, s string, bare boolean, q string")
    return r.select("case_id", A.fetch_result(F.col("t"), F.col("s"), F.col("bare"), quality=F.col("q")).alias("f")).select("case_id", "f.status", "f.quality", "f.provider", F.col("f.rule_candidate_allowed").alias("allowed"), "f.chars")


#: (case, key, title, time; id, date, text)
LISTED = [(1, "k1", "Hello", "01/02/2026 03:04:05", "reply-k1", "2026-01-02 03:04:05", "Hello"), (2, None, None, "yesterday", "reply-", "yesterday", ""), (3, "k3", "", None, "reply-k3", "", "")]


@query(f"with r(case_id, k, title, t, id, date, text) as (values {values(LISTED)}) select case_id, id, date, text from r")
def listed_replies(spark, sf):
    r = spark.createDataFrame([x[:4] for x in LISTED], "case_id int, k string, title string, t string")
    return r.select("case_id", A.listed_reply(F.lit("Jo"), F.col("k"), F.lit("u"), F.col("title"), F.col("t"), F.lit(None)).alias("p")).select("case_id", "p.id", "p.date", "p.text")


#: (case, text; places as number:symbols:cue, total, claimed, missed)
PLACES = [
    (1, "今天我买入NVDA，长期看好。今天天气不错，提到AAPL而已。我准备加仓了啊。", "0:NVDA:true,1:AAPL:false,2::true", 3, "0", "1"), (2, "Nothing of note here at all.", "", 0, "", ""), (3, None, "", 0, "", ""), (4, "", "", 0, "", ""),
]


@query(f"with r(case_id, t, places, total, claimed, missed) as (values {values(PLACES)}) select case_id, places, total, claimed, missed from r")
def sentence_locators(spark, sf):
    r = spark.createDataFrame([x[:2] for x in PLACES], "case_id int, t string").select("case_id", C.locators(F.col("t")).alias("l"), C.review_material(F.col("t")).alias("m"))
    shown = F.transform("l.places", lambda x: F.concat_ws(":", x["i"], F.array_join(x["symbols"], "+"), x["stance_cue"]))
    number = lambda c: F.array_join(F.transform(c, lambda x: x["i"].cast("string")), ",")
    return r.select("case_id", F.array_join(shown, ",").alias("places"), F.col("l.total").alias("total"), number("m.claimed").alias("claimed"), number("m.missed").alias("missed"))


_SAID = "今天我买入NVDA，长期看好。"


#: (id, published, captured, title, excerpt; first seen, provenance, exclude)
RECORDS = [
    ("a", "2026-01-05 01:02:03", "2026-01-05T02:00:00Z", _SAID, _SAID, None, None, None), ("b", "2025-01-05", "2026-01-05T02:00:00Z", _SAID, "", None, None, None), ("c", "2026-01-06", "2026-01-06T00:00:00Z", _SAID, None, "2026-01-06T00:00:00Z", "live", True),
    ("d", "2026-01-06", "2026-01-06T00:00:00Z", None, "sell puts on QQQ this week", "2026-01-06T00:00:00Z", "live", False), ("e", None, "2026-01-06T00:00:00Z", _SAID, "", None, None, None), ("f", "2026-01-06", "2026-01-06T00:00:00Z", _SAID, "", "2025-01-01T00:00:00Z", "audited", False),
]


@query("with r(record_id, symbol, stance, provenance) as (values ('a', 'NVDA', 'buy', 'unaudited'), ('d', 'QQQ', 'bullish', 'live')) select * from r")
def claim_export(spark, sf):
    rows = spark.createDataFrame(RECORDS, "id string, published_at string, captured_at string, title string, excerpt string, first_seen string, provenance string, exclude boolean").withColumns({"author": F.lit("Jo"), "url": F.lit("u")})
    records = rows.drop("first_seen", "provenance", "exclude")
    flags = rows.filter("provenance is not null").select("id", "first_seen", "provenance", "exclude")
    return C.exported(records, flags, F.lit("2026-01-10 00:00:00").cast("timestamp"), 14).select("record_id", "symbol", "stance", "provenance")


NOW = "2026-11-10 00:00:00"


#: (case, text, epoch seconds, first seen, discovered)
STAMPS = [
    (1, "2026-11-08 08:09:10", 1794000000, "2026-11-08T01:00:00Z", "2026-11-09"), (2, "2026-11-01T05:06:07Z", 0, "2026-11-09 10:00:00", "2026-11-01"), (3, "2026-10-12 08:09", None, "", "2026-10-13"),
    (4, "20261012", 86399, None, ""), (5, "no date", 86400, "not a time", "2026-01-01"), (6, None, 1, "2026-11-08 00:00:00", None), (7, "2026-11-10", 951782400, "2026-11-07T23:59:59Z", "2026-11-10"), (8, "2026-13-40", 1, "2026-11-09", "x"),
]


def _stamps(spark):
    return spark.createDataFrame(STAMPS, "case_id int, t string, epoch long, first_seen string, discovered string")


@query(f"""with r(case_id, t, epoch, first_seen, discovered) as (values {values(STAMPS)})
select case_id, case when contains(t, ' ') then try_strptime(substr(t, 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%d']) else try_strptime(substr(t, 1, 10), '%Y-%m-%d') end as stamp,
  case when regexp_matches(t, '^[0-9]{{8}}') then substr(t, 1, 4) || '-' || substr(t, 5, 2) || '-' || substr(t, 7, 2) else '' end as compact, coalesce(strftime(make_timestamp(cast(epoch as bigint) * 1000000), '%Y-%m-%d'), '') as epoch_date,
  coalesce(date_diff('day', try_strptime(substr(t, 1, 10), '%Y-%m-%d'), timestamp '{NOW}') between 0 and 7, false) as recent,
  case when coalesce(first_seen, '') = '' then true else coalesce(epoch(timestamp '{NOW}') - epoch(try_strptime(replace(replace(first_seen, 'T', ' '), 'Z', ''), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])) < 48 * 3600, false) end as on_hold,
  coalesce(case when t like '____-__-__%' then substr(t, 1, 10) end < case when discovered like '____-__-__%' then substr(discovered, 1, 10) end, false) as historical from r""")
def date_forms(spark, sf):
    t, now = F.col("t"), F.lit(NOW).cast("timestamp")
    return _stamps(spark).select(
        "case_id", D.stamp(t).cast("timestamp_ntz").alias("stamp"), F.coalesce(D.compact_date(t), F.lit("")).alias("compact"), D.epoch_date(F.col("epoch")).alias("epoch_date"), D.recent(t, now).alias("recent"),
        D.on_hold(F.col("first_seen"), now).alias("on_hold"), D.historical(t, F.col("discovered")).alias("historical"))


CLOCKS = [(1, "a 10/12/2026 postreply08:09:10 b 01/02/2026 23:59:59"), (2, "13/45/2026 10:00:00"), (3, ""), (4, None), (5, "12/31/2025   00:00:01 12/31/2025 00:00:02")]


@query(f"""with r(case_id, t) as (values {values(CLOCKS)}), x as (select case_id, unnest(regexp_extract_all(t, '\\d{{2}}/\\d{{2}}/\\d{{4}}\\s*(?:postreply)?\\s*\\d{{2}}:\\d{{2}}:\\d{{2}}')) as s from r)
select r.case_id, max(try_strptime(substr(s, 1, 10) || ' ' || right(s, 8), '%m/%d/%Y %H:%M:%S')) as latest from r left join x using (case_id) group by r.case_id""")
def page_clocks(spark, sf):
    return spark.createDataFrame(CLOCKS, "case_id int, t string").select("case_id", D.page_clock(F.col("t")).cast("timestamp_ntz").alias("latest"))


_MACRO = ", ".join("case when " + " or ".join(f"contains(lower(t), '{w}')" for w in ws) + f" then '{k}' end" for k, ws in L.MACRO.items())


TOPIC_TEXTS = [(1, "The Federal Reserve and the dollar"), (2, "BTC, gold and CPI; soft landing?"), (3, "nothing of it"), (4, None), (5, "LIQUIDITY and usd and fomc")]


@query(f"with r(case_id, t) as (values {values(TOPIC_TEXTS)}) select case_id, concat_ws(',', {_MACRO}) as topics from r")
def macro_topics(spark, sf):
    return spark.createDataFrame(TOPIC_TEXTS, "case_id int, t string").select("case_id", F.array_join(L.topics(F.col("t"), L.MACRO), ",").alias("topics"))


#: (case, role, quality, origin, text, rule_allowed, structured, admitted)
GATE = [
    (1, "rule_supply", "Q1", "captions", "x", True, False, True), (2, "rule_supply", "Q2", "captions", "x", False, False, False), (3, "rule_supply", "Q3", "captions", "x", True, False, False),
    (4, "market_context", "q4", "captions", "x", False, False, True), (5, "market_context", "Q5", "captions", "x", True, True, False), (6, "market_context", "", "captions", "x", True, True, False),
    (7, "other", "Q2", "captions", "x", False, False, True), (8, "other", "Q3", "captions", "x", True, True, False), (9, "rule_supply", "Q3", "owner_supplied_summary", "x", False, True, True),
    (10, "rule_supply", "Q3", "owner_supplied_summary", "x", False, False, False), (11, "other", "Q1", "gemini_video_understanding", "x", True, True, False), (12, "other", "Q3", "gemini_video_understanding", "x", None, True, True),
    (13, "rule_supply", "Q1", "captions", "  ", True, True, False), (14, "rule_supply", "Q1", None, None, True, True, False), (15, None, "Q1", None, "x", None, None, True), (16, "rule_supply", "Q1", None, "x", None, None, False),
]


@query(f"with r(case_id, role, quality, origin, t, rule_allowed, structured, admitted) as (values {values(GATE)}) select case_id, admitted from r")
def content_gate(spark, sf):
    """Every cell of the gate's truth table."""
    g = spark.createDataFrame(GATE, "case_id int, role string, quality string, origin string, t string, rule_allowed boolean, structured boolean, want boolean")
    return g.select("case_id", L.admitted(F.col("role"), F.col("quality"), F.col("origin"), F.col("t"), F.col("rule_allowed"), F.col("structured")).alias("admitted"))


#: (case, symbol, stance, status, instrument, holder, ticker_source, fits)
LABELS = [
    (1, "nvda", "buy", "executed", None, None, None, True), (1, "$NVDA", "buy", "executed", "leaps", "author", "context", True), (1, "TSLA", "sell", "planned", "stock", "author", "text", True), (1, "TSLA", "maybe", "planned", "stock", "author", "text", False),
    (2, "BRK.B", "hold", "opinion", "", "author_system", "text", True), (2, "TOOLONG", "hold", "opinion", None, None, None, False), (2, "", "hold", "opinion", None, None, None, False), (2, None, "hold", "opinion", None, None, None, False),
    (3, "AB", "buy", None, None, None, None, False), (3, "AB", "trim", "conditional", "other", "nobody", "text", False),
]


@query(f"""with r(case_id, symbol, stance, status, instrument, holder, ticker_source, fits) as (values {values(LABELS)}),
 k as (select distinct case_id, replace(upper(symbol), '$', '') || ':' || stance || ':' || status as k from r where fits)
select case_id, (select coalesce(string_agg(k, ',' order by k), '') from k where k.case_id = r.case_id) as labels, count(*) filter (not fits) as dropped from r group by case_id""")
def label_validation(spark, sf):
    r = spark.createDataFrame(LABELS, "case_id int, symbol string, stance string, status string, instrument string, holder string, ticker_source string, fits boolean")
    g = r.groupBy("case_id").agg(F.collect_list(F.struct("symbol", "stance", "status", "instrument", "holder", "ticker_source")).alias("x")).withColumn("c", L.clean_labels(F.col("x")))
    return g.select("case_id", F.array_join(F.array_sort(F.transform("c.labels", lambda s: F.concat_ws(":", s["symbol"], s["stance"], s["status"]))), ",").alias("labels"), F.col("c.dropped").alias("dropped"))


#: (case, action, url, title, symbol, harmless, paused, members, shaped)
SHAPES = [
    (1, "none", "https://bbs.board.example/x", "Weekly members-only talk", "$nvda", True, True, True, "NVDA"), (2, " BUY ", "https://board.example", "open", "BRK.B", False, True, False, "BRK.B"),
    (3, None, "https://notboard.example/", "（会员第301期）", "not a symbol", True, False, True, None), (4, "sell", None, None, None, False, False, False, None), (5, "n/a", "http://BBS.BOARD.EXAMPLE:80/", "Member Exclusive", "1AB", True, False, True, None),
]


@query(f"with r(case_id, action, url, title, symbol, harmless, paused, members, shaped) as (values {values(SHAPES)}) select case_id, harmless, paused, members, shaped from r")
def output_shapes(spark, sf):
    r = spark.createDataFrame(SHAPES, "case_id int, action string, url string, title string, symbol string, harmless boolean, paused boolean, members boolean, shaped string")
    return r.select("case_id", L.harmless(F.col("action"), ["buy", "sell"]).alias("harmless"), L.paused(F.col("url"), F.lit("2026-11-01").cast("date"), "2026-12-01", "board.example").alias("paused"),
                    L.members_only(F.col("title")).alias("members"), L.symbol(F.col("symbol")).alias("shaped"))


#: (case, domain, text, grade)
_LONG = "word " * 400


GRADES = [
    (1, "a.example", _LONG + " full transcript", "Q2"), (2, "a.example", _LONG + " at 1:02:03 we", "Q2"), (3, "a.example", _LONG, "Q4"), (4, "b.example", "x" * 640 + " show notes", "Q3"), (5, "b.example", "x" * 640 + "          ", "Q4"),
    (6, "c.example", _LONG + " transcript", "Q4"), (7, "a.example", "transcript", "Q5"), (8, "b.example", None, "Q5"), (9, None, "x" * 500, "Q4"),
]


@query(f"with r(case_id, domain, t, grade) as (values {values(GRADES)}) select case_id, grade from r")
def transcript_grades(spark, sf):
    r = spark.createDataFrame(GRADES, "case_id int, domain string, t string, want string")
    return r.select("case_id", L.grade(F.col("domain"), F.col("t"), ["a.example"], ["b.example"]).alias("grade"))


#: (case, title, author, page, identified)
TITLES = [(1, "Market Outlook today", "Jo / team", "the MARKET has an outlook", True), (2, "Market Outlook", "Jo Doe/x", "by jo doe", True), (3, "Market Outlook", "", "market only", False), (4, "", None, "anything", False), (5, "科技 股票", "", "科技和股票", True)]


@query(f"with r(case_id, title, author, page, identified) as (values {values(TITLES)}) select case_id, identified from r")
def page_identity(spark, sf):
    r = spark.createDataFrame(TITLES, "case_id int, title string, author string, page string, want boolean")
    return r.select("case_id", F.coalesce(L.identified(F.col("title"), F.col("author"), F.col("page")), F.lit(False)).alias("identified"))


REPLIES = [
    (1, ["本帖于 2026-01-01 由 x 编辑", "own text ", "", "more"], "own text\nmore"), (2, ["回答:", "some parent", "由 who", "于", "2026-01-02 03:04:05", "mine", " too "], "mine\ntoo"),
    (3, ["回答：", "parent", "no end"], ""), (4, [], ""), (5, ["回答:", "于", "2026-01-02 03:04", "x"], "x"),
]


@query(f"with r(case_id, lines, own) as (values {values(REPLIES)}) select case_id, own from r")
def reply_own_words(spark, sf):
    return spark.createDataFrame(REPLIES, "case_id int, lines array<string>, want string").select("case_id", L.own_words(F.col("lines")).alias("own"))


#: (case, title, excerpt, parent author, parent title, text, context)
ITEMS = [(1, "A", "A", "jo", "P", "A", "jo: P"), (2, "A", " more ", None, "P", "A\nmore", "None: P"), (3, " A ", None, "jo", "", "A", None), (4, None, "e", "jo", None, "\ne", None)]


@query(f"with r(case_id, a, b, c, d, text, context) as (values {values(ITEMS)}) select case_id, text, context from r")
def model_items(spark, sf):
    r = spark.createDataFrame(ITEMS, "case_id int, a string, b string, c string, d string, w string, x string")
    return r.select("case_id", L.model_item(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m")).select("case_id", "m.text", "m.context")


#: (case, status, parsed, page author, author, chars, images, class)
PAGES = [
    (1, 404, False, None, "jo", None, None, "http_error"), (2, 200, False, None, "jo", None, None, "selector_miss"), (3, 200, True, "Al", "jo", 10, 0, "author_mismatch"), (4, 200, True, "JO", "jo", 10, 1, "body_now_present"),
    (5, 200, True, "jo", "jo", 0, 2, "image_only"), (6, 200, True, "jo", "jo", None, None, "genuinely_empty"), (7, 200, True, None, None, 1, 0, "body_now_present"),
]


@query(f"with r(case_id, status, parsed, page_author, author, chars, images, reason) as (values {values(PAGES)}) select case_id, reason from r")
def title_only_reason(spark, sf):
    r = spark.createDataFrame(PAGES, "case_id int, status int, parsed boolean, page_author string, author string, chars int, images int, want string")
    return r.select("case_id", L.page_class(*(F.col(c) for c in ("status", "parsed", "page_author", "author", "chars", "images"))).alias("reason"))


#: (case, name, text, kind)
EXPORTS = [(1, "a.md", "**楼主**\n## 主帖\n## 跟帖", "topic"), (2, "b.MD", "text", "markdown"), (3, "c.htm", "<p>", "html"), (4, "d.jsonl", "{}", "jsonl"), (5, "e.bin", None, "unknown"), (6, "f.txt", "**楼主**", "markdown")]


@query(f"with r(case_id, name, t, kind) as (values {values(EXPORTS)}) select case_id, kind from r")
def export_kinds(spark, sf):
    return spark.createDataFrame(EXPORTS, "case_id int, name string, t string, want string").select("case_id", L.sniffed(F.col("name"), F.col("t")).alias("kind"))


SUMMARY = [(1, "- NVDA：看好到 150\n- 目标价提高到 160；AI 需求强劲 20%\n无关的一行文字\n1. TSLA 风险较大的", [["NVDA：看好到 150", "NVDA", None], ["目标价提高到 160", None, "NVDA"], ["AI 需求强劲 20%", None, "NVDA"], ["TSLA 风险较大的", "TSLA", None]]), (2, "nothing to see", [])]


@query("with r(case_id, n, claim, symbol, context_symbol) as (values " + values([(c, i, *x) for c, _, rows in SUMMARY for i, x in enumerate(rows)]) + ") select case_id, n, claim, symbol, context_symbol from r")
def summary_claims(spark, sf):
    r = spark.createDataFrame([(c, t) for c, t, _ in SUMMARY], "case_id int, t string")
    found = L.summary_claims(F.col("t"), ["AI"])
    return r.select("case_id", F.posexplode(found).alias("n", "c")).select("case_id", "n", "c.claim", "c.symbol", "c.context_symbol")


ENTRIES = [(1, "2026-01-02T03:04:05Z", None, None, None, "2026-01-02"), (2, None, "20260103", None, None, "2026-01-03"), (3, "", "bad", 86400, None, "1970-01-02"), (4, None, None, None, 172800, "1970-01-03"), (5, None, None, None, None, "")]


@query(f"with r(case_id, a, b, c, d, published) as (values {values(ENTRIES)}) select case_id, published from r")
def entry_dates(spark, sf):
    """The publication date of a listing's entry, from whichever field has one."""
    r = spark.createDataFrame(ENTRIES, "case_id int, a string, b string, c long, d long, want string")
    return r.select("case_id", D.first_date(F.substring("a", 1, 10), D.compact_date(F.col("b")), D.epoch_date(F.col("c")), D.epoch_date(F.col("d"))).alias("published"))


_ATOM = "<feed><entry><yt:videoId>abc</yt:videoId><published>2026-01-02</published><title>T &amp; U</title></entry><entry><published>x</published></entry><entry><yt:videoId>def</yt:videoId></entry></feed>"


@query(f"with r(video_id, published) as (values {values([('abc', '2026-01-02'), ('def', '')])}) select video_id, published from r")
def feed_entries(spark, sf):
    """Entries of an Atom text by id; entries without one are left out."""
    from sievework.sources.parse import atom_entries

    return spark.createDataFrame([(_ATOM,), (None,), ("not xml",)], "t string").select(F.explode(atom_entries(F.col("t"))).alias("e")).select("e.video_id", "e.published")
