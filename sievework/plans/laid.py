"""Queries of rules over sentences, addresses, dates and answers that are laid out from the columns of the driver's tables:
each row's input is built from its own values, by the SQL that Spark and DuckDB share, and the SQL works out what the
rule should say from the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import answers as A
from sievework.functions import claims as C
from sievework.functions import dates as D
from sievework.functions import extract
from sievework.functions import labels as L
from sievework.functions import learning as G
from sievework.functions import text as T
from sievework.operators import intake
from sievework.plans.intake import themes_sql
from sievework.plans.registry import pick, query, table

FROM = "from documents where n_chars is not null"
#: Symbols, numbers and days of a row.
X = "element_at(split('NVDA,QQQ,VGT,AAPL,INTC', ','), cast(n_chars % 5 + 1 as int))"
Y = "element_at(split('TSLA,LITE,AMD', ','), cast(doc_id % 3 + 1 as int))"
XD, YD = "['NVDA', 'QQQ', 'VGT', 'AAPL', 'INTC'][n_chars % 5 + 1]", "['TSLA', 'LITE', 'AMD'][doc_id % 3 + 1]"
P, Q = "100 + n_chars % 800", "1 + doc_id % 9"
MONTH, DAY = "1 + n_chars % 12", "1 + n_chars % 28"
MM, DD = f"lpad(concat({MONTH}, ''), 2, '0')", f"lpad(concat({DAY}, ''), 2, '0')"


def rows(spark: SparkSession, sf: str, **inputs: str) -> DataFrame:
    return table(spark, sf, "documents").filter("n_chars is not null").select("doc_id", *(F.expr(v).alias(k) for k, v in inputs.items()))


def said(by: str, *options: str | None, x: str = X, y: str = Y) -> str:
    """``pick`` with [X] and [Y] for the row's symbols and [P] for its number."""
    return pick(by, *(None if o is None else o.replace("[X]", "{" + x + "}").replace("[Y]", "{" + y + "}").replace("[P]", "{" + P + "}").replace("[Q]", "{" + Q + "}") for o in options))


def _case(by: str, *outcomes: str) -> str:
    return f"case {by} % {len(outcomes)} " + " ".join(f"when {i} then {o}" for i, o in enumerate(outcomes)) + " end"


def _pairs(found, *fields):
    return F.array_join(F.transform(found, lambda c: F.concat_ws(":", *(c[k] for k in fields))), ",")


@query(f"""select doc_id, concat_ws(',', {_case("doc_id", XD + " || ':buy'", XD + " || ':trim'", XD + " || ':bearish'", "null", "null", XD + " || ':sell'")}, {_case("n_chars", YD + " || ':bullish'", YD + " || ':hold'", "null", YD + " || ':hold'")}) as claims {FROM}""")
def claims_v4(spark, sf):
    """Claims of two lines: one with a stance, of another person or without any, and one more."""
    one = said("doc_id", "今天我买入[X]，长期看好。", "Taking some profit on [X]", "I am bearish on [X] for the next few months.", "他说已经清仓[X]了。", "今天天气不错，提到[X]而已。", "今天卖出了部分[X]在117.57")
    two = said("n_chars", "sell puts on [Y] this week", "没有减仓，[Y]的比例肯定增加了。", "nothing here to say", "No, [Y] 没有那么speculative，不卖")
    return rows(spark, sf, t=f"concat({one}, chr(10), {two})").select("doc_id", _pairs(C.claims(F.col("t")), "symbol", "stance").alias("claims"))


@query(f"""select doc_id, {_case("doc_id", "'long'", "null", "'long'")} as horizon, doc_id % 3 = 0 as conditional, doc_id % 3 = 1 as question, case when doc_id % 3 = 0 then cast({P} as double) end as price {FROM}""")
def claim_fields(spark, sf):
    t = said("doc_id", "我准备长期持有[X]，跌到[P]会继续加仓。", "[X]可以买入了吗？", "今天我买入[X]，长期看好。")
    return rows(spark, sf, t=t).select("doc_id", F.get(C.claims(F.col("t")), F.lit(0)).alias("c")).select("doc_id", "c.horizon", "c.conditional", "c.question", "c.price")


@query(f"""select doc_id, {_case("doc_id", XD + " || ':bullish'", XD + " || ':buy'", "''")} as claims {FROM}""")
def claims_v6(spark, sf):
    """A sentence without a symbol takes the only one that the text names."""
    t = said("doc_id", "Look at [X]. 跌到[P]是好事。", "今天我买入[X]，长期看好。", "[X] is here. Nothing else said.")
    return rows(spark, sf, t=t).select("doc_id", _pairs(C.claims(F.col("t"), C.V6), "symbol", "stance").alias("claims"))


@query(f"""select doc_id, {_case("doc_id", XD + " || ':add:context'", "''", "''")} as claims {FROM}""")
def claims_v7(spark, sf):
    """Replies, with the text that they answer."""
    df = rows(spark, sf, t=said("doc_id", "加仓了", "加仓了", "如果你在[P]卖掉[X]就好。"), context=said("doc_id", "Talk about [X]", "[X] or [Y]", None))
    return df.select("doc_id", _pairs(C.claims(F.col("t"), C.V7, F.col("context")), "symbol", "stance", "ticker_source").alias("claims"))


_HP = said("doc_id", "今天我买入[X]，长期看好。", "Will you sell [X]?", "sell puts on [X] this week", "他说已经清仓[X]了。")


@query(f"""select doc_id, {_case("doc_id", XD + " || ':buy:executed'", "''", XD + " || ':bullish:opinion'", "''")} as claims {FROM}""")
def claims_hp(spark, sf):
    return rows(spark, sf, t=_HP).select("doc_id", _pairs(C.high_precision(F.col("t")), "symbol", "stance", "status").alias("claims"))


@query(f"""select doc_id, {_case("doc_id", f"'VGT:SELL_EXECUTED:' || ({Q}) || '.0:' || ({P}) || '.57'", "'VGT:REBALANCE,SGOV:REBALANCE'", "'VGT:COMMENTARY'", "'VGT:HOLD'", "''")} as actions {FROM}""")
def author_actions(spark, sf):
    t = said("doc_id", "今天卖出了部分VGT在[P].57，大约占VGT总仓位的[Q]%", "把一部分VGT转到SGOV，调仓了。", "VGT 是科技指数", "如果下个星期没有触发止盈点，那就继续保持90%仓位在VGT", None)
    return rows(spark, sf, t=t).select("doc_id", _pairs(C.actions(F.col("t"), ["VGT", "SGOV"]), "symbol", "action_type", "size_pct", "price").alias("actions"))


@query(f"""select doc_id, {_case("doc_id", XD + " || ':author_plan:high'", XD + " || ':third_party_example:high'", XD + " || ':unconfirmed_author_context:needs_review'", "''", "''")} as operations, case when doc_id % 5 = 0 then cast({P} as double) end as tier_1 {FROM}""")
def learned_operations(spark, sf):
    t = said("doc_id", "我的做法：[X]第一档[P]，第二档280.5，目标区350到400，不主动加", "巴菲特持有[X]", "[X] 加仓", "nothing here", None)
    o = rows(spark, sf, t=t).select("doc_id", G.operations(F.col("t")).alias("o"))
    first = [c for c in o.schema["o"].dataType.elementType.names if c not in ("symbols", "target_range", "actions", "conditions", "attribution", "attribution_confidence")][0]
    made = F.transform("o", lambda x: F.concat_ws(":", F.get(x["symbols"], F.lit(0)), x["attribution"], x["attribution_confidence"]))
    return o.select("doc_id", F.array_join(made, ",").alias("operations"), F.get("o", F.lit(0))[first].cast("double").alias("tier_1"))


@query(f"""select doc_id, case when doc_id % 3 = 0 then 'do_not_chase' else '' end as rules, case when doc_id % 3 = 0 or n_chars % 4 = 1 then 'admit_wrong' else '' end as lessons {FROM}""")
def learned_rules(spark, sf):
    t = f"concat_ws(chr(10), {pick('doc_id', '这次认错，不追高', 'plain words', None)}, {pick('n_chars', 'more', '看错了', None, '')})"
    return rows(spark, sf, t=t).select("doc_id", F.array_join(G.portfolio_rules(F.col("t")), ",").alias("rules"), F.array_join(G.lessons(F.col("t")), ",").alias("lessons"))


@query(f"""select doc_id, {_case("doc_id", "'ppo_above_signal:false:CONFIRMATION,price_above_ma50:true:CONFIRMATION'", "'supertrend_bullish:true'", "''", "''")} as signals {FROM}""")
def method_signals(spark, sf):
    t = pick("doc_id", "PPO 上穿{chr(10)}Signal 线。突破确认{chr(10)}股价站上 MA50，趋势确认", "{source}{chr(10)}Supertrend 翻多", "{source}", None)
    made = F.transform(G.signals(F.col("t")), lambda x: F.concat_ws(":", x["condition_id"], x["machine_ready"].cast("string"), x["state_hint"]))
    return rows(spark, sf, t=t).select("doc_id", F.array_join(made, ",").alias("signals"))


_THEMED = pick("doc_id", "Intel INTC thesis {source}", "sell put on QQQ", "这次看错了，割肉复盘", "nothing {lang}", "特斯拉 AI 现金 {n_chars}")


@query(f"""select doc_id, array_to_string(case when len({themes_sql(_THEMED)}) > 0 then {themes_sql(_THEMED)} else ['其他研究'] end, ',') as themes {FROM}""")
def theme_rules(spark, sf):
    return rows(spark, sf, t=_THEMED).select("doc_id", F.array_join(G.themes(F.col("t")), ",").alias("themes"))


@query(f"""select doc_id, {_case("doc_id", "false", "false", "true", "true", "false")} as now_named, doc_id % 5 = 4 as mu_named {FROM}""")
def symbol_rules(spark, sf):
    """Tickers that are words count in capitals only, and names of companies by their alias."""
    found = C.symbols(F.col("t"))
    t = said("doc_id", "SMH also flying, [P] now!", 'RSP "must" hold above [P] or dead :)', "ServiceNow looks extended", "NOW is breaking out", "MU up [P], told u guys")
    return rows(spark, sf, t=t).select("doc_id", F.array_contains(found, "NOW").alias("now_named"), F.array_contains(found, "MU").alias("mu_named"))


@query(f"""select doc_id, case when doc_id % 6 < 3 then left(sha1(concat(doc_id, '')), 11) end as id {FROM}""")
def video_ids(spark, sf):
    i = "{substr(sha1(concat(doc_id, '')), 1, 11)}"
    urls = pick("doc_id", f"https://www.youtube.com/watch?v={i}&t=3", f"https://youtu.be/{i}?x", f"https://youtube.com/shorts/{i}", f"https://example.com/{i}", "https://youtu.be/{doc_id}", None)
    return rows(spark, sf, u=urls).select("doc_id", T.video_id(F.col("u")).alias("id"))


@query(f"""select doc_id, case when doc_id % 5 < 3 then make_date(2026, {MONTH}, {DAY}) end as day {FROM}""")
def free_dates(spark, sf):
    m, d = "{" + MONTH + "}", "{" + DAY + "}"
    t = pick("doc_id", f"发表于 2026年{m}月{d}日 上午", f"on 2026-{m}-{d}.", f"{m}/{d}/2026 08:00", "no date in {source}", None)
    return rows(spark, sf, t=t).select("doc_id", T.free_date(F.col("t")).alias("day"))


_SAID = "select event_id as seq, case when event_id % 5 <> 0 then concat('p', event_id % 700) end as post_id, case when event_id % 2 = 0 then upper(event_type) else event_type end as author, concat('2026-01-02 0', user_id % 10, ':04:', 10 + event_id % 50) as time, case when event_id % 9 = 0 then '' else concat('title ', user_id % 40) end as title, case event_id % 4 when 0 then '  ' when 1 then null else 'b' end as body from events"
_KEY = "lower(author) || '|' || left(time, 16) || '|' || left(title, 40)"


@query(f"""with u as ({_SAID}), i as (select * from u where seq % 3 = 0), b as (select *, {_KEY} as k from u where seq % 3 <> 0), s as (select *, row_number() over (partition by post_id order by seq) as n_id, row_number() over (partition by k order by seq) as n_key from b)
select seq, case when post_id is not null and (n_id > 1 or post_id in (select post_id from i where post_id is not null)) or n_key > 1 or k in (select {_KEY} from i) then 'duplicate' when trim(coalesce(body, '')) <> '' then 'new' when title <> '' then 'title_only' else 'body_missing' end as outcome from s""")
def utterance_outcomes(spark, sf):
    """Utterances that come again under their post id or their key, against an index and among themselves."""
    u = spark.sql(_SAID.replace("from events", "from {e}"), e=table(spark, sf, "events"))
    return intake.new_utterances(u.filter("seq % 3 <> 0"), u.filter("seq % 3 = 0")).select("seq", "outcome")


_ARTICLES = "select doc_id as seq, case when doc_id % 13 <> 0 then concat(case when doc_id % 2 = 0 then 'HTTP://H.example/' else 'http://h.example/' end, doc_id % 300, case when doc_id % 3 = 0 then '#f' else '' end) end as url, case when doc_id % 17 = 0 then ' ' else concat('text ', n_chars % 400) end as text from documents where n_chars is not null"


@query(f"""with recursive a as ({_ARTICLES}), s as (select 'http://h.example/' || seq % 300 as u, text from a where seq % 7 = 0), b as (select seq, case when url is not null then 'http://h.example/' || seq % 300 end as u, text, row_number() over (order by seq) as n from a where seq % 7 <> 0),
 k as (select b.*, u in (select u from s) or text in (select text from s) as known, u is not null and trim(text) <> '' as usable from b), f as (select u, text, seq from k where usable and not known), fu as (select u, min(seq) as first from f group by u), ft as (select text, min(seq) as first from f group by text)
select seq, case when k.u is null then 'no_link' when not usable then 'no_text' when known or fu.first < seq or ft.first < seq then 'duplicate' else 'stored' end as outcome from k left join fu on fu.u = k.u left join ft on ft.text = k.text""")
def article_outcomes(spark, sf):
    """Articles whose text or address is stored or came before."""
    a = spark.sql(_ARTICLES.replace("from documents", "from {d}"), d=table(spark, sf, "documents"))
    stored = a.filter("seq % 7 = 0").select(F.expr("concat('http://h.example/', seq % 300)").alias("url"), F.sha2("text", 256).alias("sha256"))
    return intake.article_outcomes(a.filter("seq % 7 <> 0"), stored).select("seq", "outcome")


NOW = "2026-06-10 00:00:00"
_STAMP = pick("doc_id", "2026-{" + MM + "}-{" + DD + "} 08:09:10", "2026-{" + MM + "}-{" + DD + "}T05:06:07Z", "2026-{" + MM + "}-{" + DD + "} 08:09", "2026{" + MM + "}{" + DD + "}", "no date", None, "2026-06-{" + DD + "}", "2026-13-{" + DD + "}")
_SEEN = pick("n_chars", "2026-06-{lpad(concat(1 + doc_id % 12, ''), 2, '0')}T01:00:00Z", "2026-06-{lpad(concat(1 + doc_id % 12, ''), 2, '0')} 10:00:00", "", None, "not a time")
_FOUND = pick("n_chars", "2026-{" + MM + "}-15", None, "x")
_EPOCH = "case when doc_id % 9 <> 0 then n_chars * 86399 end"


@query(f"""with r as (select doc_id, {_STAMP} as t, {_EPOCH} as epoch, {_SEEN} as first_seen, {_FOUND} as discovered {FROM})
select doc_id, case when contains(t, ' ') then try_strptime(substr(t, 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%d']) else try_strptime(substr(t, 1, 10), '%Y-%m-%d') end as stamp,
  case when regexp_matches(t, '^[0-9]{{8}}') then substr(t, 1, 4) || '-' || substr(t, 5, 2) || '-' || substr(t, 7, 2) else '' end as compact, coalesce(strftime(make_timestamp(cast(epoch as bigint) * 1000000), '%Y-%m-%d'), '') as epoch_date,
  coalesce(date_diff('day', try_strptime(substr(t, 1, 10), '%Y-%m-%d'), timestamp '{NOW}') between 0 and 7, false) as recent,
  case when coalesce(first_seen, '') = '' then true else coalesce(epoch(timestamp '{NOW}') - epoch(try_strptime(replace(replace(first_seen, 'T', ' '), 'Z', ''), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])) < 48 * 3600, false) end as on_hold,
  coalesce(case when t like '____-__-__%' then substr(t, 1, 10) end < case when discovered like '____-__-__%' then substr(discovered, 1, 10) end, false) as historical from r""")
def date_forms(spark, sf):
    t, now = F.col("t"), F.lit(NOW).cast("timestamp")
    return rows(spark, sf, t=_STAMP, epoch=_EPOCH, first_seen=_SEEN, discovered=_FOUND).select(
        "doc_id", D.stamp(t).cast("timestamp_ntz").alias("stamp"), F.coalesce(D.compact_date(t), F.lit("")).alias("compact"), D.epoch_date(F.col("epoch")).alias("epoch_date"), D.recent(t, now).alias("recent"),
        D.on_hold(F.col("first_seen"), now).alias("on_hold"), D.historical(t, F.col("discovered")).alias("historical"))


_CLOCK = pick("doc_id", "a {" + MM + "}/{" + DD + "}/2026 postreply08:09:10 {source} 01/02/2026 23:59:59", "13/45/2026 10:00:00", "{source}", None, "12/{" + DD + "}/2025   00:00:01 12/31/2025 00:00:{10 + doc_id % 50}")


@query(f"""with r as (select doc_id, {_CLOCK} as t {FROM}), x as (select doc_id, unnest(regexp_extract_all(t, '\\d{{2}}/\\d{{2}}/\\d{{4}}\\s*(?:postreply)?\\s*\\d{{2}}:\\d{{2}}:\\d{{2}}')) as s from r)
select r.doc_id, max(try_strptime(substr(s, 1, 10) || ' ' || right(s, 8), '%m/%d/%Y %H:%M:%S')) as latest from r left join x using (doc_id) group by r.doc_id""")
def page_clocks(spark, sf):
    return rows(spark, sf, t=_CLOCK).select("doc_id", D.page_clock(F.col("t")).cast("timestamp_ntz").alias("latest"))


_MACRO = ", ".join("case when " + " or ".join(f"contains(lower(t), '{w}')" for w in ws) + f" then '{k}' end" for k, ws in L.MACRO.items())
_TOPICS = f"concat_ws(' ', {pick('doc_id', 'The Federal Reserve and the dollar', 'BTC, gold', None, 'LIQUIDITY and usd')}, {pick('n_chars', 'and CPI', 'soft landing?', None, 'of {source}', 'and fomc')})"


@query(f"with r as (select doc_id, {_TOPICS} as t {FROM}) select doc_id, concat_ws(',', {_MACRO}) as topics from r")
def macro_topics(spark, sf):
    return rows(spark, sf, t=_TOPICS).select("doc_id", F.array_join(L.topics(F.col("t"), L.MACRO), ",").alias("topics"))


_GATE = {"role": pick("doc_id", "rule_supply", "market_context", "other", None), "quality": pick("n_chars", "Q1", "Q2", "Q3", "q4", "Q5", "", None), "origin": pick("doc_id", "captions", "owner_supplied_summary", "gemini_video_understanding", None, "captions"),
         "t": pick("n_chars", "x", "x", "  ", "{source}", None), "allowed": "case n_chars % 3 when 0 then true when 1 then false end", "structured": "case doc_id % 3 when 0 then true when 1 then false end"}


@query(f"""with r as (select doc_id, {', '.join(f'{v} as {k}' for k, v in _GATE.items())} {FROM}), q as (select *, upper(case when coalesce(quality, '') = '' then 'Q5' else quality end) as q from r)
select doc_id, trim(coalesce(t, '')) <> '' and case when origin in ('owner_supplied_summary', 'gemini_video_understanding') then q = 'Q3' and coalesce(structured, false)
  when role = 'rule_supply' then q in ('Q1', 'Q2') and coalesce(allowed, false) when role = 'market_context' then q <> 'Q5' else q in ('Q1', 'Q2') end as admitted from q""")
def content_gate(spark, sf):
    """The gate over all combinations of role, grade, origin and state."""
    return rows(spark, sf, **_GATE).select("doc_id", L.admitted(*(F.col(c) for c in ("role", "quality", "origin", "t", "allowed", "structured"))).alias("admitted"))


_LABEL = {"symbol": pick("event_id", "nvda", "$NVDA", "BRK.B", "TOOLONGX", "", None, "tsla"), "stance": pick("event_id", "buy", "sell", "hold", "maybe", "trim"), "status": pick("event_id", "executed", "planned", "opinion", None, "executed", "conditional"),
          "instrument": pick("event_id", "stock", None, "leaps"), "holder": pick("event_id", "author", None, "nobody", "author", "author_system"), "ticker_source": pick("event_id", "text", "context", None)}


@query(f"""with r as (select user_id, {', '.join(f'{v} as {k}' for k, v in _LABEL.items())} from events), s as (select *, regexp_replace(upper(trim(coalesce(symbol, ''))), '^\\$+', '') as sym from r),
 f as (select *, regexp_matches(sym, '{L.SYMBOL}') {' '.join(f"and coalesce(coalesce(nullif(trim({k}), ''), {repr(L.DEFAULTS.get(k)) if L.DEFAULTS.get(k) else 'null'}) in ({', '.join(map(repr, v))}), false)" for k, v in L.ENUMS.items())} as fits from s)
select user_id, coalesce(string_agg(distinct sym || ':' || stance || ':' || status, ',' order by sym || ':' || stance || ':' || status) filter (fits), '') as labels, count(*) filter (not fits) as dropped from f group by user_id""")
def label_validation(spark, sf):
    """Labels of a user's events that fit the schema, and how many don't."""
    e = table(spark, sf, "events").select("user_id", F.struct(*(F.expr(v).alias(k) for k, v in _LABEL.items())).alias("x"))
    g = e.groupBy("user_id").agg(F.collect_list("x").alias("x")).withColumn("c", L.clean_labels(F.col("x")))
    return g.select("user_id", F.array_join(F.array_sort(F.transform("c.labels", lambda s: F.concat_ws(":", s["symbol"], s["stance"], s["status"]))), ",").alias("labels"), F.col("c.dropped").alias("dropped"))


@query(f"""select doc_id, doc_id % 4 not in (1, 3) as harmless, n_chars % 4 in (0, 1) as paused, doc_id % 3 <> 2 as members, {_case("n_chars", XD, "'BRK.B'", "null", "null", "null")} as shaped {FROM}""")
def output_shapes(spark, sf):
    inputs = {"action": pick("doc_id", "none", " BUY ", None, "sell"), "url": pick("n_chars", "https://bbs.board.example/{doc_id}", "https://board.example", "https://notboard.example/", "http://BBS.BOARD.EXAMPLE:80/"), "title": pick("doc_id", "Weekly members-only {source}", "（会员第{doc_id}期）", "open {source}"),
              "symbol": pick("n_chars", "$${lower(" + X + ")}", "BRK.B", "not a symbol", "1AB", None)}
    return rows(spark, sf, **inputs).select("doc_id", L.harmless(F.col("action"), ["buy", "sell"]).alias("harmless"), L.paused(F.col("url"), F.lit("2026-11-01").cast("date"), "2026-12-01", "board.example").alias("paused"),
                                            L.members_only(F.col("title")).alias("members"), L.symbol(F.col("symbol")).alias("shaped"))


_GRADED = {"domain": pick("doc_id", "a.example", "b.example", "c.example", None), "t": f"concat(repeat('x', cast(n_chars % 2500 as int)), {pick('doc_id', ' full transcript', ' at 1:02:03 we', ' show notes', ' plain', '')})"}


@query(f"""with r as (select doc_id, {_GRADED['domain']} as domain, {_GRADED['t']} as t {FROM}) select doc_id, case when domain = 'a.example' and length(t) >= 1800 and (doc_id % 5 in (0, 1)) then 'Q2' when domain = 'b.example' and length(t) >= 650 and doc_id % 5 in (1, 2) then 'Q3' when length(t) >= 500 then 'Q4' else 'Q5' end as grade from r""")
def transcript_grades(spark, sf):
    return rows(spark, sf, **_GRADED).select("doc_id", L.grade(F.col("domain"), F.col("t"), ["a.example"], ["b.example"]).alias("grade"))


@query(f"""select doc_id, doc_id % 4 in (0, 1) as identified {FROM}""")
def page_identity(spark, sf):
    """A page is about a title if it holds two of its words, or its author's name."""
    df = rows(spark, sf, title=pick("doc_id", "Market Outlook {doc_id} {source}", "Market Outlook", "Market Outlook", ""), author=pick("doc_id", "Jo / team", "Jo {source}/x", "", ""), page=pick("doc_id", "the MARKET has an outlook in {n_chars}", "by jo {source}", "market only", "anything of {source}"))
    return df.select("doc_id", F.coalesce(L.identified(F.col("title"), F.col("author"), F.col("page")), F.lit(False)).alias("identified"))


@query(f"""select doc_id, {_case("doc_id", "source || chr(10) || 'more'", "source || chr(10) || 'too'", "''", "''", "source")} as own {FROM}""")
def reply_own_words(spark, sf):
    lines = pick("doc_id", "本帖于 2026-01-01 由 x 编辑|{source} ||more", "回答:|some parent|由 who|于|2026-01-02 03:04:05|{source}| too ", "回答：|parent|no end", "", "回答:|于|2026-01-02 03:04|{source}")
    return rows(spark, sf, lines=lines).select("doc_id", L.own_words(F.split("lines", "\\|")).alias("own"))


@query(f"""select doc_id, {_case("doc_id", "source", "source || chr(10) || lang", "source", "chr(10) || lang")} as text, {_case("n_chars", "lang || ': P' || doc_id", "'None: P' || doc_id", "null", "null")} as context {FROM}""")
def model_items(spark, sf):
    df = rows(spark, sf, a=pick("doc_id", "{source}", "{source}", " {source} ", None), b=pick("doc_id", "{source}", " {lang} ", None, "{lang}"), c=pick("n_chars", "{lang}", None, "{lang}", "{lang}"), d=pick("n_chars", "P{doc_id}", "P{doc_id}", "", None))
    return df.select("doc_id", L.model_item(*(F.col(x) for x in "abcd")).alias("m")).select("doc_id", "m.text", "m.context")


_SHOWN = {"status": "case when doc_id % 5 = 0 then 404 else 200 end", "parsed": "doc_id % 7 <> 0", "page_author": "case when doc_id % 3 = 0 then upper(source) when doc_id % 3 = 1 then source when n_chars % 2 = 0 then 'other' end", "author": "case when doc_id % 11 <> 0 then source end", "chars": "case when n_chars % 4 > 1 then n_chars end", "images": "case when n_chars % 4 = 1 then 2 when n_chars % 4 = 2 then 1 end"}


@query(f"""with r as (select doc_id, {', '.join(f'{v} as {k}' for k, v in _SHOWN.items())} {FROM})
select doc_id, case when status <> 200 then 'http_error' when not parsed then 'selector_miss' when lower(coalesce(page_author, '')) <> lower(coalesce(author, '')) then 'author_mismatch' when chars > 0 then 'body_now_present' when images > 0 then 'image_only' else 'genuinely_empty' end as reason from r""")
def title_only_reason(spark, sf):
    return rows(spark, sf, **_SHOWN).select("doc_id", L.page_class(*(F.col(c) for c in _SHOWN)).alias("reason"))


@query(f"""select doc_id, {_case("doc_id", "'topic'", "'markdown'", "'html'", "'jsonl'", "'unknown'", "'markdown'")} as kind {FROM}""")
def export_kinds(spark, sf):
    df = rows(spark, sf, name=pick("doc_id", "{doc_id}.md", "{doc_id}.MD", "{doc_id}.htm", "{doc_id}.jsonl", "{doc_id}.bin", "{doc_id}.txt"), t=pick("doc_id", "**楼主**{chr(10)}## 主帖 {source}{chr(10)}## 跟帖", "{source}", "<p>", "x", None, "**楼主**"))
    return df.select("doc_id", L.sniffed(F.col("name"), F.col("t")).alias("kind"))


_SUMMARY = "concat('- ', " + X + ", '：看好到 ', " + P + ", chr(10), '- 目标价提高到 ', " + P + ", '；AI 需求强劲 ', " + Q + ", '%', chr(10), '无关的一行文字', chr(10), '1. ', " + Y + ", ' 风险较大的')"


@query(f"""select doc_id, unnest([0, 1, 2, 3]) as n, unnest([{XD} || '：看好到 ' || ({P}), '目标价提高到 ' || ({P}), 'AI 需求强劲 ' || ({Q}) || '%', {YD} || ' 风险较大的']) as claim, unnest([{XD}, null, null, {YD}]) as symbol, unnest([null, {XD}, {XD}, null]) as context_symbol {FROM}""")
def summary_claims(spark, sf):
    found = L.summary_claims(F.col("t"), ["AI"])
    return rows(spark, sf, t=_SUMMARY).select("doc_id", F.posexplode(found).alias("n", "c")).select("doc_id", "n", "c.claim", "c.symbol", "c.context_symbol")


@query(f"""select doc_id, {_case("doc_id", f"'2026-' || {MM} || '-' || {DD}", f"'2026-' || {MM} || '-' || {DD}", "strftime(make_timestamp(cast(n_chars as bigint) * 86400 * 1000000), '%Y-%m-%d')", "strftime(make_timestamp(cast(n_chars as bigint) * 86400 * 1000000), '%Y-%m-%d')", "''")} as published {FROM}""")
def entry_dates(spark, sf):
    """The publication date of a listing's entry, from whichever field has one."""
    df = rows(spark, sf, a=pick("doc_id", "2026-{" + MM + "}-{" + DD + "}T03:04:05Z", None, "", None, None), b=pick("doc_id", "bad", "2026{" + MM + "}{" + DD + "}", "bad", None, None), c="case when doc_id % 5 = 2 then n_chars * 86400 end", d="case when doc_id % 5 = 3 then n_chars * 86400 end")
    return df.select("doc_id", D.first_date(F.substring("a", 1, 10), D.compact_date(F.col("b")), D.epoch_date(F.col("c")), D.epoch_date(F.col("d"))).alias("published"))


@query(f"""select doc_id, unnest(case when doc_id % 3 = 0 then ['v' || doc_id, 'w' || n_chars] else [] end) as video_id, unnest(case when doc_id % 3 = 0 then ['2026-' || {MM} || '-' || {DD}, ''] else [] end) as published {FROM}""")
def feed_entries(spark, sf):
    """Entries of an Atom text by id; entries without one, and texts that are none, are left out."""
    from sievework.sources.parse import atom_entries

    t = pick("doc_id", "<feed><entry><yt:videoId>v{doc_id}</yt:videoId><published>2026-{" + MM + "}-{" + DD + "}</published><title>T &amp; U</title></entry><entry><published>x</published></entry><entry><yt:videoId>w{n_chars}</yt:videoId></entry></feed>", None, "not xml {source}")
    return rows(spark, sf, t=t).select("doc_id", F.explode(atom_entries(F.col("t"))).alias("e")).select("doc_id", "e.video_id", "e.published")


_B = "concat('https://b.example/inv/', doc_id * 10"
_TOPIC = f"""concat('# Root ', doc_id, chr(10), chr(10), '- **楼主**：Jo　**时间**：2025-12-30 09:10', chr(10), '- **参与的目标用户**：Jo, Al', chr(10), '- **链接**：https://b.example/inv/', doc_id * 10, '.html', chr(10), chr(10), '## 主帖', chr(10), chr(10), 'text of ', source, chr(10), chr(10), '## 跟帖', chr(10), chr(10),
 '- [first](https://b.example/inv/', doc_id * 10 + 1, '.html) — **Al** ⭐ 12-30 10:00 (7 bytes)', chr(10), '  > own words ', n_chars, chr(10), '  - [second](https://b.example/inv/', doc_id * 10 + 2, '.html) — Zed 01-02 11:00', chr(10), '    > not a target', chr(10),
 '    - [third](https://b.example/inv/', doc_id * 10 + 3, '.html) — **Al** ⭐ 01-03 12:00', chr(10), '- [fourth](https://b.example/inv/', doc_id * 10 + 4, '.html) — **Jo** ⭐ 01-04 13:00 (9 bytes)', chr(10))"""


@query(f"""select doc_id, cast(doc_id * 10 + unnest([0, 1, 3, 4]) as varchar) as post_id, unnest(['post', 'reply', 'reply', 'reply']) as kind, unnest(['2025-12-30 09:10:00', '2025-12-30 10:00:00', '2026-01-03 12:00:00', '2026-01-04 13:00:00']) as published_at,
 unnest(['Root ' || doc_id || chr(10) || 'text of ' || source, 'first' || chr(10) || 'own words ' || n_chars, 'third', 'fourth']) as text, unnest(['body_exported', 'body_exported', 'title_only', 'body_missing']) as body_status,
 unnest([null, cast(doc_id * 10 as varchar), cast(doc_id * 10 + 2 as varchar), cast(doc_id * 10 as varchar)]) as parent_id from documents where n_chars is not null and doc_id > 0 and doc_id % 4 <> 3""")
def topic_entries(spark, sf):
    """What target authors said in exported topics; other texts give nothing."""
    from sievework.sources import threads

    docs = table(spark, sf, "documents").filter("n_chars is not null and doc_id > 0").select("doc_id", F.expr(f"case when doc_id % 4 <> 3 then {_TOPIC} else concat('# ', source) end").alias("t"))
    return threads.topics(docs, "doc_id", "t").select("doc_id", "post_id", "kind", "published_at", "text", "body_status", F.col("parent.post_id").alias("parent_id"))


_SRC, _NUM = "coalesce(source, 'none')", "coalesce(cast(n_chars as string), 'none')"
_DIGEST = f"""concat('# Jo 的发言整理', chr(10), chr(10), '## Topic ', {_SRC}, chr(10), '楼主 Jo · 2026-01-02 03:04 · [原帖](https://b.example/inv/', doc_id, '.html)', chr(10), '### 2026-01-02 03:04 · Topic ', {_SRC}, chr(10), 'body ', {_NUM}, chr(10), chr(10),
 '![image](https://b.example/i.png)', chr(10), '### 2026-01-02 05:06 · Re one', chr(10), '> 回复 Al「Some title」：quoted', chr(10), 'answer ', {_NUM}, chr(10), '### 2026-01-03 05:06 · Re two', chr(10), '（标题即全文）', chr(10), '### 2026-01-02 05:06 · Re three', chr(10),
 '## Topic B', chr(10), '### 2026-01-03 01:01 · no root yet', chr(10), 'lost', chr(10), '楼主 Al · 2026-01-03 00:00 · [原帖](https://b.example/inv/9', doc_id, '.html)', chr(10), '### 2026-01-03 02:02 · Hm', chr(10), '（正文未抓到，见原帖）', chr(10))"""


@query(f"""with d as (select doc_id, cast(doc_id as varchar) as k, {_SRC} as s, {_NUM} as n from documents)
select doc_id, unnest([k, k || 'r202601020506', k || 'r202601030506', k || 'r202601020506', '9' || k || 'r202601030202']) as id_begin, unnest([length(k), length(k) + 22, length(k) + 17, length(k) + 22, length(k) + 18]) as id_chars, unnest(['post', 'reply', 'reply', 'reply', 'reply']) as kind,
 unnest(['2026-01-02 03:04:00', '2026-01-02 05:06:00', '2026-01-03 05:06:00', '2026-01-02 05:06:00', '2026-01-03 02:02:00']) as published_at, unnest(['Topic ' || s || chr(10) || 'body ' || n, 'Re one' || chr(10) || 'answer ' || n, 'Re two', 'Re three', 'Hm']) as text,
 unnest(['body_exported', 'body_exported', 'title_only', 'title_only', 'body_missing']) as body_status, unnest([strlen('body ' || n), strlen('answer ' || n), 0, 0, 0]) as body_bytes, unnest([null, 'Al', 'Jo', 'Jo', 'Al']) as parent_author, unnest([null, 'Some title', 'Topic ' || s, 'Topic ' || s, 'Topic B']) as parent_title from d""")
def digest_entries(spark, sf):
    """What an author said, out of the digests of all documents: two topics, two replies of one minute, texts that are whole,
    in the title only or missing."""
    from sievework.sources import threads

    docs = table(spark, sf, "documents").select("doc_id", F.expr(_DIGEST).alias("t"))
    return threads.digests(docs, "doc_id", "t").select(
        "doc_id", F.regexp_extract("post_id", r"^(\d+(?:r\d{12})?)", 1).alias("id_begin"), F.length("post_id").cast("long").alias("id_chars"), "kind", "published_at", "text", "body_status", "body_bytes", F.col("parent.author").alias("parent_author"), F.col("parent.title").alias("parent_title"))


_L, _R, _QQ, _BS = "{chr(123)}", "{chr(125)}", "{chr(34)}", "{chr(92)}"


@query(f"""select doc_id, {_case("doc_id", "chr(123) || '\"a\": ' || doc_id || ',' || chr(10) || '\"b\": \"' || source || '\"' || chr(125)", "null", "null", "null")} as inner_json {FROM}""")
def nested_answers(spark, sf):
    """The JSON that the texts inside an answer's JSON hold together."""
    e = _BS + _QQ
    one = f"{_L}{_QQ}parts{_QQ}: [{_L}{_QQ}text{_QQ}: {_QQ}so: {_L}{e}a{e}: {{doc_id}},{_QQ}{_R}, {_L}{_QQ}text{_QQ}: {_QQ} {_QQ}{_R}, {_L}{_QQ}text{_QQ}: {_QQ}{e}b{e}: {e}{{source}}{e}{_R} done{_QQ}{_R}]{_R}"
    return rows(spark, sf, j=pick("doc_id", one, f"{_L}{_QQ}text{_QQ}: {_QQ}no braces {{source}}{_QQ}{_R}", None, "not json {source}")).select("doc_id", A.inner_json(F.col("j")).alias("inner_json"))


@query(f"""select doc_id, {XD} || ':listed,AMD:not_in_symbols,:' as claims, '[Gemini 视频理解 · 未验证] S' || doc_id || chr(10) || '- [' || {XD} || ' buy] up ' || source || chr(10) || '- [1:02 AMD] c2' || chr(10) || '- [] c3' || chr(10) || '宏观：CPI ' || n_chars || '（预期 —）May' as text {FROM}""")
def model_answers(spark, sf):
    """Claims and the text of answers: a symbol that the answer doesn't list is marked, one that is none is dropped."""
    j = f"to_json(named_struct('summary_zh', concat(' S', doc_id, ' '), 'symbols', array(concat('$', lower({X}))), 'claims', array(named_struct('claim', concat(' up ', source, ' '), 'symbol', {X}, 'stance', 'buy', 'price', '', 'timestamp', cast(null as string)), named_struct('claim', ' ', 'symbol', '', 'stance', '', 'price', '', 'timestamp', ''), " \
        "named_struct('claim', 'c2', 'symbol', 'amd', 'stance', '', 'price', '', 'timestamp', '1:02'), named_struct('claim', 'c3', 'symbol', 'no symbol!', 'stance', '', 'price', '', 'timestamp', '')), 'macro', array(named_struct('indicator', 'CPI', 'value', concat(n_chars, ''), 'period', 'May'), named_struct('indicator', cast(null as string), 'value', '9', 'period', ''))))"
    r = rows(spark, sf, j=j).withColumn("a", F.from_json("j", A.ANSWER))
    tags = F.transform(A.model_claims(F.col("a")), lambda c: F.concat(F.coalesce(c["symbol"], F.lit("")), F.lit(":"), F.coalesce(c["symbol_check"], F.lit(""))))
    return r.select("doc_id", F.array_join(tags, ",").alias("claims"), A.rendered(F.col("a")).alias("text"))


_SUM = "grows {n_chars} percent; margins of the maker {source} rise and more is said here"


@query(f"""with r as (select *, left(sha1(concat(doc_id, '')), 11) as id, 'grows ' || n_chars || ' percent; margins of the maker ' || source || ' rise and more is said here' as s {FROM})
select doc_id, case when doc_id % 6 < 2 then id end as video_id, case doc_id % 6 when 0 then s when 1 then s || chr(10) || 'see   end' end as summary, {_case("doc_id", "null", "null", "'no_command'", "'no_link'", "'too_short'", "'no_command'")} as reason from r""")
def summary_commands(spark, sf):
    i = "{substr(sha1(concat(doc_id, '')), 1, 11)}"
    t = pick("doc_id", f"/yt https://youtu.be/{i}?t=5 {_SUM}", f"/YT {_SUM}{{chr(10)}}see https://www.youtube.com/watch?a=1&v={i}&t=9 end", "hello {source}", "/yt no link {source}", f"/yt https://youtu.be/{i} short", None)
    return rows(spark, sf, t=t).select("doc_id", A.command(F.col("t")).alias("c")).select("doc_id", "c.*")


@query(f"""with r as (select doc_id, {XD} || ' grows ' || ({P}) || ' percent' as a, 'margins rise ' || ({Q}) || ' points' as b, {XD} as x {FROM}) select doc_id, '[Owner 提交摘要 · 未核实] ' || a || chr(10) || b || chr(10) || '- [' || x || '] ' || a || chr(10) || '- [' || x || '] ' || b as text from r""")
def submission_texts(spark, sf):
    t = said("0", "[X] grows [P] percent{chr(10)}margins rise [Q] points")
    return rows(spark, sf, t=t).select("doc_id", A.submission_text(F.col("t"), L.summary_claims(F.col("t"), ["AI"])).alias("text"))


_FETCH = {"t": pick("doc_id", "{source}", "", "{source}", None), "s": pick("doc_id", "available", None, None, "blocked"), "bare": "doc_id % 4 < 2", "q": pick("doc_id", None, None, "Q2", None)}


@query(f"""select doc_id, {_case("doc_id", "'available'", "'metadata_only'", "'metadata_only'", "'blocked'")} as status, {_case("doc_id", "'Q1'", "'Q5'", "'Q2'", "'Q5'")} as quality, case when doc_id % 4 = 0 then 'injected_test' else 'metadata_only' end as provider, doc_id % 4 = 0 as allowed, case when doc_id % 2 = 0 then length(source) else 0 end as chars {FROM}""")
def fetch_results(spark, sf):
    r = rows(spark, sf, **_FETCH)
    return r.select("doc_id", A.fetch_result(F.col("t"), F.col("s"), F.col("bare"), quality=F.col("q")).alias("f")).select("doc_id", "f.status", "f.quality", "f.provider", F.col("f.rule_candidate_allowed").alias("allowed"), "f.chars")


@query(f"""select doc_id, 'reply-' || case when doc_id % 4 <> 3 then 'k' || doc_id else '' end as id, {_case("n_chars", f"'2026-' || {MM} || '-' || {DD} || ' 03:04:05'", "'yesterday'", "''")} as date, {_case("doc_id", "source", "''", "''")} as text {FROM}""")
def listed_replies(spark, sf):
    r = rows(spark, sf, k="case when doc_id % 4 <> 3 then concat('k', doc_id) end", title=pick("doc_id", "{source}", None, ""), t=pick("n_chars", "{" + MM + "}/{" + DD + "}/2026 03:04:05", "yesterday", None))
    return r.select("doc_id", A.listed_reply(F.lit("Jo"), F.col("k"), F.lit("u"), F.col("title"), F.col("t"), F.lit(None)).alias("p")).select("doc_id", "p.id", "p.date", "p.text")


@query(f"""select doc_id, case when doc_id % 3 = 0 then '0:' || {XD} || ':true,1:' || {YD} || ':false,2::true' else '' end as places, case when doc_id % 3 = 0 then 3 else 0 end as total, case when doc_id % 3 = 0 then '0' else '' end as claimed, case when doc_id % 3 = 0 then '1' else '' end as missed {FROM}""")
def sentence_locators(spark, sf):
    t = said("doc_id", "今天我买入[X]，长期看好。今天天气不错，提到[Y]而已。我准备加仓了啊。", "Nothing of note in {source} at all.", None)
    r = rows(spark, sf, t=t).select("doc_id", C.locators(F.col("t")).alias("l"), C.review_material(F.col("t")).alias("m"))
    shown = F.transform("l.places", lambda x: F.concat_ws(":", x["i"], F.array_join(x["symbols"], "+"), x["stance_cue"]))
    number = lambda c: F.array_join(F.transform(c, lambda x: x["i"].cast("string")), ",")
    return r.select("doc_id", F.array_join(shown, ",").alias("places"), F.col("l.total").alias("total"), number("m.claimed").alias("claimed"), number("m.missed").alias("missed"))


_RECORD = {"published_at": pick("n_chars", "2026-01-05 01:02:03", "2025-01-05", None, "2026-01-06"), "captured_at": "'2026-01-06T00:00:00Z'", "title": _HP, "excerpt": pick("doc_id", "{source}", None)}
_FLAGS = {"first_seen": pick("doc_id", "2026-01-06T00:00:00Z", "2025-01-01T00:00:00Z", ""), "provenance": "'live'", "exclude": "case doc_id % 7 when 0 then true when 1 then false end"}


@query(f"""with r as (select *, doc_id % 5 <> 0 as flagged {FROM}) select doc_id as record_id, {XD} as symbol, case when doc_id % 4 = 0 then 'buy' else 'bullish' end as stance, case when flagged then 'live' else 'unaudited' end as provenance
 from r where doc_id % 4 in (0, 2) and n_chars % 4 in (0, 3) and (not flagged or doc_id % 7 <> 0 and doc_id % 3 <> 1)""")
def claim_export(spark, sf):
    """Distinct claims of recent records that no flag excludes."""
    records = rows(spark, sf, **_RECORD).withColumnRenamed("doc_id", "id").withColumns({"author": F.lit("Jo"), "url": F.lit("u")})
    flags = rows(spark, sf, **_FLAGS).filter("doc_id % 5 <> 0").withColumnRenamed("doc_id", "id")
    return C.exported(records, flags, F.lit("2026-01-10 00:00:00").cast("timestamp"), 14).select("record_id", "symbol", "stance", "provenance")


#: Cues of the claims below, the first that matches counts.
CUES = [(r"(?i)\b(?:won't|not|never) sell", "hold"), (r"(?i)\bbought|\bbuying", "buy"), (r"(?i)\badded|\badding", "add"), (r"(?i)\bsold|\bselling", "sell"), (r"(?i)\btrim", "trim"), (r"(?i)\bhold", "hold"), (r"(?i)\bavoid", "avoid")]


@query(f"""select doc_id, {_case("doc_id", "'ABC:buy:false,ABC:add:true,XYZ:trim:false'", "'ABC:hold:false'", "''", "''")} as claims {FROM}""")
def claims_fixture(spark, sf):
    """Claims under cues of the caller's own."""
    t = pick("doc_id", "I bought ABC for {n_chars} today. If ABC falls I am adding more! What about XYZ? I trim XYZ now.", "They say he sold XYZ. I will never sell ABC.", "Nothing of {source} here at all.", None)
    found = extract.claims(T.sentences(F.coalesce("t", F.lit("")), "。！？；!?;"), lambda s: extract.detect(s, {}, ["ABC", "XYZ"]), CUES, skip=r"(?i)\bthey say\b", unless=r"\bI\b")
    return rows(spark, sf, t=t).select("doc_id", F.array_join(F.transform(found, lambda c: F.concat_ws(":", c["symbol"], c["stance"], c["conditional"].cast("string"))), ",").alias("claims"))
