"""Queries of sample pools, admissions, run budgets, archive probes and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import claims as C
from sievework.functions import extract as X
from sievework.functions import labels as L
from sievework.operators import backlog, intake, records, report, sample, sets
from sievework.plans.intake import themes_sql
from sievework.plans.laid import FROM, XD, rows, said
from sievework.plans.registry import pick, query, table
from sievework.sources.parse import clean_text

MARKERS = ("home", "pricing", "log in", "sign up")
_PROBE = {
    "author": "source", "role": pick("n_chars", "rule_supply", "market_context"), "video_id": "concat('v', doc_id)", "title": "concat('About ', lang)", "quality": pick("n_chars", "Q1", "Q2", "Q3", None, "Q1"), "provider": "'p'", "content_origin": "'captions'",
    "text": said("doc_id", "intro{chr(10)}我的做法：[X]第一档[P]，目标区350到400，不主动加{chr(10)}CPI and {source}", "巴菲特持有[X]{chr(10)}今天我买入[X]，长期看好。", "Home Pricing Log in {source}", "NOW is breaking out in {source}", None),
}
_TEXT = f"case doc_id % 5 when 0 then '我的做法：' || {XD} || '第一档' || (100 + n_chars % 800) || '，目标区350到400，不主动加' || chr(10) || 'CPI and ' || source when 1 then '巴菲特持有' || {XD} || chr(10) || '今天我买入' || {XD} || '，长期看好。' when 2 then 'Home Pricing Log in ' || source when 3 then 'NOW is breaking out in ' || source else '' end"


@query(f"""with r as (select *, {_TEXT} as seen, doc_id % 5 = 2 as plate, case when doc_id % 5 = 2 then 'Q5' else coalesce(case n_chars % 5 when 0 then 'Q1' when 1 then 'Q2' when 2 then 'Q3' when 4 then 'Q1' end, 'Q5') end as quality {FROM}),
 e as (select *, quality in ('Q1', 'Q2') and seen <> '' as ok from r), t as (select *, 'About ' || lang || chr(10) || seen as told from e)
select 'yt_hist_' || left(sha256('v' || doc_id), 16) as archive_id, quality, ok as eligible, length(seen) as text_chars_seen, case when seen <> '' then sha256(seen) end as text_hash, plate as provider_boilerplate,
 case when not ok then '' when doc_id % 5 < 2 then {XD} when doc_id % 5 = 3 and n_chars % 2 = 0 then 'NOW' else '' end as symbols, case when not ok then '' else array_to_string(case when len({themes_sql('told')}) > 0 then {themes_sql('told')} else ['其他研究'] end, ',') end as themes,
 case when ok and doc_id % 5 = 0 then 1 else 0 end as n_operations, case when ok and doc_id % 5 = 1 then {XD} || ':buy' else '' end as claims from t""")
def archive_probe(spark, sf):
    """Archive rows of probed videos: what may be learned from them, and nothing of their wording."""
    r = records.probes(rows(spark, sf, **_PROBE), ["intro"], list(MARKERS), "now")
    return r.select("archive_id", "quality", F.col("historical_learning_eligible").alias("eligible"), "text_chars_seen", "text_hash", "provider_boilerplate", F.array_join("symbols", ",").alias("symbols"), F.array_join("themes", ",").alias("themes"),
                    F.size("operations").alias("n_operations"), F.array_join(F.transform("claims", lambda c: F.concat_ws(":", c["symbol"], c["stance"])), ",").alias("claims"))


@query(f"""select doc_id, n_chars % 4 <> 3 and doc_id % 3 <> 2 or n_chars % 5 = 0 as has_ticker, concat_ws(',', case when doc_id % 4 in (0, 2, 3) then null else 'url_shape' end, case when doc_id % 3 = 0 then null else 'author_mismatch' end, case when n_chars % 6 = 0 then 'no_title' end) as refused {FROM}""")
def record_admission(spark, sf):
    """Whether a record names anything to score, and why a single post would be refused."""
    df = rows(spark, sf, symbols="case when n_chars % 4 = 3 then null when doc_id % 3 = 2 then array() else array('A') end", claims="case when n_chars % 5 = 0 then array(1) end", url=pick("doc_id", "https://b.example/inv/{doc_id}.html", "https://b.example/{source}", "http://b.example/x/{n_chars}.html", "https://b.example/y/7.html"),
              author=pick("doc_id", " {upper(source)}", "other", None), wanted="source", title=pick("n_chars", " ", "t", "t", "t", "t", "t"))
    return df.select("doc_id", L.has_ticker(F.col("symbols"), F.col("claims")).alias("has_ticker"), F.array_join(L.refusals(F.col("author"), F.col("wanted"), F.col("url"), r"^https?://[^/]+/\w+/\d+\.html$", F.col("title")), ",").alias("refused"))


@query("""with u as (select user_id from events where event_type = 'signup' and value > 60), r as (select event_id, case when value is null or value < 5 then 'too_short' when user_id in (select user_id from u) then 'used_before' when event_type = 'error' then 'error' when event_id % 10 = 0 then 'ambiguous' end as reason from events)
select coalesce(reason, 'in_pool') as reason, count(*) as n from r group by 1""")
def pool_reasons(spark, sf):
    """What keeps events out of a sample pool, by the first reason that holds."""
    e = table(spark, sf, "events")
    used = e.filter("event_type = 'signup' and value > 60").select("user_id").distinct().withColumn("_used", F.lit(True))
    p = sample.pooled(e.join(used, "user_id", "left"), too_short=F.col("value").isNull() | (F.col("value") < 5), used_before=F.col("_used"), error=F.col("event_type") == "error", ambiguous=F.col("event_id") % 10 == 0)
    return p.groupBy(F.coalesce("reason", F.lit("in_pool")).alias("reason")).agg(F.count("*").alias("n"))


@query("""with r as (select distinct lang, 'u' || n_chars as url from documents where n_chars is not null), q as (select *, row_number() over (partition by lang order by sha256('133|' || url), url) as k from r)
select lang, url from q where k <= case lang when 'en' then 12 when 'de' then 5 when 'fr' then 300000 else 0 end""")
def author_draws(spark, sf):
    """So many addresses of each language, drawn by their hash."""
    d = table(spark, sf, "documents").filter("n_chars is not null").select("lang", F.concat(F.lit("u"), "n_chars").alias("url"))
    return sample.drawn(d, "lang", "url", "133", {"en": 12, "de": 5, "fr": 300000})


@query("""with recursive c as (select event_id, cast(ts as date) as day, hour(ts) as run, row_number() over (partition by cast(ts as date) order by ts, event_id) as i from events),
 w as (select distinct day, 0 as i, -1 as run, 0::bigint as used, 0 as mine, null::bigint as event_id, false as ok from c
  union all select c.day, c.i, c.run, used + case when good then 1 else 0 end, case when c.run <> w.run then 0 else mine end + case when good then 1 else 0 end, c.event_id, good
  from w join c on c.day = w.day and c.i = w.i + 1, lateral (select used < 30 and case when c.run <> w.run then 0 else mine end < 2 as good) as g) select event_id, ok as allowed from w where i > 0""")
def run_budgets(spark, sf):
    """Two calls of each hourly run, as long as the day has had fewer than thirty."""
    e = table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"), F.hour("ts").alias("run"))
    return backlog.within_runs(e, "day", "run", ["ts", "event_id"], 30, 2).select("event_id", "allowed")


@query(f"""select doc_id, case doc_id % 4 when 0 then 'SGOV=' || (10 + doc_id % 9) || '.0,VGT=' || (10 + n_chars % 80) || '.5' when 1 then 'VGT=' || (1 + doc_id % 9) || '.0' when 2 then '' end as shares {FROM}""")
def allocation_maps(spark, sf):
    """Shares of tracked symbols as a map: the share stands before or behind the symbol."""
    df = rows(spark, sf, t=said("doc_id", "继续持有{10 + n_chars % 80}.5% VGT、SGOV 仓位 {10 + doc_id % 9}%。", "VGT总仓位的[Q]%", "VGT 是科技指数 {source}", None)).withColumn("m", C.allocation(F.col("t"), ["VGT", "SGOV"]))
    return df.select("doc_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("shares"))


@query("""select '{"total":{"records":' || count(*) || ',"authors":' || count(distinct source) || '},"by_lang":[' || (select string_agg('{"lang":"' || lang || '","n":' || n || ',"longest":' || m || '}', ',' order by lang) from (select lang, count(*) as n, max(n_chars) as m from documents where lang is not null group by lang)) || ']}' as report from documents""")
def json_report(spark, sf):
    """A run's report as one JSON text: totals, and counts by language."""
    d = table(spark, sf, "documents")
    return report.as_json(total=d.agg(F.count("*").alias("records"), F.count_distinct("source").alias("authors")), by_lang=d.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest")))


_ROUTED = {"domain": pick("doc_id", "a.example", "b.example", "c.example", None), "text": f"concat(' ', repeat('x', cast(n_chars % 2500 as int)), {pick('doc_id', ' full transcript', ' at 1:02:03 we', ' show  notes', ' plain', '')}, chr(13))", "priority": "doc_id % 3"}


@query(f"""with r as (select source, {_ROUTED['domain']} as domain, {_ROUTED['priority']} as priority, repeat('x', cast(n_chars % 2500 as int)) || case doc_id % 5 when 0 then ' full transcript' when 1 then ' at 1:02:03 we' when 2 then ' show notes' when 3 then ' plain' else '' end as t, doc_id % 5 as m {FROM}),
 c as (select source, domain, priority, m, trim(t) as t from r), g as (select *, case when domain = 'a.example' and length(t) >= 1800 and m in (0, 1) then 'Q2' when domain = 'b.example' and length(t) >= 650 and m in (1, 2) then 'Q3' when length(t) >= 500 then 'Q4' else 'Q5' end as q from c),
 b as (select *, row_number() over (partition by source order by q, priority, domain nulls last, sha256(t)) as n from g)
select source, case when q = 'Q5' then 'metadata_only' else 'available' end as status, q as quality, case when q = 'Q5' then 'metadata_only' else coalesce(domain, '') end as provider, case when q = 'Q5' then '' else t end as text, m = 1 as timestamp_evidence, q = 'Q2' as rule_allowed, case when q = 'Q5' then 0 else length(t) end as chars from b where n = 1""")
def routed_transcripts(spark, sf):
    """The best text of each source out of what several providers gave."""
    d = table(spark, sf, "documents").filter("n_chars is not null").select("source", *(F.expr(v).alias(k) for k, v in _ROUTED.items()))
    return intake.routed(d, "source", ["a.example"], ["b.example"])


@query(f"""select doc_id, doc_id % 4 = 1 and n_chars % 5 <> 3 or doc_id % 4 in (0, 2) and n_chars % 5 = 0 as title_only, doc_id % 3 <> 1 and n_chars % 6 < 4 as checkable {FROM}""")
def record_states(spark, sf):
    """Records with a title only, and claims that can be scored."""
    df = rows(spark, sf, excerpt=pick("doc_id", "  ", None, "", "{source}"), chars="case when doc_id % 4 = 1 then case n_chars % 5 when 3 then 7 when 4 then null else 0 end else n_chars % 5 end", question="case doc_id % 3 when 0 then false when 1 then true end", stance=pick("n_chars", "buy", "trim", "avoid", "bearish", "mixed", None))
    return df.select("doc_id", X.title_only(F.col("excerpt"), F.col("chars")).alias("title_only"), X.checkable(F.struct("question", "stance")).alias("checkable"))


@query(f"""select doc_id, case when doc_id % 4 <> 3 then source || ' & <' || lang || '>' || chr(10) || chr(10) || 'é' || n_chars end as t {FROM}""")
def cleaned_texts(spark, sf):
    """Fetched texts with character references, carriage returns and runs of white space."""
    t = "case when doc_id % 4 <> 3 then concat('  ', source, chr(9), ' ', chr(38), 'amp; ', chr(38), 'lt;', lang, chr(38), 'gt;', repeat(chr(13), cast(3 + doc_id % 3 as int)), chr(38), '#233;', n_chars, chr(10)) end"
    return rows(spark, sf, t=t).select("doc_id", clean_text("t").alias("t"))


@query("""with c as (select user_id, min(event_id) as first from events where event_type = 'click' group by 1), o as (select user_id, min(event_id) as first from events where event_type in ('view', 'click') group by 1) select user_id, first from c union all select user_id, first from o where user_id not in (select user_id from c)""")
def seen_lists(spark, sf):
    """Two lists of what was seen, as one; the current list's data stay."""
    e = table(spark, sf, "events")
    first = lambda cond: e.filter(cond).groupBy("user_id").agg(F.min("event_id").alias("first"))
    return sets.seen_union(first("event_type = 'click'"), first("event_type in ('view', 'click')"), "user_id")
