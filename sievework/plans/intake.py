"""Queries of whole records, mixed file drops and what is read out of odd forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import rules as R
from sievework.operators import feed, records, report
from sievework.plans.registry import pick, query, table
from sievework.sources import drop, tables


def themes_sql(text: str) -> str:
    held = lambda words: " or ".join(f"contains(lower({text}), {w!r})" for w in words)
    found = ", ".join(f"case when {held(words)} then {name!r} end" for name, words in R.THEMES.items())
    return f"list_filter([{found}], lambda x: x is not null)[1:8]"


SAID = pick("doc_id", "今天我买入NVDA，长期看好。", "Taking some profit on AMAT", "这次认错，不追高", None, "TSLA 第一档 300")
_SAID_SYMBOL = "case doc_id % 5 when 0 then ['NVDA'] when 1 then ['AMAT'] when 4 then ['TSLA'] else []::varchar[] end"
_BODY = "concat_ws(chr(10), " + SAID + ", repeat('=', cast(1 + n_chars % 700 as int)))"
_POST = f"""with d as (select doc_id, source, n_chars, cast(date '2024-01-01' + cast(doc_id % 300 as int) as varchar) as day, 'http://h/' || doc_id || '#x' as url, case when doc_id % 7 = 0 then '麻你' else source end as author,
  'Item ' || doc_id as title, {_BODY} as body from documents where n_chars is not null)"""


def _posts(spark, sf):
    d = table(spark, sf, "documents").filter("n_chars is not null")
    reply = F.transform(F.sequence(F.lit(1), (F.col("n_chars") % 90 + 1).cast("int")), lambda i: F.struct(i.cast("string").alias("post_id"), F.lit("al").alias("author"), F.lit("t").alias("title"), (i % 4).alias("body_bytes")))
    parent = F.when(F.col("doc_id") % 3 == 0, F.struct(F.lit("p").alias("post_id"), F.col("source").alias("author"), F.repeat(F.lit("long "), 40).alias("title"), F.lit("2024").alias("published_at")))
    return d.select(
        "doc_id", F.expr("concat('Item ', doc_id)").alias("title"), F.expr(_BODY).alias("text"), F.expr("concat('http://h/', doc_id, '#x')").alias("url"), F.expr("cast(date_add(date '2024-01-01', cast(doc_id % 300 as int)) as string)").alias("date"),
        F.when(F.col("doc_id") % 7 == 0, "麻你").otherwise(F.col("source")).alias("author"), F.array_repeat(F.lit("i.png"), (F.col("doc_id") % 4).cast("int")).alias("images"), F.col("source").alias("parent_post_id"),
        F.when(F.col("doc_id") % 2 == 0, F.struct(F.lit("r").alias("root_post_id"), F.lit(None).cast("boolean").alias("is_reply"), parent.alias("parent"), reply.alias("replies"))).alias("thread"))


@query(_POST + f""" select left(sha1(author || '|http://h/' || doc_id || '|' || day || '|' || title), 20) as id, author, day as published_at, title, 'http://h/' || doc_id as url, left(body, 360) as excerpt, length(body) as content_chars, doc_id % 4 as images_count,
 array_to_string(case when len({themes_sql("title || chr(10) || body")}) > 0 then {themes_sql("title || chr(10) || body")} else ['{R.OTHER_THEME}'] end, ',') as themes, array_to_string({_SAID_SYMBOL}, ',') as symbols,
 case doc_id % 5 when 4 then 1 when 0 then 1 else 0 end as n_operations, case when doc_id % 5 = 2 then 'do_not_chase' else '' end as rules, case when doc_id % 5 = 2 then 'admit_wrong' else '' end as lessons,
 case doc_id % 5 when 0 then 'NVDA:buy' when 1 then 'AMAT:trim' else '' end as claims, case when doc_id % 2 = 0 then n_chars % 90 + 1 end as reply_count, case when doc_id % 2 = 0 then least(n_chars % 90 + 1, 80) end as replies_kept,
 case when doc_id % 2 = 0 then n_chars % 90 + 1 - (n_chars % 90 + 1) // 4 end as replies_with_body, case when doc_id % 6 = 0 then source || ':' || left(repeat('long ', 40), 120) end as answered, 0 as n_actions from d""")
def feed_record(spark, sf):
    """Whole feed records of posts with conversations."""
    r = records.posts(_posts(spark, sf), "board", "post", "2024-11-01T00:00:00Z", "notice")
    joined = lambda c: F.array_join(c, ",")
    t = F.col("thread_context")
    return r.select(
        "id", "author", "published_at", "title", "url", "excerpt", "content_chars", "images_count", joined("themes_hint").alias("themes"), joined("symbols").alias("symbols"), F.size("operations").alias("n_operations"), joined("portfolio_rules").alias("rules"), joined("lessons").alias("lessons"),
        joined(F.transform("claims", lambda c: F.concat_ws(":", c["symbol"], c["stance"]))).alias("claims"), t["reply_count"].cast("long").alias("reply_count"), F.when(t.isNotNull(), F.size(t["replies"])).cast("long").alias("replies_kept"), t["replies_with_body"].cast("long").alias("replies_with_body"),
        F.when(t["in_reply_to"].isNotNull(), F.concat_ws(":", t["in_reply_to"]["author"], t["in_reply_to"]["title"])).alias("answered"), F.size("author_actions").alias("n_actions"))


_ORIGIN = pick("n_chars", "captions", records.OWNER, records.MODEL)


@query(f"""with d as (select doc_id, source, n_chars, {SAID} as said, {_ORIGIN} as origin, doc_id % 2 = 0 as allowed, doc_id % 11 <> 0 as st from documents where n_chars is not null),
 v as (select *, st and n_chars % 3 = 1 as owner, st and n_chars % 3 = 2 as model, {_SAID_SYMBOL} as own from d)
select left(sha1('youtube|' || source || '|v' || doc_id), 20) as id, 'https://www.youtube.com/watch?v=v' || doc_id as url, length(coalesce(said || chr(10), '') || 'moomoo 开户链接') as content_chars, coalesce(length(said), 0) as semantic_chars, 1 as removed,
 array_to_string(case when owner then list_sort(list_distinct(list_append(own, 'ZZ'))) when model then list_sort(list_distinct(list_concat(own, ['AB', 'C.D']))) else own end, ',') as symbols, case when said is not null and allowed and doc_id % 5 in (0, 4) then 1 else 0 end as n_operations,
 case when allowed and doc_id % 5 = 2 then 'do_not_chase' else '' end as rules, coalesce(origin, 'metadata_only') as content_origin, allowed and not owner as rule_candidate_allowed, case when owner then '{records.UNVERIFIED}' when model then '{records.UNVALIDATED}' end as claims_status,
 case when owner or model then case doc_id % 5 when 0 then 'NVDA:buy' when 1 then 'AMAT:trim' else '' end end as claims, case when model then left(repeat('seen ', 50), 200) end as video_observed_title, case when owner then 'o' when model then 'm' else 'n' end as source_notice from v""")
def video_record(spark, sf):
    """Whole feed records of videos: transcripts, summaries by a person, and a model's reading."""
    d = table(spark, sf, "documents").filter("n_chars is not null")
    st = "if(doc_id % 11 <> 0, named_struct('symbols', array('AB', 'bad one', 'C.D'), 'claims', array(named_struct('symbol', 'ZZ'), named_struct('symbol', cast(null as string))), 'macro', array('CPI'), 'model', 'x1', 'observed_title', repeat('seen ', 50), 'submission_ids', array('s'), 'summary_sha256', array('h')), null)"
    a = f"named_struct('text', concat_ws(chr(10), {SAID}, 'moomoo 开户链接'), 'status', 'available', 'quality', cast(null as string), 'provider', 'p', 'provider_url', '', 'content_origin', {_ORIGIN}, 'timestamp_evidence', true, 'rule_candidate_allowed', doc_id % 2 = 0, 'structured', {st})"
    r = records.videos(d.select(F.col("source").alias("author"), F.lit("r").alias("role"), F.expr("concat('v', doc_id)").alias("video_id"), F.lit("").alias("title"), F.lit(None).cast("string").alias("url"), F.lit("2024-01-01").alias("published_at"), F.expr(a).alias("acquisition")), "now", "n", "o", "m")
    return r.select("id", "url", "content_chars", F.col("semantic_content_chars").alias("semantic_chars"), F.col("content_filtering.removed").cast("long").alias("removed"), F.array_join("symbols", ",").alias("symbols"), F.size("operations").alias("n_operations"), F.array_join("portfolio_rules", ",").alias("rules"), "content_origin",
                    "rule_candidate_allowed", "claims_status", F.when(F.col("claims").isNotNull(), F.array_join(F.transform("claims", lambda c: F.concat_ws(":", c["symbol"], c["stance"])), ",")).alias("claims"), "video_observed_title", "source_notice")


_NAMES = pick("doc_id", "d{doc_id}.md", "d{doc_id}.HTML", "d{doc_id}.json", "d{doc_id}.jsonl", "d{doc_id}.zip", "d{doc_id}.bin", "d{doc_id}")
_CONTENT = pick("doc_id", "Title: T{doc_id}{chr(10)}url: http://u/{n_chars}{chr(10)}---{chr(10)}body {source}", "<title>H{doc_id} - site</title><p>body {source}</p><script>x</script>", "{case when n_chars % 2 = 0 then concat(chr(123), chr(34), 'a', chr(34), ': ', n_chars, chr(125)) else concat(chr(123), 'broken') end}",
                "[{n_chars}]{chr(10)}{chr(10)}not json{chr(10)}[{doc_id}]", "no archive", "x", "x")


@query(f"""with d as (select doc_id, n_chars, source, {_NAMES} as path, {_CONTENT} as c from documents where n_chars is not null), l as (select path, unnest(['[' || n_chars || ']', 'not json', '[' || doc_id || ']']) as text from d where doc_id % 7 = 3)
select path, 'markdown' as kind, 'T' || doc_id as title, 'http://u/' || n_chars as url, 'body ' || source as text, null as reason from d where doc_id % 7 = 0 union all select path, 'html', 'H' || doc_id, null, 'body ' || source, null from d where doc_id % 7 = 1
union all select path, 'json', null, null, case when n_chars % 2 = 0 then c else '[]' end, case when n_chars % 2 <> 0 then 'malformed JSON' end from d where doc_id % 7 = 2 union all select path, 'lines', null, null, text, case when text = 'not json' then 'malformed line' end from l
union all select path, 'archive', null, null, null, 'bad archive: BadZipFile' from d where doc_id % 7 = 4 union all select path, 'unknown', null, null, null, 'unknown kind' from d where doc_id % 7 > 4""")
def file_drop(spark, sf):
    """Files of all kinds, read or set aside; broken JSON documents turn into the default."""
    d = table(spark, sf, "documents").filter("n_chars is not null").select(F.expr(_NAMES).alias("path"), F.encode(F.expr(_CONTENT), "UTF-8").alias("content"))
    return drop.routed(d, "[]").select("path", "kind", "title", "url", "text", "reason")


@query("""select doc_id, case when doc_id % 4 = 3 then null else array_to_string([source, 'it''s ' || lang, 'a, b'], '|') end as items from documents""")
def printed_lists(spark, sf):
    """Lists as text, with apostrophes and commas inside their items, read back."""
    q, s = "chr(34)", "chr(39)"
    form = f"case doc_id % 4 when 0 then concat('[', {q}, source, {q}, ', ', {q}, 'it', {s}, 's ', lang, {q}, ', ', {q}, 'a, b', {q}, ']') when 1 then concat('[', {s}, source, {s}, ', ', {q}, 'it', {s}, 's ', lang, {q}, ',', {s}, 'a, b', {s}, ']') when 2 then concat(' [ ', source, ', ', {s}, 'it', chr(92), {s}, 's ', lang, {s}, ', ', {s}, 'a, b', {s}, ' ] ') else concat('[', {s}, source) end"
    return table(spark, sf, "documents").select("doc_id", F.array_join(tables.coerced_list(F.expr(form)), "|").alias("items"))


@query("""with a as (select doc_id, source, lang from documents), b as (select doc_id, case when doc_id % 3 = 0 then 'x' || source else source end as source, case when doc_id % 4 = 0 then 'x' || lang else lang end as lang, case doc_id % 5 when 0 then ['source', 'lang'] when 1 then ['source'] when 2 then [] end as revised from documents where doc_id % 9 <> 0)
select cast(a.doc_id as varchar) as key, 'lost' as kind, '' as field from a where doc_id % 9 = 0 union all select cast(doc_id as varchar), 'changed', 'source' from a join b using (doc_id) where a.source <> b.source and not coalesce(list_contains(revised, 'source'), false)
union all select cast(doc_id as varchar), 'changed', 'lang' from a join b using (doc_id) where a.lang <> b.lang and not coalesce(list_contains(revised, 'lang'), false)""")
def undeclared_changes(spark, sf):
    """Changed fields of the next feed that no revision declares."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang")
    x = lambda n, c: F.when(F.col("doc_id") % n == 0, F.concat(F.lit("x"), c)).otherwise(F.col(c)).alias(c)
    said = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("source"), F.lit("lang"))).when(F.col("doc_id") % 5 == 1, F.array(F.lit("source"))).when(F.col("doc_id") % 5 == 2, F.array().cast("array<string>"))
    new = d.filter("doc_id % 9 <> 0").select("doc_id", x(3, "source"), x(4, "lang"), said.alias("revised"))
    return feed.undeclared(d, new, "doc_id", ["source", "lang"], "revised")


@query("""with recursive l as (select conv_id, row_number() over (partition by conv_id order by turn, i, j) as n, substr(line, j * 3800 + 1, 3800) as line from (select conv_id, turn, i, line, unnest(range(greatest(1, (length(line) + 3799) // 3800))) as j
   from (select conv_id, turn, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from (select conv_id, turn, string_split(repeat(text || chr(10), 3) || 'turn ' || turn, chr(10)) as ls from conversations where text is not null)))),
 m as (select conv_id, n, 1 as part, line as now from l where n = 1 union all select l.conv_id, l.n, case when now <> '' and length(now) + 1 + length(line) <= 3800 or now = '' then part else part + 1 end, case when now <> '' and length(now) + 1 + length(line) <= 3800 then now || chr(10) || line else line end from m join l on l.conv_id = m.conv_id and l.n = m.n + 1)
select conv_id, part, max(length(now)) as chars, sha256(arg_max(now, n)) as digest from m group by conv_id, part having arg_max(now, n) <> ''""")
def thread_messages(spark, sf):
    """Whole conversations cut into messages of 3,800 characters at line ends; long lines are cut where they must be."""
    c = table(spark, sf, "conversations").filter("text is not null").select("conv_id", "turn", F.concat(F.repeat(F.concat("text", F.lit("\n")), F.lit(3)), F.lit("turn "), "turn").alias("text"))
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("t"))
    m = whole.select("conv_id", F.posexplode(report.messages(F.col("t"), 3800)).alias("i", "m"))
    return m.select("conv_id", (F.col("i") + 1).alias("part"), F.length("m").alias("chars"), F.sha2("m", 256).alias("digest"))
