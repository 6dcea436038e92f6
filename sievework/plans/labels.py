"""Queries of dates, strings, filters, gates and labels over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import dates as D
from sievework.functions import extract as X
from sievework.functions import labels as L
from sievework.functions import text as T
from sievework.plans.registry import query, table


@query("""select o_orderkey, l_linenumber, epoch(l_shipdate) - epoch(o_orderdate) between -86400 and 168 * 3600 as timely from lineitem join orders on l_orderkey = o_orderkey""")
def timeliness(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("o_orderkey", "l_linenumber", D.timely(F.col("o_orderdate"), F.col("l_shipdate")).alias("timely"))


@query("""select event_id, cast(ts - interval 8 hour as date) as quota_day from events""")
def quota_days(spark, sf):
    """Calendar days of a zone that is eight hours behind in all the events' season."""
    return table(spark, sf, "events").select("event_id", D.quota_day(F.col("ts").cast("timestamp")).alias("quota_day"))


@query("""select user_id, array_to_string(list_transform(generate_series(date_trunc('month', min(ts)), date_trunc('month', max(ts)), interval 1 month), lambda x: strftime(x, '%Y-%m')), ',') as months from events group by user_id""")
def month_range(spark, sf):
    g = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    return g.select("user_id", F.array_join(D.months(F.col("a"), F.col("b")), ",").alias("months"))


@query("""select event_id, case when month(ts) % 12 + 1 < 6 then 2025 else 2024 end || '-' || lpad(cast(month(ts) % 12 + 1 as varchar), 2, '0') || '-05' as day from events""")
def year_roll_over(spark, sf):
    md = F.concat(F.lpad((F.month("ts") % 12 + 1).cast("string"), 2, "0"), F.lit("-05"))
    return table(spark, sf, "events").select("event_id", D.rolled_over(md, F.lit(2024), F.lit(6)).alias("day"))


@query("""select event_id from events where starts_with(strftime(ts, '%Y-%m-%d'), '2024-01-05') or event_id % 100 = 7""")
def day_filter(spark, sf):
    """Records published or captured on a day."""
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("published"), F.when(F.col("event_id") % 100 == 7, "2024-01-05T01:02:03").otherwise("").alias("captured"))
    return e.filter(F.col("published").startswith("2024-01-05") | F.col("captured").startswith("2024-01-05")).select("event_id")


@query(r"""with l as (select page_id, unnest(string_split(html, chr(10))) as x, unnest(range(len(string_split(html, chr(10))))) as i from pages), c as (select page_id, i, trim(regexp_replace(x, '\s+', ' ', 'g')) as x from l)
select page_id, sha256(coalesce(string_agg(x, chr(10) order by i) filter (x <> '' and lower(x) not in ('</body></html>', '<hr>')), '')) as cleaned_sha256 from c group by page_id""")
def cleaned_lines(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2(L.cleaned(F.col("html"), ["</body></html>", "<hr>"]), 256).alias("cleaned_sha256"))


@query(r"""with u as (select doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '([。！？.!?])\s+', '\1' || chr(10), 'g'), '\n+', chr(10), 'g'), chr(10))) as s from documents), q as (select doc_id, trim(regexp_replace(s, '\s+', ' ', 'g')) as s from u)
select doc_id, count(*) filter (length(s) >= 25) as units, coalesce(cast(sum(length(s)) filter (length(s) >= 25) as bigint), 0) as chars from q group by doc_id""")
def long_units(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.monotonically_increasing_id() >= 0, L.units(F.col("text"))).alias("u"))
    return d.select("doc_id", F.size("u").cast("long").alias("units"), F.aggregate("u", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


@query(r"""with u as (select doc_id, list_transform(string_split(regexp_replace(regexp_replace(text, '([。！？.!?])\s+', '\1' || chr(10), 'g'), '\n+', chr(10), 'g'), chr(10)), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))) as u from documents),
 h as (select doc_id, list_transform(list_filter(u, lambda s: length(s) >= 25 and (contains(lower(s), 'tion') or contains(lower(s), 'heit'))), lambda s: substr(s, 1, 120)) as h from u),
 d as (select doc_id, list_filter(h, lambda s, i: list_position(h, s) = i) as h from h)
select doc_id, sha256(array_to_string(h[1:3], '|')) as points_sha256, least(len(h), 3) as points from d""")
def representative_points(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.monotonically_increasing_id() >= 0, L.points(F.col("text"), ["tion", "heit"])).alias("p"))
    return d.select("doc_id", F.sha2(F.array_join("p", "|"), 256).alias("points_sha256"), F.size("p").cast("long").alias("points"))


@query(r"""select doc_id, array_to_string(list_sort(list_filter(list_distinct(list_transform(regexp_extract_all(' ' || regexp_replace(text, '([^A-Za-z])', '\1\1', 'g') || ' ', '[^A-Za-z][A-Z]{2,5}[^A-Za-z]'), lambda x: substr(x, 2, length(x) - 2))), lambda x: x <> 'MIT')), ',') as symbols from documents""")
def capital_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(L.capitals(F.col("text"), ["MIT"]), ",").alias("symbols"))


@query("""with r as (select doc_id, n_chars, text, lang, length(trim(text)) = 0 as blank, lang = 'en' and n_chars < 200 as short_english from documents)
select doc_id, concat_ws(',', case when blank then 'no_text' end, case when short_english then 'short_english' end) as flags, blank or short_english as exclude from r""")
def quality_flags(spark, sf):
    f = L.flags(no_text=F.length(F.trim("text")) == 0, short_english=(F.col("lang") == "en") & (F.col("n_chars") < 200))
    return table(spark, sf, "documents").select("doc_id", F.array_join(f, ",").alias("flags"), (F.size(f) > 0).alias("exclude"))


@query("""select e.event_id from events e left join (select user_id from events where event_type = 'error' and value > 150 group by user_id) f on f.user_id = e.user_id where e.ts >= timestamp '2024-01-20' and e.event_id >= 100 and f.user_id is null""")
def recent_unflagged(spark, sf):
    """Records seen and published since a day whose author isn't flagged."""
    e = table(spark, sf, "events")
    flags = e.filter("event_type = 'error' and value > 150").select("user_id").distinct().withColumn("exclude", F.lit(True))
    return e.filter((F.col("ts") >= F.lit("2024-01-20").cast("timestamp")) & (F.col("event_id") >= 100)).join(flags, "user_id", "left").filter(~F.coalesce("exclude", F.lit(False))).select("event_id")


@query("""select event_id from events where event_type in ('click', 'view') and event_id % 3 <> 0 and cast(ts as date) between date '2024-01-03' and date '2024-01-12'""")
def shadow_eligible(spark, sf):
    e = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    some = e.filter(F.col("event_type").isin("click", "view") & day.between(F.lit("2024-01-03").cast("date"), F.lit("2024-01-12").cast("date")))
    return some.join(e.filter("event_id % 3 = 0").select("event_id"), "event_id", "left_anti").select("event_id")


@query(r"""with r as (select doc_id, regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g') as t, regexp_replace(substr(text, 1, 360), '^\s+|\s+$', '', 'g') as e from documents)
select doc_id, unnest(list_filter([case when t <> '' then 'title' end, case when e <> '' and e <> t then 'excerpt' end], lambda x: x is not null)) as kind,
  unnest(list_filter([case when t <> '' then substr(sha256('title|' || doc_id), 1, 16) end, case when e <> '' and e <> t then substr(sha256('excerpt|' || doc_id), 1, 16) end], lambda x: x is not null)) as item_id from r""")
def record_items(spark, sf):
    d = table(spark, sf, "documents")
    title = F.get(F.split("text", "\n"), F.lit(0))
    return d.select("doc_id", F.explode(L.items(title, F.substring("text", 1, 360), F.col("doc_id"))).alias("i")).select("doc_id", "i.kind", "i.item_id")


@query("""select doc_id, case when doc_id % 9 = 0 then 'video' when n_chars > 400 then 'title_plus_excerpt' else 'title_only' end as text_form, case when doc_id % 4 > 1 then 'claim' when doc_id % 5 = 0 then 'needs_article_check' else 'none' end as status from documents""")
def text_forms(spark, sf):
    k = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", L.text_form(F.when(k % 9 == 0, "video"), F.when(F.col("n_chars") > 400, F.col("text"))).alias("text_form"), L.answer_status(F.greatest(F.lit(0), k % 4 - 1), F.when(k % 5 == 0, "needs_article_check")).alias("status"))


@query(r"""with d as (select doc_id, unnest(regexp_extract_all(text, '[^\n]+')) as s from documents) select doc_id, count(*) as lines, count(*) filter (regexp_matches(s, '(?i)(^|[^A-Za-z0-9])the([^A-Za-z0-9]|$)')) as with_term from d group by doc_id""")
def line_locators(spark, sf):
    """Lines that could be cited, and those with a listed term."""
    d = table(spark, sf, "documents").select("doc_id", F.explode(F.filter(F.split("text", "\n"), lambda x: x != "")).alias("s"))
    return d.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(T.has_token(F.col("s"), "the")).alias("with_term"))


@query("""select doc_id, concat_ws(',', case when regexp_matches(text, '(?i)(^|[^A-Za-z0-9])que([^A-Za-z0-9]|$)') then 'que' end, case when regexp_matches(text, '(?i)(^|[^A-Za-z0-9])the([^A-Za-z0-9]|$)') then 'the' end) as merged from documents""")
def merged_symbols(spark, sf):
    """Symbols of two finders, merged and sorted."""
    a, b = X.detect(F.col("text"), {}, ["the"]), X.detect(F.col("text"), {}, ["que", "the"])
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(F.array_union(a, b)), ",").alias("merged"))
