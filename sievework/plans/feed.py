"""Queries of the feed: projection, text functions, flags, merges, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.functions import text as T
from sievework.operators import feed, health, recon
from sievework.plans.registry import query, table

TERMS = ["the", "und", "que", "los"]
TOPICS = {"english": ["the ", " and "], "german": [" und ", " der "], "french": [" et ", " les "], "spanish": [" los ", " del "]}
PROMO = ["example.com", "password", "!!"]
MARKERS = ["<nav", "<script", "<style", 'class="ad"', "<footer", "<!-- ad"]


def _posts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.col("source").alias("author"), F.get(F.split("text", "\n"), F.lit(0)).alias("title"), "text", F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id", F.lit("#x")).alias("url"), F.lit("2026-01-02").alias("date"))


@query("""select substr(sha1(source || '|doc://' || source || '/' || doc_id || '|2026-01-02|' || split_part(text, chr(10), 1)), 1, 20) as id, 'feed' as source,
  'forum' as source_kind, source as author, '2026-01-02' as published_at, split_part(text, chr(10), 1) as title, 'doc://' || source || '/' || doc_id as url,
  substr(text, 1, 360) as excerpt, length(text) as content_chars, '2026-01-03T00:00:00' as captured_at from documents""")
def feed_normalize(spark, sf):
    return feed.normalize(_posts(spark, sf), "feed", "forum", "2026-01-03T00:00:00")


@query("""with d as (select *, count(*) over (partition by text) > 1 as dup from documents)
select source, lang, count(*) as records, count(*) filter (dup) as duplicates, count(*) filter (regexp_matches(text, '(?i)(^|[^A-Za-z0-9])the([^A-Za-z0-9]|$)')) as with_term,
  list_sort(list(length(text)))[count(*) // 2 + 1] as median_chars from d group by source, lang""")
def feed_matrix(spark, sf):
    """Source by language: records, duplicates, records with a term, upper median of characters."""
    d = feed.duplicate_flags(table(spark, sf, "documents").withColumn("h", F.sha1("text")), dup=F.col("h"))
    chars = F.length("text").cast("long")
    d = d.select("source", "lang", "dup", T.has_token(F.col("text"), "the").alias("term"), chars.alias("chars"))
    g = d.groupBy("source", "lang").agg(F.count("*").alias("records"), F.count_if("dup").alias("duplicates"), F.count_if("term").alias("with_term"))
    return g.join(health.upper_median(d, ["source", "lang"], "chars").withColumnRenamed("median", "median_chars"), ["source", "lang"])


@query("""with i as (select 'x' || doc_id as id, lang, source from documents)
select count(*) as records, count(distinct id) as distinct_ids, cast(sum(strlen(id) + strlen(lang) + strlen(source)) as bigint) as bytes,
  sha256(cast(sum(cast(('0x' || substr(sha256(id), 1, 15)) as bigint)) as varchar)) as ids_digest,
  sha256(cast(sum(cast(('0x' || substr(sha256(id || chr(31) || lang || chr(31) || source), 1, 15)) as bigint)) as varchar)) as content_digest from i""")
def feed_manifest(spark, sf):
    return feed.manifest(table(spark, sf, "documents").select(F.concat(F.lit("x"), "doc_id").alias("id"), "lang", "source"))


@query("""select doc_id, count(*) over (partition by text) > 1 as duplicate_text, count(*) over (partition by split_part(text, chr(10), 1)) > 1 as duplicate_title from documents""")
def duplicate_flags(spark, sf):
    d = table(spark, sf, "documents")
    return feed.duplicate_flags(d, duplicate_text=F.sha1("text"), duplicate_title=F.get(F.split("text", "\n"), F.lit(0))).select("doc_id", "duplicate_text", "duplicate_title")


_TERM_SQL = ", ".join(f"case when regexp_matches(text, '(?i)(^|[^A-Za-z0-9]){t}([^A-Za-z0-9]|$)') then '{t}' end" for t in sorted(TERMS, key=lambda t: (-len(t), t)))


@query(f"select doc_id, concat_ws(',', {_TERM_SQL}) as terms from documents")
def lexicon_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(X.detect(F.col("text"), {}, TERMS), ",").alias("terms"))


_TOPIC_SQL = ", ".join("case when " + " or ".join(f"contains(lower(text), '{w}')" for w in ws) + f" then '{k}' end" for k, ws in TOPICS.items())


@query(f"select doc_id, coalesce(nullif(concat_ws(',', {_TOPIC_SQL}), ''), 'other') as topics from documents")
def themes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(X.themes(F.col("text"), TOPICS, "other"), ",").alias("topics"))


@query(r"""with s as (select doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '([。！？；!?;])', '\1' || chr(10), 'g'), '\. ', '.' || chr(10), 'g'), chr(10))) as s from documents),
 q as (select doc_id, trim(regexp_replace(s, '\s+', ' ', 'g')) as s from s)
select doc_id, count(*) filter (length(s) >= 6) as sentences, coalesce(cast(sum(length(s)) filter (length(s) >= 6) as bigint), 0) as chars from q group by doc_id""")
def sentence_stats(spark, sf):
    s = F.col("s")
    cut = table(spark, sf, "documents").select("doc_id", F.when(F.monotonically_increasing_id() >= 0, T.sentences(F.col("text"))).alias("s"))  # worked out once
    return cut.select("doc_id", F.size(s).cast("long").alias("sentences"), F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


_PROMO_SQL = " or ".join(f"contains(lower(x), '{w}')" for w in PROMO)


@query(f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as x from documents)
select doc_id, count(*) as units, count(*) filter ({_PROMO_SQL}) as removed, round(count(*) filter ({_PROMO_SQL}) / count(*), 3) as removed_ratio from l group by doc_id""")
def promo_filter(spark, sf):
    d = table(spark, sf, "documents").withColumn("f", X.without_noise(F.split("text", "\n"), PROMO))
    return d.select("doc_id", F.col("f.units").cast("long").alias("units"), F.col("f.removed").cast("long").alias("removed"), F.col("f.ratio").alias("removed_ratio"))


_MARK_SQL = " + ".join(f"cast(contains(lower(html), '{m}') as int)" for m in MARKERS)


@query(f"select page_id, ({_MARK_SQL}) >= 3 and length(html) < 4000 as boilerplate from pages")
def boilerplate(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.boilerplate(F.col("html"), MARKERS, 3, 4000).alias("boilerplate"))


@query(r"""select page_id, regexp_replace(url, '#.*$', '') as no_fragment, regexp_replace(trim(url), '[#?].*$', '') as no_query, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || substr(regexp_replace(url, '#.*$', ''), length(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) + 1) as folded from pages""")
def url_canonical(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", T.without_fragment(u).alias("no_fragment"), T.without_query(u).alias("no_query"), T.host(u).alias("host"), T.folded_url(u).alias("folded"))


@query("""with b as (select doc_id, lang as a, source as b from documents where doc_id % 3 <> 0),
 i as (select doc_id, 'L' || lang as a, case when doc_id % 2 = 0 then 'new' end as b from documents where doc_id % 2 = 0 or doc_id % 3 = 0)
select coalesce(b.doc_id, i.doc_id) as doc_id, case when b.doc_id is null then i.a else b.a end as a, case when b.doc_id is null then i.b else coalesce(i.b, b.b) end as b,
  case when b.doc_id is null then 'added' when i.b is not null and i.b is distinct from b.b then 'enriched' else 'kept' end as outcome from b full join i on b.doc_id = i.doc_id""")
def upsert_append_only(spark, sf):
    d = table(spark, sf, "documents")
    base = d.filter("doc_id % 3 <> 0").select("doc_id", F.col("lang").alias("a"), F.col("source").alias("b"))
    new = d.filter("doc_id % 2 = 0 or doc_id % 3 = 0").select("doc_id", F.concat(F.lit("L"), "lang").alias("a"), F.when(F.col("doc_id") % 2 == 0, "new").alias("b"), F.lit(1).alias("seq"))
    later = new.withColumns({"a": F.lit("late"), "seq": F.lit(2)})  # the first row of a batch wins
    return feed.upsert(base, new.unionByName(later), "doc_id", ["b"])


@query("""select user_id, arg_max(event_type, event_id) filter (event_id % 3 <> 0) as event_type, arg_max(cast(value as varchar), event_id) filter (event_id % 2 = 0 and value is not null) as value
from (select user_id, event_id, event_type, cast(value * 100 as bigint) as value from events) group by user_id""")
def null_fill_merge(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).otherwise("").alias("event_type"), F.when(F.col("event_id") % 2 == 0, F.round(F.col("value") * 100, 0).cast("long")).alias("value"))
    return feed.fill_missing(e, "user_id", "event_id", ["event_type", "value"])


@query("""with c as (select doc_id, doc_id % 5 as grade, lang as v from documents where doc_id % 4 <> 0), p as (select doc_id, doc_id % 7 as grade, source as v from documents where doc_id % 3 <> 0)
select coalesce(c.doc_id, p.doc_id) as doc_id, greatest(c.grade, p.grade) as grade, case when coalesce(p.grade > c.grade, c.grade is null) then p.v else c.v end as v from c full join p on c.doc_id = p.doc_id""")
def best_quality_merge(spark, sf):
    d = table(spark, sf, "documents")
    c = d.filter("doc_id % 4 <> 0").select("doc_id", (F.col("doc_id") % 5).alias("grade"), F.col("lang").alias("v"))
    p = d.filter("doc_id % 3 <> 0").select("doc_id", (F.col("doc_id") % 7).alias("grade"), F.col("source").alias("v"))
    return feed.best_of(c, p, "doc_id", "grade", ["v"])


@query("""with e as (select cast(ts as date) as day, event_type as key, event_id % 3 as s, event_id from events),
 g as (select day, key, count(*) filter (s = 0) as b, count(*) filter (s <= 1) as o, count(*) filter (s <> 1) as t, bool_or(event_id % 50 = 0) as paid from e group by 1, 2)
select day, key, greatest(o + t - b, o, t) as count, paid from g where day in (select distinct day from e order by day desc limit 20)""")
def counter_merge(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("key"), (F.col("event_id") % 3).alias("s"), (F.col("event_id") % 50 == 0).alias("p"))
    side = lambda c: e.filter(c).groupBy("day", "key").agg(F.count("*").alias("count"), F.bool_or("p").alias("paid"))
    return feed.merge_counters(side("s = 0"), side("s <= 1"), side("s <> 1"), ["day", "key"], "day", 20)


@query("""select cast(c_custkey as varchar) as key, 'lost' as kind, '' as field from customer where c_custkey % 50 = 0
union all select cast(c_custkey as varchar), 'changed', 'c_name' from customer where c_custkey % 50 <> 0 and c_custkey % 7 = 0
union all select cast(c_custkey as varchar), 'changed', 'c_mktsegment' from customer where c_custkey % 50 <> 0 and c_custkey % 11 = 0 and c_mktsegment <> 'BUILDING'""")
def immutable_violations(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    new = c.filter(k % 50 != 0).withColumns({"c_name": F.when(k % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")), "c_mktsegment": F.when(k % 11 == 0, "BUILDING").otherwise(F.col("c_mktsegment"))})
    return feed.violations(c, new, "c_custkey", ["c_name", "c_mktsegment"])


@query("""select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, len(regexp_extract_all(html, '<a href="')) as links from pages""")
def page_title_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit('<a href="')).cast("long").alias("links"))


@query()
def html_extract(spark, sf):
    """Title and visible text of pages."""
    from sievework.sources.parse import page_text

    return table(spark, sf, "pages").select("page_id", page_text("html").alias("p")).select("page_id", "p.title", F.length("p.text").cast("long").alias("chars"), F.sha1("p.text").alias("text_sha1"))


@query("""select d.doc_id from documents d where not exists (from benchmark b where contains(d.text, b.text))""")
def prior_use_exclusion(spark, sf):
    """Documents that hold no benchmark passage word for word."""
    return X.without_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "text").select("doc_id")


@query("""with n as (select unnest(['lang', 'source', 'band']) as dimension, doc_id, lang, source, case when length(text) >= 1000 then 'full_text' when length(text) > 0 then 'excerpt' else 'title_only' end as band from documents)
select dimension, case dimension when 'lang' then lang when 'source' then source else band end as value, count(*) as records from n group by 1, 2""")
def inventory_grouping_sets(spark, sf):
    return recon.inventory(table(spark, sf, "documents").withColumn("band", X.depth(F.length("text"))), ["lang", "source", "band"])
