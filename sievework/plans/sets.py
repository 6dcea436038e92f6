"""Queries that check sets of ids and link records to texts and configuration."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import labels as L
from sievework.operators import link, sets
from sievework.plans.registry import query, table
from sievework.sources import parse


@query("select doc_id from documents where doc_id % 2 <> 0 and doc_id % 3 <> 0 and doc_id % 5 <> 0")
def unresolved(spark, sf):
    """Seen ids in none of feed, history and queue."""
    d = table(spark, sf, "documents").select("doc_id")
    return sets.outside(d, "doc_id", d.filter("doc_id % 2 = 0"), d.filter("doc_id % 3 = 0"), d.filter("doc_id % 5 = 0"))


@query("""with g as (select doc_id, source, row_number() over (partition by source order by doc_id) as r, count(*) over (partition by source) as n from documents where doc_id % 4 <> 0)
select source, max(n) as missing, string_agg(doc_id, ',' order by doc_id) filter (r <= 5) as examples from g group by source""")
def author_gaps(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return sets.gaps(d, "doc_id", "source", d.filter("doc_id % 4 = 0"))


@query("""select count(*) filter (doc_id % 2 = 0) as left, count(*) filter (doc_id % 3 = 0) as right, count(*) filter (doc_id % 6 = 0) as both, count(*) filter (doc_id % 2 = 0 and doc_id % 3 <> 0) as left_only,
  count(*) filter (doc_id % 3 = 0 and doc_id % 2 <> 0) as right_only from (select distinct doc_id from documents)""")
def overlap_sizes(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return sets.overlap(d.filter("doc_id % 2 = 0"), d.filter("doc_id % 3 = 0"), "doc_id")


@query("select event_id, user_id from events where event_id % 2 = 0 and user_id not in (select user_id from events where event_id % 2 = 1 and event_id % 11 = 0)")
def disjoint_split(spark, sf):
    """Development rows whose thread isn't in the test set."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    return sets.disjoint(e.filter("event_id % 2 = 1 and event_id % 11 = 0"), e.filter("event_id % 2 = 0"), "user_id")


@query("""with n as (select count(*) as a from customer) select unnest(['missing_id', 'repeated_id', 'shrunk_by', 'lost', 'rewritten']) as check, unnest([0, (select count(*) from customer where c_custkey % 50 <> 0 and c_custkey % 40 = 0),
  greatest(0, a - (select count(*) filter (c_custkey % 50 <> 0) + count(*) filter (c_custkey % 50 <> 0 and c_custkey % 40 = 0) from customer)), (select count(*) from customer where c_custkey % 50 = 0),
  (select cast(coalesce(sum(1 + cast(c_custkey % 40 = 0 as int)), 0) as bigint) from customer where c_custkey % 50 <> 0 and c_custkey % 7 = 0)]) as n from n""")
def feed_verification(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    new = c.filter(k % 50 != 0).withColumn("c_name", F.when(k % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    return sets.verification(new.unionByName(new.filter(k % 40 == 0)), c, "c_custkey", ["c_name"])


@query("""select d.doc_id, case when d.doc_id % 3 <> 0 then length(d.text) end as chars from documents d""")
def hash_verified(spark, sf):
    """Frozen items with the text that has their hash; every third was frozen with another text."""
    d = table(spark, sf, "documents")
    items = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.sha2(F.concat("text", F.lit("x")), 256)).otherwise(F.sha2("text", 256)).alias("sha"))
    return link.verified_texts(items, d.select("doc_id", "text"), "doc_id", "text", "sha").select("doc_id", F.length("text").cast("long").alias("chars"))


@query(r"""with r as (select regexp_replace(trim(url), '[#?].*$', '') as u, page_id, length(html) > 3000 as big from pages), m as (select u, count(*) as n, min(page_id) as f, bool_or(big) as b from r where page_id % 3 <> 0 group by u)
select r.page_id, coalesce(n, 0) as matches, f as first_record, coalesce(b, false) as any_flag from r left join m on m.u = r.u""")
def url_matches(spark, sf):
    p = table(spark, sf, "pages")
    records = p.filter("page_id % 3 <> 0").select(F.col("page_id").alias("id"), "url", (F.length("html") > 3000).alias("big"))
    return link.with_url_matches(p.select("page_id", "url"), records, "url", "id", F.col("big")).select("page_id", "matches", "first_record", "any_flag")


@query("""select substr(sha256('b|' || doc_id), 1, 10) as blind_id, doc_id as item, source as record from documents where doc_id % 3 = 0 and doc_id % 4 <> 0""")
def key_map(spark, sf):
    """Answers under blind names, traced to items and records."""
    d = table(spark, sf, "documents")
    name = F.substring(F.sha2(F.concat(F.lit("b|"), "doc_id"), 256), 1, 10)
    names = d.filter("doc_id % 4 <> 0").select(name.alias("blind_id"), F.col("doc_id").alias("item"))
    return link.through(d.filter("doc_id % 3 = 0").select(name.alias("blind_id")), names, d.select(F.col("doc_id").alias("item"), F.col("source").alias("record")), "blind_id", "item", "record").select("blind_id", "item", "record")


_BLOG = r"//([a-z]+)\.example\.(?:com|org)/"


@query(rf"""with p as (select page_id, url, nullif(regexp_extract(url, '{_BLOG}', 1), '') as b from pages), h as (select b from p where b is not null group by b order by count(*) desc, b limit 3)
select page_id, case when b is not null then 'blog' when contains(url, 'example.net') then 'forum' else 'owner_forward' end as kind, case when b is null then 'unattributed' when b in (select b from h) then 'author ' || b else 'blog_' || b end as author from p""")
def link_attribution(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    b = F.regexp_extract("url", _BLOG, 1)
    config = p.filter(b != "").groupBy(b.alias("blog_id")).count().orderBy(F.desc("count"), "blog_id").limit(3).select("blog_id", F.concat(F.lit("author "), "blog_id").alias("blog_author"))
    return link.attributed(p, "url", config, _BLOG, "blog_", "example.net").select("page_id", "kind", "author")


_HREF = 'href="/([A-Za-z]+)[^"]*"'


@query(rf"""with l as (select distinct page_id, h from (select page_id, unnest(regexp_extract_all(html, '{_HREF}')) as h from pages)), b as (select page_id, regexp_extract(h, '{_HREF}', 1) as blog_id from l)
select page_id, case when blog_id in ('and', 'the', 'to') then blog_id else 'unattributed' end as blog, count(*) as links from b group by 1, 2""")
def category_links(spark, sf):
    config = spark.createDataFrame([("and",), ("the",), ("to",)], "blog_id string")
    return link.category(table(spark, sf, "pages"), "page_id", "html", _HREF, config)


@query("""select page_id, case when regexp_matches(html, '<a href="/(?:the|and)"') then 'links' when regexp_matches(html, '<a href="/[A-Z]') then 'empty' else 'unrecognised' end as state from pages""")
def page_structure(spark, sf):
    """Whether a page lists what it should, shows at least a trace of it, or can't be recognised."""
    return table(spark, sf, "pages").select("page_id", parse.page_state(F.col("html"), '<a href="/(?:the|and)"', '<a href="/[A-Z]').alias("state"))


@query("""select event_type as board, max(event_id) as newest from events group by event_type""")
def newest_ids(spark, sf):
    """The newest id of a board, by number and not by text."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("board"), F.col("event_id").cast("string").alias("id"))
    return e.groupBy("board").agg(F.max(F.col("id").cast("long")).alias("newest"))


@query("""select conv_id, coalesce(nullif(role, ''), '?') || ':' || case when turn % 3 = 0 then 'p' || conv_id when turn % 3 = 1 then cast(conv_id * 10 as varchar) else cast(turn as varchar) end as thread, turn from conversations""")
def thread_keys(spark, sf):
    c = table(spark, sf, "conversations")
    parent = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("p"), "conv_id"))
    url = F.when(F.col("turn") % 3 == 1, F.concat(F.lit("http://x/"), F.col("conv_id") * 10, F.lit(".html")))
    return c.select("conv_id", "turn", L.thread_key(F.col("role"), parent, url, F.col("turn")).alias("thread"))
