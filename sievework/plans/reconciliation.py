"""Queries that reconcile sources, snapshots and states."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import stats as S
from sievework.functions import text as T
from sievework.operators import recon
from sievework.plans.registry import query, table


@query("""select source, strftime(ts, '%Y-%m') as month, count(*) as records, count(*) filter (v >= 50) as high, count(*) filter (v < 10) as low
from (select event_type as source, ts, cast(value as double) as v from events) group by 1, 2""")
def coverage_matrix(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"), T.month_of(F.col("ts").cast("string")).alias("month"), "value")
    return recon.coverage(e, ["source", "month"], high=F.col("value") >= 50, low=F.col("value") < 10)


@query("""select cast(user_id as varchar) as author, count(*) as records, string_agg(distinct event_type, ',' order by event_type) as kinds, min(strftime(ts, '%Y-%m')) as first_month, max(strftime(ts, '%Y-%m')) as last_month from events group by user_id""")
def author_coverage(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("author"), "event_type", T.month_of(F.col("ts").cast("string")).alias("month"))
    return recon.author_span(e, "author", "month", "event_type")


@query("""select coalesce(source, '*total*') as source, count(*) as records, count(quality) as labelled, count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as toxic
from documents left join labels using (doc_id) group by rollup (source)""")
def scan_rollup(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    g = d.rollup("source").agg(F.count("*").alias("records"), F.count("quality").alias("labelled"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    return g.withColumn("source", F.coalesce("source", F.lit("*total*")))


@query("select user_id, arg_min(event_type, row(ts, event_id)) as event_type, min(ts) as ts from events group by user_id")
def first_seen(spark, sf):
    e = table(spark, sf, "events")
    return recon.first_seen(e, "user_id", ["ts", "event_id"], "ts", "event_type").select("user_id", "event_type", "ts")


_GROWTH = """with s as (select distinct cast(ts as date) as day, user_id from events), d as (select day, lag(day) over (order by day) as before from (select distinct day from s))
select d.day, count(*) filter (s.user_id is not null and p.user_id is null) as new_keys from d left join s on s.day = d.day left join s p on p.day = d.before and p.user_id = s.user_id where d.before is not null group by d.day"""


@query(_GROWTH)
def snapshot_growth(spark, sf):
    return recon.growth(table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), "user_id"), "day", "user_id")


@query(f"with g as ({_GROWTH}) select arg_max(day, row(new_keys, -epoch(day))) as day, max(new_keys) as new_keys from g")
def largest_growth(spark, sf):
    g = recon.growth(table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), "user_id"), "day", "user_id")
    return g.agg(F.max_by("day", F.struct("new_keys", -F.unix_date("day"))).alias("day"), F.max("new_keys").alias("new_keys"))


@query("""select l_orderkey, l_linenumber, round(epoch_us(l_shipdate) / 3.6e9 - epoch_us(o_orderdate) / 3.6e9, 1) as gap_hours,
  case when gap_hours <= 36 then 'near_publication_observed' when gap_hours <= 72 then 'delayed_capture' else 'backfill_proven' end as provenance from lineitem join orders on l_orderkey = o_orderkey""")
def provenance_class(spark, sf):
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    h = F.round(T.hours_between(F.col("o_orderdate"), F.col("l_shipdate")), 1)
    return j.select("l_orderkey", "l_linenumber", h.alias("gap_hours"), T.gap_class(h).alias("provenance"))


@query("""select user_id, a.user_id is not null as accounted from (select distinct user_id from events) s
left join (select distinct user_id from events where event_type in ('click', 'purchase') and event_id % 5 = 0) a using (user_id)""")
def accounting(spark, sf):
    e = table(spark, sf, "events")
    place = lambda kind: e.filter((F.col("event_type") == kind) & (F.col("event_id") % 5 == 0))
    return recon.account(e, "user_id", place("click"), place("purchase"))


@query("""select doc_id, case when l.doc_id is not null then 'labelled' when d.doc_id % 3 = 0 then 'pending' when d.doc_id % 5 = 0 then 'backlog' else 'unaccounted' end as stage,
  cast(l.doc_id is not null as int) + cast(d.doc_id % 3 = 0 as int) + cast(d.doc_id % 5 = 0 as int) as tables from documents d left join (select distinct doc_id from labels) l using (doc_id)""".replace("as tables", "::bigint as tables"))
def stage_assignment(spark, sf):
    d = table(spark, sf, "documents")
    return recon.stages(d, "doc_id", {"labelled": table(spark, sf, "labels"), "pending": d.filter("doc_id % 3 = 0"), "backlog": d.filter("doc_id % 5 = 0")}, "unaccounted")


@query("""select source, bool_or(quality = 1) is true as any_ok, bool_and(quality is not null and quality = 1) as all_ok from documents left join labels using (doc_id) group by source""")
def completeness(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return recon.complete(d, ["source"], F.coalesce(F.col("quality") == 1, F.lit(False)))


@query("""with t as (select doc_id, lang from documents where doc_id % 2 = 0 union all select doc_id, lang from documents where doc_id % 10 = 1)
select doc_id, lang, 'left' as side from documents where doc_id % 2 = 1 and doc_id % 10 <> 1""")
def set_difference(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return recon.same_rows(d, d.filter("doc_id % 2 = 0 or doc_id % 10 = 1"))


@query("""select event_type, count(*) as probes, count(*) filter (value >= 20) as ok, count(*) filter (value < 1) as refused,
  case when count(*) filter (value >= 20) = count(*) then 'open' when count(*) filter (value < 1) = count(*) then 'refused' when count(*) filter (value >= 20) > 0 then 'partial' else 'unclear' end as verdict from events group by event_type""")
def probe_verdicts(spark, sf):
    return recon.verdicts(table(spark, sf, "events"), "event_type", F.col("value") >= 20, F.col("value") < 1)


_W = """with d as (select lang, toxic from documents join labels using (doc_id)), g as (select lang, count(*) as n, cast(sum(toxic) as bigint) as k from d group by lang),
 i as (select *, k / n as p, 1.96 * 1.96 as zz from g)
select lang, n, k, round(greatest((p + zz / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n), 0), 3) as low,
  round(least((p + zz / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n), 1), 3) as high from i"""


@query(_W)
def wilson_intervals(spark, sf):
    g = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.sum("toxic").cast("long").alias("k"))
    low, high = S.wilson(F.col("k"), F.col("n"))
    return g.select("lang", "n", "k", low.alias("low"), high.alias("high"))
