"""Queries of intake rules, discovery and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import intake, report
from sievework.plans.registry import query, table


@query("""with i as (select doc_id, source, lang from documents), f as (select * from i where doc_id % 3 = 0) select i.doc_id from i where case when doc_id % 2 = 0 then not exists (from f where lower(f.source) = lower(i.source) and f.doc_id % 100 = i.doc_id % 100)
  else not exists (from f where lower(f.source) = lower(i.source) and f.lang = i.lang) end""")
def known_by_either(spark, sf):
    """Rows that the feed has neither under their URL nor, for others, under their entry key."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", F.concat(F.lit("http://x/"), F.col("doc_id") % 100, F.lit("?q=1")).alias("url"))
    return intake.known_by_either(d, d.filter("doc_id % 3 = 0"), "source", "url", "lang", F.col("doc_id") % 2 == 0).select("doc_id")


@query("""select event_id, case when event_id % 11 = 0 or not event_id % 7 <> 0 or epoch(timestamp '2024-01-15') - epoch(ts) >= 4 * 86400 then 'backfill' else 'live_candidate' end as intake_class from events""")
def intake_classes(spark, sf):
    k = F.col("event_id")
    return table(spark, sf, "events").select("event_id", intake.intake_class(F.col("ts"), F.lit("2024-01-15").cast("timestamp"), k % 11 == 0, k % 7 != 0).alias("intake_class"))


@query("""with d as (select doc_id, doc_id % 3 <> 0 as done from documents) select doc_id, case when doc_id % 2 = 0 and done then 'live_candidate' else 'backfill' end as intake_class, case when doc_id % 10 = 0 then 'late' end as reason,
  case when doc_id % 10 = 0 or not (doc_id % 2 = 0 and done) then 'backfill' else 'live_candidate' end as revised from d""")
def demotions(spark, sf):
    """An incomplete batch is demoted whole; single rows are downgraded with their reason."""
    from sievework.operators import state

    d = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 6).alias("batch"))
    status = spark.range(6).select(F.col("id").alias("batch"), ((F.col("id") % 2 == 0) & (F.col("id") % 3 != 0)).alias("complete"))
    shown = state.demoted(d, status, "batch")
    revised = intake.downgraded(shown.withColumn("was", F.col("intake_class")), F.col("doc_id") % 10 == 0, "late", "2026-01-01")
    return revised.select("doc_id", F.col("was").alias("intake_class"), F.col("revision.reason").alias("reason"), F.col("intake_class").alias("revised"))


@query("""select user_id, event_id from (select *, row_number() over (partition by user_id order by 'Q' || (event_id % 5 + 1), value desc, event_id) as r from events) where r = 1""")
def best_acquisitions(spark, sf):
    e = table(spark, sf, "events").withColumns({"q": F.concat(F.lit("Q"), F.col("event_id") % 5 + 1), "p": -F.col("value")})
    return intake.best_acquisition(e, "user_id", "q", "p", "event_id").select("user_id", "event_id")


@query("""select doc_id, concat_ws(',', case when doc_id % 2 = 0 then 'archive' end, case when doc_id % 3 = 0 then 'category' end, case when doc_id % 5 = 0 then 'overview' end) as paths from documents where doc_id % 2 = 0 or doc_id % 3 = 0 or doc_id % 5 = 0""")
def discovery_paths(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return intake.discoveries({n: d.filter(f"doc_id % {m} = 0") for n, m in (("archive", 2), ("overview", 5), ("category", 3))}, "doc_id")


@query("""with l as (select event_id, ts, date_diff('day', cast(ts as date), date '2024-03-01') as page from events), n as (select page, max(ts) as n from l group by page), s as (select min(page) as stop from n where n < timestamp '2024-01-20')
select event_id, page from l, s where stop is null or page <= stop""")
def pages_to_cutoff(spark, sf):
    listing = table(spark, sf, "events").select("event_id", "ts", F.datediff(F.lit("2024-03-01").cast("date"), F.col("ts").cast("date")).cast("long").alias("page"))
    return intake.pages_to_cutoff(listing, "page", "ts", "2024-01-20").select("event_id", "page")


@query("""with r as (select event_type as s, count(*) as n, min(event_id) as f from events where event_id % 10 <> 0 group by 1 union all select '', count(*), min(event_id) from events where event_id % 10 = 0) select s as symbol, n as rows, f as first from r""")
def symbol_report(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.array("event_type")).otherwise(F.array().cast("array<string>")).alias("s"))
    return report.by_symbol(e, "s", "event_id")


@query("""select conv_id, sum(length(text)) + count(*) - 1 as chars, cast(ceil((sum(length(text)) + count(*) - 1) / 1e9) as bigint) as messages from conversations group by conv_id""")
def message_lengths(spark, sf):
    """Messages of bounded length: nothing is lost where a thread fits into one."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("t"))
    m = c.select("conv_id", report.messages(F.col("t"), 10**9).alias("m"))
    return m.select("conv_id", F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"), F.size("m").cast("long").alias("messages"))
