"""Queries of the pending queue and the archive behind it."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import backlog, feed, health
from sievework.plans.registry import query, table

NOW = "2024-02-10 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


_QUEUE = """with p as (select event_id as id, case when event_id % 5 = 0 then '' else 'old' || event_id end as title, case when event_id % 7 = 0 then '' else strftime(ts, '%Y-%m-%d') end as published,
  strftime(ts + to_days(cast(event_id % 3 as integer)), '%Y-%m-%d %H:%M:%S') as first_seen, event_id % 4 as retries from events where event_id % 3 = 0),
 n as (select event_id as id, case when event_id % 4 = 0 then '' else 'new' || event_id end as title, case when event_id % 6 = 0 then '' else strftime(ts, '%Y-%m-%d') end as published from events where event_id % 2 = 0)"""


def _queue(spark, sf):
    e = table(spark, sf, "events").withColumn("id", F.col("event_id"))
    k, day = F.col("id"), F.date_format("ts", "yyyy-MM-dd")
    blank = lambda m, c: F.when(k % m == 0, "").otherwise(c)
    p = e.filter("id % 3 = 0").select("id", blank(5, F.concat(F.lit("old"), "id")).alias("title"), blank(7, day).alias("published"), F.date_format(F.col("ts") + F.make_dt_interval((k % 3).cast("int")), "yyyy-MM-dd HH:mm:ss").alias("first_seen"), (k % 4).alias("retries"))
    n = e.filter("id % 2 = 0").select("id", blank(4, F.concat(F.lit("new"), "id")).alias("title"), blank(6, day).alias("published"))
    return p, n


@query(_QUEUE + f"""select coalesce(p.id, n.id) as id, coalesce(nullif(n.title, ''), nullif(p.title, ''), '') as title, coalesce(nullif(n.published, ''), nullif(p.published, ''), '') as published,
  coalesce(p.first_seen, '{NOW}') as first_seen, coalesce(p.retries, 0) + 1 as retries,
  coalesce(nullif(coalesce(nullif(n.published, ''), nullif(p.published, ''), ''), '') < substr(coalesce(p.first_seen, '{NOW}'), 1, 10), false) as historical from p full join n on p.id = n.id""")
def pending_queue(spark, sf):
    return backlog.merge(*_queue(spark, sf), _now())


@query(f"""select id from (select event_id as id, user_id % 9 = 0 as handed_in, event_id % 2 = 0 as was_pending, event_id % 5 as retries, strftime(ts, '%Y-%m-%d') as checked, cast(ts as date) as day from events)
order by not handed_in, was_pending, not (date '2024-02-10' - day between 0 and 7), retries, checked, id limit 50""")
def work_order(spark, sf):
    """The next fifty rows by seven keys."""
    e = table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    w = e.select(F.col("event_id").alias("id"), (F.col("user_id") % 9 == 0).alias("handed_in"), (F.col("event_id") % 2 == 0).alias("was_pending"), day.alias("published"), (F.col("event_id") % 5).alias("retries"), day.alias("last_checked"), F.lit("").alias("first_seen"))
    return backlog.ordered_work(w, _now(), 50).select("id")


@query("""select event_id as id, user_id as author from events where event_id % 2 = 0 and event_id % 10 <> 0 and event_id % 4 <> 0 order by author, id limit 8""")
def backlog_batch(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("author"))
    archive = e.filter("id % 4 = 0 or id % 3 = 0").withColumn("learned", F.col("id") % 4 == 0)
    return backlog.batch(e.filter("id % 2 = 0"), archive, e.filter("id % 10 = 0"), ["author", "id"])


@query("""with a as (select event_id as id, 'Q' || (event_id % 5 + 1) as quality, event_id % 6 < 3 as due from events where event_id % 2 = 0), p as (select event_id as id, 'Q2' as new_quality from events where event_id % 3 = 0)
select coalesce(a.id, p.id) as id, case when p.id is not null and (a.id is null or due) then new_quality else quality end as quality, p.id is not null and not (a.id is null or due) as skipped from a full join p on a.id = p.id""")
def carried_archive(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    archive = e.filter("id % 2 = 0").withColumns({"quality": F.concat(F.lit("Q"), F.col("id") % 5 + 1), "due": F.col("id") % 6 < 3})
    return backlog.carried(archive, e.filter("id % 3 = 0").withColumn("new_quality", F.lit("Q2")), F.col("due"))


@query("""select event_id, row_number() over (partition by cast(ts as date) order by event_type <> 'purchase', ts, event_id) <= case when event_type = 'purchase' then 60 else 40 end as allowed from events""")
def reserved_budget(spark, sf):
    """Sixty calls a day, twenty of them held back for one kind."""
    e = table(spark, sf, "events").withColumns({"day": F.col("ts").cast("date"), "p": F.when(F.col("event_type") == "purchase", "new").otherwise("backlog")})
    return backlog.within_reserve(e, "day", ["ts", "event_id"], 60, 20, "p").select("event_id", "allowed")


@query("""select event_id as id, strftime(ts, '%Y-%m-%d') as published from events where event_id % 2 = 0 and event_id % 3 = 0 and event_id % 9 <> 0""")
def date_resolutions(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("published"))
    listing = e.withColumn("published", F.when(F.col("id") % 2 == 0, F.col("published")).otherwise(""))
    return backlog.date_resolutions(e.filter("id % 3 = 0"), listing, e.filter("id % 9 = 0"))


_SNAP = "with s as (select cast(floor(epoch(ts) / 864000) as bigint) as snap, event_id as id from events)"


@query(_SNAP + """, g as (select snap, count(*) as n from s group by snap), j as (select snap from g order by n desc, snap limit 1)
select id, case when snap = (select snap from j) and id % 4 <> 0 then 'backlog' else 'pending' end as place from s where id % 2 = 0""")
def rescoped_queue(spark, sf):
    """Rows of the largest batch leave the live queue unless they are settled."""
    s = table(spark, sf, "events").select(F.floor(F.unix_timestamp("ts") / 864000).alias("snap"), F.col("event_id").alias("id"))
    jump = s.join(s.groupBy("snap").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "snap").limit(1).select("snap"), "snap", "left_semi")
    return backlog.rescoped(s.filter("id % 2 = 0"), jump, s.filter("id % 4 = 0")).select("id", "place")


@query("""select doc_id as id from documents where not (doc_id % 2 = 0 and doc_id % 6 <> 0 and doc_id % 5 <> 0)""")
def resume_answers(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    answers = d.filter("id % 2 = 0").select("id", F.when(F.col("id") % 6 == 0, "v1").otherwise("v2").alias("version"), F.when(F.col("id") % 5 == 0, "unavailable").alias("note"))
    return backlog.unanswered(d, answers, "v2")


@query("select event_id as id from events where event_id % 5 <> 0 order by id desc limit 40")
def watch_new(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return backlog.watch(e, e.filter("id % 5 = 0"), False)


@query("select event_id, row_number() over (partition by cast(ts as date) order by ts, event_id) = 1 as sends from events where event_type = 'signup'")
def daily_digest_flag(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'signup'").withColumn("day", F.col("ts").cast("date"))
    return backlog.once_a_day(e, "day", ["ts", "event_id"]).select("event_id", "sends")


@query("""with c as (select cast(ts as date) as day, case event_type when 'error' then 'exception' when 'signup' then 'refunded' when 'purchase' then 'admitted' else 'rejected' end as o, event_id % 40 = 0 as lost from events),
 s as (select day, count(*) filter (o <> 'refunded') as billed, count(*) filter (o = 'refunded') as refunded, count(*) filter (o = 'admitted') as admitted, count(*) filter (o = 'exception') as errors,
   count(*) filter (not lost) as rows, count(*) filter (o = 'admitted' and not lost) as a, count(*) filter (o = 'exception' and not lost) as e from c group by day)
select day, rows as detail_rows, greatest(0, billed + refunded - rows) as missing, case when rows = billed + refunded and a = admitted and e = errors then 'COMPLETE' else 'INCOMPLETE' end as status from s""")
def budget_reconcile(spark, sf):
    """Counters of all calls against detail rows of which every fortieth got lost."""
    o = F.when(F.col("event_type") == "error", "exception").when(F.col("event_type") == "signup", "refunded").when(F.col("event_type") == "purchase", "admitted").otherwise("rejected")
    c = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), o.alias("o"), "event_id")
    return backlog.reconciled(backlog.counters(c, "day", "o").drop("detail_rows"), c.filter("event_id % 40 <> 0"), "day", "o")


_CALLS = "with c as (select user_id, cast(ts as date) as day, event_id, event_type = 'error' and value < 50 as mism, event_type = 'error' and value >= 150 as tmo from events)"


@query(_CALLS + """select user_id, count(*) filter (mism) as mismatches, count(*) filter (tmo) as timeouts, count(*) filter (tmo and day = date '2024-01-20') as timeouts_today,
  count(*) filter (mism) >= 2 or count(*) filter (tmo) >= 3 or count(*) filter (tmo and day = date '2024-01-20') >= 1 as skip from c group by user_id""")
def given_up(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    bad = F.col("event_type") == "error"
    return health.given_up(e, "user_id", "day", F.lit("2024-01-20").cast("date"), bad & (F.col("value") < 50), bad & (F.col("value") >= 150))


@query("select user_id, count(distinct event_id) as refused from events where event_type = 'error' and cast(ts as date) <= date '2024-01-20' group by user_id having count(distinct event_id) >= 2")
def blocked_authors(spark, sf):
    e = table(spark, sf, "events").filter("cast(ts as date) <= date '2024-01-20'")
    return health.blocked(e, "user_id", "event_id", F.col("event_type") == "error")


@query("""select source, count(*) as probes, count(*) filter (q <> 'Q5') as available, count(*) filter (n_chars > 1000) as rule_capable from (select source, n_chars, case when doc_id % 6 <> 0 then 'Q' || (doc_id % 5 + 1) else 'Q5' end as q from documents) group by source""")
def provider_health(spark, sf):
    d = table(spark, sf, "documents").withColumn("q", F.when(F.col("doc_id") % 6 != 0, F.concat(F.lit("Q"), F.col("doc_id") % 5 + 1)))
    return health.providers(d, "q", F.col("n_chars") > 1000, ["source"])


@query("""with p as (select case when event_id % 6 <> 0 then 'q' || (event_id % 5 + 1) end as q, event_id % 4 as retries from events)
select count(*) filter (q in ('q1', 'q2') and retries >= 2) as stuck, count(*) filter (q is null or q in ('q3', 'q4', 'q5')) as waiting, (select count(distinct user_id) from events where event_type = 'error') as channel_errors, 'attention' as status from p""")
def intake_health(spark, sf):
    e = table(spark, sf, "events")
    p = e.select(F.when(F.col("event_id") % 6 != 0, F.concat(F.lit("q"), F.col("event_id") % 5 + 1)).alias("q"), (F.col("event_id") % 4).alias("r"))
    return health.intake(p, "q", "r", e.filter("event_type = 'error'").select("user_id").distinct())


@query("""with s as (select lang, source, count(*) as n from documents group by lang, source), m as (select lang, list_sort(list(n_chars))[count(*) // 2 + 1] as chars_median from documents group by lang)
select lang, cast(sum(n) as bigint) as items, count(*) as authors, round(max(n) / sum(n), 3) as max_author_share, any_value(chars_median) as chars_median from s join m using (lang) group by lang""")
def sample_summary(spark, sf):
    return health.sample_summary(table(spark, sf, "documents"), ["lang"], "source", "n_chars")


@query("""with f as (select doc_id, count(*) as n, count(*) filter (length(x) > 40) as c from (select doc_id, unnest(string_split(text, chr(10))) as x from documents) group by doc_id),
 e as (select doc_id, count(*) as n, count(*) filter (length(x) > 40) as c from (select doc_id, unnest(string_split(substr(text, 1, 360), chr(10))) as x from documents where doc_id % 3 <> 0) group by doc_id)
select doc_id, coalesce(f.n, 0) as claims_full, coalesce(f.c, 0) as checkable_full, coalesce(e.n, 0) as claims_excerpt, coalesce(e.c, 0) as checkable_excerpt from f full join e using (doc_id)""")
def claim_yields(spark, sf):
    """Lines of whole texts beside those of excerpts, as stand-ins for claims."""
    d = table(spark, sf, "documents")
    cut = lambda rows, t: rows.select("doc_id", F.explode(F.split(t, "\n", -1)).alias("x"))
    return health.yields(cut(d, F.col("text")), cut(d.filter("doc_id % 3 <> 0"), F.substring("text", 1, 360)), "doc_id", F.length("x") > 40)


@query("""with d as (select distinct cast(ts as date) as day from events order by day desc limit 10) select cast(ts as date) as day, event_type as key, count(*) as count from events where cast(ts as date) in (select day from d) group by 1, 2""")
def request_ledger(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("key"))
    return feed.newest(health.ledger(e, "day", "key"), "day", 10)


_POL = "with a as (select user_id as symbol, cast(ts as date) as day, event_id // 7 as record, event_type in ('purchase', 'signup') as pos from events where event_id % 3 <> 0), b as (select user_id as symbol, cast(ts as date) as day, event_id // 7 as record, event_type in ('purchase', 'click') as pos from events where event_id % 4 <> 0)"


@query(_POL + """, x as (select day, record, symbol, list(distinct pos) as p from a group by all), y as (select day, record, symbol, list(distinct pos) as q from b group by all)
select day, count(*) filter (p is not null) as our_pairs, count(*) filter (q is not null) as their_pairs, count(*) filter (p is not null and q is not null) as both_pairs,
  count(*) filter (coalesce(list_has_any(p, q), false)) as direction_agree, count(*) filter (q is null) as our_only, count(*) filter (p is null) as their_only from x full join y using (day, record, symbol) group by day""")
def shadow_stats(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("symbol"), F.col("ts").cast("date").alias("day"), F.floor(F.col("event_id") / 7).alias("record"), "event_type", "event_id")
    side = lambda m, *t: e.filter(F.col("event_id") % m != 0).withColumn("pos", F.col("event_type").isin(*t))
    return health.shadow(side(3, "purchase", "signup"), side(4, "purchase", "click"), "record", "symbol", "pos", ["day"])


@query("""with r as (select conv_id, turn, text, string_split(text, chr(10)) as lines from conversations)
select conv_id, arg_min(text, turn) as text, array_to_string(flatten(list(lines order by turn))[1:40], '|') as lines from r group by conv_id""")
def merged_submissions(spark, sf):
    c = table(spark, sf, "conversations").withColumn("lines", F.split("text", "\n", -1))
    return health.merged_lists(c, "conv_id", "turn", "lines", "text").select("conv_id", "text", F.array_join("lines", "|").alias("lines"))


@query("""with s as (select source, doc_id % 5 as stage from documents) pivot s on stage in (0, 1, 2, 3, 4) using count(*) group by source""")
def stage_matrix(spark, sf):
    """Records by source and stage."""
    return table(spark, sf, "documents").withColumn("stage", F.col("doc_id") % 5).groupBy("source").pivot("stage", [0, 1, 2, 3, 4]).count().na.fill(0)
