"""Queries over state that grows from run to run."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import state
from sievework.plans.registry import query, table


@query("""select distinct user_id from events where event_type = 'click' and user_id not in (select user_id from events where event_type = 'signup' and event_id % 20 = 0)""")
def unseen_entries(spark, sf):
    e = table(spark, sf, "events")
    signed = e.filter("event_type = 'signup' and event_id % 20 = 0").select("user_id").distinct()
    return state.unseen(e.filter("event_type = 'click'"), signed, ["user_id"]).select("user_id")


@query("""with l as (select event_type as board, event_id as entry, (row_number() over (partition by event_type order by ts desc, event_id desc) - 1) // 20 + 1 as page from events),
 a as (select event_type as board, event_id as entry from events where event_id % 97 = 0 and event_type <> 'view'),
 h as (select board, min(page) as anchor_page from l join a using (board, entry) group by board), n as (select board, count(*) as anchors from a group by board)
select board, max(page) as pages, any_value(anchor_page) as anchor_page, cast(pow(2, ceil(log2(any_value(anchor_page)))) as bigint) as scan_pages, coalesce(any_value(anchor_page) <= 8, any_value(anchors) is null) as complete
from l left join h using (board) left join n using (board) group by board""")
def anchor_continuity(spark, sf):
    from pyspark.sql import Window as W

    e = table(spark, sf, "events").select(F.col("event_type").alias("board"), F.col("event_id").alias("entry"), "ts")
    rank = F.row_number().over(W.partitionBy("board").orderBy(F.desc("ts"), F.desc("entry")))
    listing = e.withColumn("page", (F.floor((rank - 1) / 20) + 1).cast("long"))
    return state.continuity(listing, e.filter("entry % 97 = 0 and board <> 'view'"), "board", "entry", "page", 8)


@query("""select l_orderkey, l_linenumber, case when floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 8.64e10) > 30 then 'backfill' else 'live_candidate' end as intake_class from lineitem join orders on l_orderkey = o_orderkey""")
def late_label(spark, sf):
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return state.late(j, "o_orderdate", "l_shipdate", 30).select("l_orderkey", "l_linenumber", "intake_class")


@query("""select event_id, row_number() over (partition by cast(ts as date) order by ts, event_id) <= 80 as allowed from events""")
def budget_cap(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return state.within_budget(e, "day", ["ts", "event_id"], 80).select("event_id", "allowed")


@query("""select user_id, grade, floor((epoch_us(timestamp '2024-02-10') - epoch_us(ts)) / 8.64e10) >= case grade when 'click' then 30 when 'view' then 20 else 12 end as due
from (select user_id, max(ts) as ts, arg_max(event_type, row(ts, event_id)) as grade from events group by user_id)""")
def backoff_due(spark, sf):
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("grade"))
    return state.backoff_due(last, "ts", "grade", {"click": 30, "view": 20}, 12, F.lit("2024-02-10").cast("timestamp")).select("user_id", "grade", "due")


@query("""select user_id, event_id, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) where event_type is distinct from before""")
def change_alerts(spark, sf):
    return state.changes(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


@query("""with e as (select *, cast(ts as date) as day from events), d as (select distinct day from e order by day desc limit 14)
select user_id, count(distinct day) as days from e where event_type = 'view' and day in (select day from d) group by user_id having count(distinct day) >= 3""")
def unsupported_keys(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return state.persistent(e, "user_id", "day", F.col("event_type") == "view")


@query("""select doc_id, regexp_extract(text, '([A-Za-z0-9._-]+)@', 1) as name, substr(md5(text), 1, 16) as fallback_id from documents""")
def id_from_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.regexp_extract("text", "([A-Za-z0-9._-]+)@", 1).alias("name"), F.substring(F.md5("text"), 1, 16).alias("fallback_id"))


@query("""select conv_id, string_agg(role || ':' || length(text), ',' order by turn) as shape, count(*) as turns, max(turn) as last_turn from conversations group by conv_id""")
def thread_shape(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.concat_ws(":", "role", F.length("text").cast("string")).alias("s")))).alias("x"), F.count("*").alias("turns"), F.max("turn").alias("last_turn"))
    return c.select("conv_id", F.array_join(F.transform("x", lambda x: x["s"]), ",").alias("shape"), "turns", "last_turn")
