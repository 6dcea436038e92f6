"""Queries that sample, rank and queue."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.operators import feed, sample, state
from sievework.plans.registry import query, table


@query("""with r as (select doc_id, lang, row_number() over (partition by lang order by sha256('s1|' || doc_id), doc_id) as r, count(*) over (partition by lang) as n from documents)
select doc_id, lang from r where r <= greatest(1, round(n * 0.2))""")
def hash_sample(spark, sf):
    return sample.per_stratum(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], "s1", "doc_id", 0.2)


_QUOTAS = """select lang, band, size, cast(floor(size * 50 / total) + cast(row_number() over (order by size * 50 % total desc, lang, band) <= 50 - sum(floor(size * 50 / total)) over () as int) as bigint) as quota from (
  select *, sum(size) over () as total from (select lang, case when length(text) >= 1000 then 'full_text' when length(text) > 0 then 'excerpt' else 'title_only' end as band, count(*) as size from documents group by 1, 2))"""


@query(_QUOTAS)
def largest_remainder(spark, sf):
    d = table(spark, sf, "documents").select("lang", X.depth(F.length("text")).alias("band"))
    return sample.largest_remainder(d, ["lang", "band"], 50)


@query("""with t as (select event_id, weekofyear(ts) as week, row_number() over (partition by weekofyear(ts) order by sha256('w|' || event_id), event_id) as turn from events)
select event_id, week, turn from t order by turn, week limit 200""")
def week_round_robin(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.weekofyear("ts").cast("long").alias("week"))
    return sample.round_robin(e, "week", [sample.seeded("w", F.col("event_id")), "event_id"], 200).select("event_id", "week", F.col("turn").cast("long").alias("turn"))


@query()
def capped_greedy(spark, sf):
    """Quotas by language, at most five documents of a source over all languages."""
    d = table(spark, sf, "documents")
    quotas = sample.largest_remainder(d, ["lang"], 60)
    return sample.capped_greedy(d, "lang", "source", "doc_id", quotas, 5, "g1")


@query("select event_id, user_id from (select *, case event_type when 'purchase' then 0 when 'signup' then 1 else 2 end as p from events) order by p, value desc, event_id limit 60")
def work_queue(spark, sf):
    p = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    return state.worklist(table(spark, sf, "events"), [p, F.desc("value"), "event_id"], 60).select("event_id", "user_id")


@query("""select conv_id, turn, sha256(coalesce(string_agg(text, '|') over (partition by conv_id order by turn rows between 5 preceding and 1 preceding), '')) as earlier_sha256 from conversations""")
def thread_context(spark, sf):
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-5, -1)
    return table(spark, sf, "conversations").select("conv_id", "turn", F.sha2(F.array_join(F.collect_list("text").over(w), "|"), 256).alias("earlier_sha256"))


@query("""select c.conv_id, c.turn, p.role as parent_role, (select count(*) from conversations k where k.conv_id = c.conv_id and k.turn = c.turn + 1) as replies
from conversations c left join conversations p on p.conv_id = c.conv_id and p.turn = c.turn - 1""")
def reply_tree(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    parents = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("parent_role"))
    replies = c.groupBy("conv_id", (F.col("turn") - 1).alias("turn")).agg(F.count("*").alias("replies"))
    return c.join(parents, ["conv_id", "turn"], "left").join(replies, ["conv_id", "turn"], "left").select("conv_id", "turn", "parent_role", F.coalesce("replies", F.lit(0)).cast("long").alias("replies"))


@query("""select conv_id, turn, last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as heading from conversations""")
def heading_carry(spark, sf):
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("text")), ignorenulls=True).over(w).alias("heading"))


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r <= 3")
def latest_per_key(spark, sf):
    return feed.first_of(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id", "event_type")


@query("""with d as (select *, row_number() over (partition by source order by n_chars desc, doc_id) as r, count(*) over (partition by source) as n from documents)
select source, string_agg(doc_id, ',' order by r) filter (r <= 8) as shown, max(n) - 8 as more from d group by source having max(n) > 8""")
def digest(spark, sf):
    """The eight longest documents of each source, and how many more there are."""
    d = table(spark, sf, "documents")
    top = feed.first_of(d.select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), "doc_id"], 8)
    shown = top.groupBy("source").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n_chars")).alias("a"), "doc_id"))), lambda x: x["doc_id"].cast("string")), ",").alias("shown"))
    return shown.join(d.groupBy("source").agg((F.count("*") - 8).alias("more")).filter("more > 0"), "source")
