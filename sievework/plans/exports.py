"""Queries of thread walks and side files."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import sets
from sievework.plans.registry import query, table
from sievework.sources import parse, threads


@query("""with recursive t as (select conv_id, turn, case when turn > 0 then (turn - 1) // 2 end as parent, (turn * 5) % 8 as o from conversations),
 w as (select conv_id, turn, 0 as depth, [o * 100 + turn] as path from t where parent is null union all select t.conv_id, t.turn, depth + 1, list_append(path, t.o * 100 + t.turn) from t join w on t.conv_id = w.conv_id and t.parent = w.turn)
select conv_id, turn, depth, row_number() over (partition by conv_id order by path) as place from w""")
def thread_walk(spark, sf):
    """Turns as a binary tree, walked from the root; turns under one that is missing can't be reached."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") > 0, F.floor((F.col("turn") - 1) / 2)).alias("parent"), (F.col("turn") * 5 % 8).alias("o"))
    return threads.walked(c, "conv_id", "turn", "parent", "o")


@query("""with d as (select conv_id, turn, case when turn = 0 then 0 else 1 + (turn * 3 + conv_id) % 4 end as depth from conversations)
select a.conv_id, a.turn, coalesce((select max(b.turn) from d b where b.conv_id = a.conv_id and b.turn < a.turn and b.depth < a.depth), a.conv_id) as parent from d a""")
def depth_tree(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") == 0, 0).otherwise(1 + (F.col("turn") * 3 + F.col("conv_id")) % 4).cast("int").alias("depth"))
    return parse.tree(c, "conv_id", "turn", "depth", "turn").select("conv_id", "turn", F.col("parent").cast("long").alias("parent"))


@query("""with e as (select event_id, user_id from events), base as (select * from e where event_id % 3 <> 0), mine as (select event_id, user_id + 1000000 as user_id from e where event_id % 2 = 0)
select * from base union all select * from mine where event_id not in (select event_id from base)""")
def side_file(spark, sf):
    """Rows that only one side has, carried over to a fresh base, twice."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    base, mine = e.filter("event_id % 3 <> 0"), e.filter("event_id % 2 = 0").withColumn("user_id", F.col("user_id") + 1000000)
    side = sets.unsent(mine, e.filter("event_id % 5 = 0 and event_id % 3 <> 0"), "event_id")
    return sets.reapplied(sets.reapplied(base, side, "event_id"), side, "event_id")
