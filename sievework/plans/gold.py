"""Queries that decide which titles are the wanted ones, which posts make up a gold set, and what went wrong in it."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import identity
from sievework.operators import evaluate, fill, order
from sievework.operators.sample import seeded
from sievework.plans.registry import query, table

_TITLES = """with recursive d as (select doc_id, source, coalesce(text, '') as t, 'src' || right(cast(doc_id as varchar), 1) || '/feed' as author from documents),
 w as (select doc_id, case when doc_id % 3 = 0 then '' else source end as channel, substr(t, 1, 28) || case when doc_id % 4 = 0 then ' AB CDE' else '' end as title,
  case when doc_id % 5 = 0 then substr(t, 29, 28) else substr(t, 1 + doc_id % 14, 28) end || case when doc_id % 8 = 0 then ' CDE AB' else '' end as seen, author from d),
 f as (select *, regexp_replace(lower(title), '[^\\p{L}\\p{N}]+', '', 'g') as b, regexp_replace(lower(seen), '[^\\p{L}\\p{N}]+', '', 'g') as a,
  regexp_replace(lower(channel), '[^\\p{L}\\p{N}]+', '', 'g') as c, list_filter(list_transform(string_split(author, '/'), lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g')), lambda x: x <> '') as names from w),
 s as (select doc_id, a, b, 0 as a0, length(a) as a1, 0 as b0, length(b) as b1, 0 as got, 0 as lvl from f
  union all select doc_id, a, b, x.x[1], x.x[2], x.x[3], x.x[4], n, lvl + 1 from (
   select s.doc_id, s.a, s.b, s.lvl, a0, a1, b0, b1, arg_max(i, (k, -i, -j)) as i, arg_max(j, (k, -i, -j)) as j, max(k) as n from (
    select s.*, i, j, list_max(list_filter(range(1, 1 + least(a1 - i, b1 - j)), lambda z: substr(a, i + 1, z) = substr(b, j + 1, z))) as k
    from s, unnest(range(a0, a1)) as p(i), unnest(range(b0, b1)) as q(j) where substr(a, i + 1, 1) = substr(b, j + 1, 1)) as s group by ALL) as best,
   unnest([[a0, i, b0, j], [i + n, a1, j + n, b1]]) as x(x)),
 m as (select doc_id, sum(got) / 2 as m from s where lvl > 0 group by doc_id),
 r as (select f.*, case when length(a) + length(b) = 0 then 1.0 else 2 * coalesce(m, 0) / (length(a) + length(b)) end as ratio,
  c <> '' and len(list_filter(names, lambda x: contains(c, x) or contains(x, c))) > 0 as channel_hit,
  list_distinct(regexp_extract_all(title, '\\b[A-Z]{2,5}\\b')) as want, list_distinct(regexp_extract_all(seen, '\\b[A-Z]{2,5}\\b')) as own from f left join m using (doc_id))
select doc_id, round(ratio, 6) as ratio, channel_hit, cast(len(list_intersect(want, own)) as bigint) as shared,
 a <> '' and b <> '' and (ratio >= 0.6 or channel_hit and (ratio >= 0.35 or len(want) >= 2 and len(list_intersect(want, own)) >= 2)) as same from r"""


@query(_TITLES)
def title_identity(spark, sf):
    """A title against what was seen of the same document: shifted, of another place, or with symbols behind."""
    k, t = F.col("doc_id"), F.coalesce("text", F.lit(""))
    place = lambda a, n: F.substring(t, a, n)
    title = F.concat(place(F.lit(1), F.lit(28)), F.when(k % 4 == 0, " AB CDE").otherwise(""))
    seen = F.concat(F.when(k % 5 == 0, place(F.lit(29), F.lit(28))).otherwise(place((k % 14 + 1).cast("int"), F.lit(28))), F.when(k % 8 == 0, " CDE AB").otherwise(""))
    channel = F.when(k % 3 == 0, "").otherwise(F.col("source"))
    author = F.concat(F.lit("src"), F.substring(k.cast("string"), -1, 1), F.lit("/feed"))
    same = identity.same_title(seen, channel, F.lit(None).cast("array<string>"), title, author, identity.WHOLE_SYMBOL)
    return table(spark, sf, "documents").select(k, same.alias("s")).select("doc_id", F.round("s.ratio", 6).alias("ratio"), "s.channel_hit", "s.shared", "s.same")


_POSTS = """with p as (select doc_id, source, lang, 1 + n_chars % 7 as items, sha256('q|' || doc_id) as q, sha256('s|' || source) as h from documents where n_chars is not null),
 n as (select cast(sum(items) as bigint) as every from p)"""
_FILL = """f{k} as (select *, sum(items) over (partition by source order by q, doc_id) as own, row_number() over (partition by source order by q, doc_id) as turn from {rows}),
 r{k} as (select f{k}.*, coalesce(sum(items) over (order by turn, h, source rows between unbounded preceding and 1 preceding), 0) as before from f{k}, {goal} where own <= floor(0.25 * goal)),
 t{k} as (select * from r{k}, {goal} where before < goal)"""


def _posts(spark, sf):
    return table(spark, sf, "documents").filter("n_chars is not null").select("doc_id", "source", "lang", (F.col("n_chars") % 7 + 1).alias("items"))


def _queue():
    return [seeded("q", F.col("doc_id")).asc(), F.col("doc_id").asc()]


@query(_POSTS + ", g as (select every // 3 as goal from n), " + _FILL.format(k="1", rows="p", goal="g") + " select doc_id, source, turn as round, cast(before as bigint) as before from t1")
def whole_post_fill(spark, sf):
    """Posts of all sources in turn until a third of all items is taken, a quarter of that from one source at most."""
    posts = _posts(spark, sf)
    target = (posts.agg(F.sum("items")).first()[0] or 0) // 3
    return fill.fill(posts, "source", "items", _queue(), "s", target, int(0.25 * target)).select("doc_id", "source", F.col("round").cast("long").alias("round"), F.col("before").cast("long").alias("before"))


@query(_POSTS + """, c as (select * from p where lang = 'es'), free as (select * from p where lang <> 'es'), g as (select every // 3 - (select coalesce(sum(items), 0) from c) as goal from n),
 """ + _FILL.format(k="1", rows="free", goal="g") + ", left_ as (select * from free where doc_id not in (select doc_id from t1)), e as (select every // 2 as goal from n), " + _FILL.format(k="2", rows="left_", goal="e") + """,
 u as (select *, coalesce(sum(items) over (order by h, source, q, doc_id rows between unbounded preceding and 1 preceding), 0) as upto from left_ where doc_id not in (select doc_id from t2)),
 v as (select doc_id from u, e where upto < goal - (select coalesce(sum(items), 0) from t2))
select doc_id, case when doc_id in (select doc_id from c union select doc_id from t1) then 'test' else 'dev' end as split, items from p
 where doc_id in (select doc_id from c union select doc_id from t1 union select doc_id from t2 union select doc_id from v)""")
def gold_splits(spark, sf):
    """Test and dev sets: all Spanish posts and a fill are the test set, a second fill, topped up, is the dev set."""
    posts = _posts(spark, sf)
    every = posts.agg(F.sum("items")).first()[0] or 0
    return fill.splits(posts, "doc_id", "source", "items", F.col("lang") == "es", _queue(), "s", every // 3, every // 2, 0.25).select("doc_id", "split", "items")


@query("""with g as (select l.doc_id as item, s.symbol, case when quality = 1 then s.good else 'sell' end as stance, case when l.doc_id % 6 = 0 then 'sell_put' end as instrument
  from labels l join documents d using (doc_id), unnest([(d.lang, 'add'), ('w' || n_chars % 3, 'avoid')]) as u(s_), lateral (select u.s_[1] as symbol, u.s_[2] as good) s where l.doc_id % 5 <> 0),
 f as (select d.doc_id as item, u.s_[1] as symbol, u.s_[2] as stance from documents d join labels l using (doc_id), unnest([(d.lang, case when n_chars % 2 = 0 then 'buy' else 'hold' end), ('w' || n_chars % 4, 'avoid')]) as u(s_) where d.doc_id % 4 <> 0),
 k as (select doc_id as item, lang as symbol from documents union select doc_id, 'w1' from documents),
 gc as (select distinct item, symbol, case stance when 'buy' then 'long' when 'add' then 'long' when 'sell' then 'reduce' when 'trim' then 'reduce' else stance end as stance from g),
 fc as (select distinct item, symbol, case stance when 'buy' then 'long' when 'add' then 'long' when 'sell' then 'reduce' when 'trim' then 'reduce' else stance end as stance from f),
 wrong as (select * from fc except select * from gc), miss as (select * from gc except select * from fc),
 e as (select item, case when exists (from gc where gc.item = w.item and gc.symbol = w.symbol) then 'wrong_stance' when not exists (from gc where gc.item = w.item) then 'claim_where_none' else 'wrong_symbol' end as error from wrong w
  union all select item, 'wrong_stance_option_semantics' from wrong w where exists (from gc where gc.item = w.item and gc.symbol = w.symbol) and exists (from g where g.item = w.item and instrument = 'sell_put')
  union all select item, case when exists (from fc where fc.item = m.item and fc.symbol = m.symbol) then 'stance_mismatch' when not exists (from k where k.item = m.item and k.symbol = m.symbol) then 'missed_symbol_not_detected' else 'missed_stance' end from miss m)
select error, count(*) as n, count(distinct item) as items from e group by error""")
def error_classes(spark, sf):
    """The seven kinds of error of claims about the labelled documents, with the items that have them."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumnRenamed("doc_id", "item")
    pair = lambda symbol, stance: F.struct(symbol.alias("symbol"), stance.alias("stance"))
    named = lambda n: F.concat(F.lit("w"), (F.col("n_chars") % n).cast("string"))
    good = lambda s: F.when(F.col("quality") == 1, s).otherwise("sell")
    gold = d.filter("item % 5 <> 0").select("item", F.when(F.col("item") % 6 == 0, "sell_put").alias("instrument"), F.inline(F.array(pair(F.col("lang"), good("add")), pair(named(3), good("avoid")))))
    found = d.filter("item % 4 <> 0").select("item", F.inline(F.array(pair(F.col("lang"), F.when(F.col("n_chars") % 2 == 0, "buy").otherwise("hold")), pair(named(4), F.lit("avoid")))))
    every = table(spark, sf, "documents").select(F.col("doc_id").alias("item"), F.explode(F.array(F.col("lang"), F.lit("w1"))).alias("symbol"))
    return evaluate.error_classes(gold, found, every).groupBy("error").agg(F.count("*").alias("n"), F.count_distinct("item").alias("items"))


@query("""select cast(row_number() over (order by coalesce(cast(o_orderdate as varchar), ''), coalesce(o_orderpriority, ''), o_orderkey) - 1 as bigint) as seq, o_orderkey from orders""")
def ordered_feed(spark, sf):
    """The place of each order by day, priority and key, null as an empty text, over all files."""
    day, rank = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("o_orderdate", "o_orderpriority"))
    return order.numbered(table(spark, sf, "orders"), [day.asc(), rank.asc(), F.col("o_orderkey").asc()]).select("seq", "o_orderkey")
