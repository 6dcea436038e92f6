"""Queries that split, sample and score beyond one table of pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import evaluate as E
from sievework.operators import feed, sample
from sievework.plans.registry import query, table

_SETS = """with items as (select doc_id as item, case when doc_id % 2 = 0 then 'dev' else 'test' end as split, doc_id % 11 = 0 as ambiguous, doc_id % 13 <> 0 as available from documents),
 gold as (select doc_id as item, lang as symbol, case when doc_id % 3 = 0 then 'buy' else 'sell' end as stance from documents where doc_id % 5 <> 0),
 found as (select doc_id as item, lang as symbol, case when doc_id % 6 = 0 then 'buy' else 'sell' end as stance from documents where doc_id % 4 <> 0 union select doc_id, 'extra', 'buy' from documents where doc_id % 10 = 0)"""


def _sets(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    items = d.select(k.alias("item"), F.when(k % 2 == 0, "dev").otherwise("test").alias("split"), (k % 11 == 0).alias("ambiguous"), (k % 13 != 0).alias("available"))
    gold = d.filter(k % 5 != 0).select(k.alias("item"), F.col("lang").alias("symbol"), F.when(k % 3 == 0, "buy").otherwise("sell").alias("stance"))
    a = d.filter(k % 4 != 0).select(k.alias("item"), F.col("lang").alias("symbol"), F.when(k % 6 == 0, "buy").otherwise("sell").alias("stance"))
    b = d.filter(k % 10 == 0).select(k.alias("item"), F.lit("extra").alias("symbol"), F.lit("buy").alias("stance"))
    return items, gold, E.union(a, b)


@query(_SETS + """, u as (select item, split from items where not ambiguous and available), j as (select coalesce(g.item, f.item) as item, g.item is not null as g, f.item is not null as f from gold g full join found f on g.item = f.item and g.symbol = f.symbol and g.stance = f.stance),
 p as (select split, u.item, count(*) filter (g and f) as tp, count(*) filter (f and not g) as fp, count(*) filter (g and not f) as fn from u left join j on j.item = u.item group by split, u.item),
 s as (select split, count(*) as scored, cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, cast(sum(fn) as bigint) as fn, count(*) filter (tp + fp = 0) as abstained, count(*) filter (tp + fp + fn = 0) as abstained_rightly from p group by split),
 n as (select split, count(*) as items, count(*) filter (ambiguous) as ambiguous, count(*) filter (not ambiguous and not available) as unavailable from items group by split)
select split, items, ambiguous, unavailable, scored, tp, fp, fn, abstained, abstained_rightly, round(scored / (items - ambiguous), 3) as traceability, round(tp / (tp + fp), 3) as precision, round(tp / (tp + fn), 3) as recall,
  round((tp + fp) / (tp + fn), 3) as coverage, round(abstained / scored, 3) as abstain_rate from n join s using (split)""")
def split_scores(spark, sf):
    return E.split_scores(*_sets(spark, sf))


@query(_SETS + """select case when item % 2 = 0 then 'executed' else 'plan' end as gate, count(*) filter (exists (from gold g where g.item = f.item and g.symbol = f.symbol and g.stance = f.stance)) as correct,
  count(*) filter (not exists (from gold g where g.item = f.item and g.symbol = f.symbol and g.stance = f.stance)) as wrong from found f where item % 7 <> 0 group by 1""")
def gate_scores(spark, sf):
    _, gold, found = _sets(spark, sf)
    gate = F.when(F.col("item") % 7 != 0, F.when(F.col("item") % 2 == 0, "executed").otherwise("plan"))
    return E.by_gate(gold, found.withColumn("gate", gate), ["item", "symbol", "stance"], "gate")


@query(_SETS + """select split, count(*) as items, sha256(cast(sum(cast(('0x' || substr(sha256(item || chr(31) || cast(ambiguous as varchar)), 1, 15)) as bigint)) as varchar)) as frozen from items group by split""")
def freeze_hash(spark, sf):
    """A digest of each split; any change to a frozen item changes it."""
    items, _, _ = _sets(spark, sf)
    return items.groupBy("split").agg(F.count("*").alias("items"), feed.digest(F.col("item"), F.col("ambiguous")).alias("frozen"))


@query("""with r as (select doc_id, lang, quality = 1 as a, n_chars >= 500 as b from documents join labels using (doc_id)), c as (select unnest(list_filter([case when doc_id % 2 = 0 then 'title' end, case when lang = 'en' then 'english' end, 'all'], lambda x: x is not null)) as channel, a, b from r),
 g as (select channel, count(*) as n, avg(cast(a = b as double)) as o, avg(cast(a as double)) as x, avg(cast(b as double)) as y from c group by channel), e as (select *, x * y + (1 - x) * (1 - y) as e from g)
select channel, n, round(o, 3) as observed, round(case when e < 1 then (o - e) / (1 - e) end, 3) as kappa from e""")
def channel_agreement(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "lang", (F.col("quality") == 1).alias("a"), (F.col("n_chars") >= 500).alias("b"))
    return E.kappa_by(E.channels(d, title=F.col("doc_id") % 2 == 0, english=F.col("lang") == "en", all=F.lit(True)), "a", "b", "channel")


@query("""with p as (select source, bool_or(quality = 1) as a, bool_or(n_chars >= 5000) as b from documents join labels using (doc_id) group by source)
select case when a and b then 'both' when a then 'left_only' when b then 'right_only' else 'neither' end as held, count(*) as n from p group by 1""")
def post_confusion(spark, sf):
    """Ratings joined into one per post, if any of its items has one."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    p = d.groupBy("source").agg(F.bool_or(F.col("quality") == 1).alias("a"), F.bool_or(F.col("n_chars") >= 5000).alias("b"))
    return p.groupBy(F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "left_only").when(F.col("b"), "right_only").otherwise("neither").alias("held")).agg(F.count("*").alias("n"))


@query(_SETS + """, i as (select item, case when item % 17 = 0 then 'unavailable' when ambiguous then 'gold_ambiguous' end as skipped from items), g as (select item, symbol, max(stance) as stance from gold group by all), f as (select item, symbol, max(stance) as stance from found group by all),
 b as (select coalesce(g.item, f.item) as item, coalesce(g.symbol, f.symbol) as symbol, g.stance as x, f.stance as y from g full join f on g.item = f.item and g.symbol = f.symbol)
select i.item, coalesce(symbol, '_none_') as symbol, coalesce(x, 'none') as gold, coalesce(y, 'none') as answer, null::varchar as skipped from i left join b on b.item = i.item where i.skipped is null
union all select item, null, null, null, skipped from i where skipped is not null""")
def blind_decisions(spark, sf):
    items, gold, found = _sets(spark, sf)
    one = lambda d: d.groupBy("item", "symbol").agg(F.max("stance").alias("stance"))
    return E.blind_pairs(items.withColumn("status", F.when(F.col("item") % 17 == 0, "unavailable")), one(gold), one(found))


@query("""select doc_id, case when doc_id % 2 = 0 then 'dev' else 'test' end as split, case when doc_id % 3 = 0 and doc_id % 2 = 0 then 'fixed2' else lang end as label, doc_id % 3 = 0 and doc_id % 2 = 1 as refused from documents""")
def adjudicated_items(spark, sf):
    """The newest patch applies to development items; one for a frozen item is refused."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("test").alias("split"), F.col("lang").alias("label"))
    patch = d.filter("doc_id % 3 = 0").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    return E.adjudicated(d, patch.withColumn("label", F.concat(F.lit("fixed"), "seq")), "doc_id", "seq", "label")


@query("""with s as (select source, count(*) as size, sum(count(*)) over () as total from documents group by source) select source, size, least(size, greatest(3, cast(round_even(60 * size / total, 0) as bigint))) as quota from s""")
def author_quotas(spark, sf):
    return sample.allocated(table(spark, sf, "documents"), "source", 60, 3)


@query("""with s as (select source, count(*) as size, sum(count(*)) over () as total from documents group by source), q as (select source, size, least(size, greatest(3, cast(round_even(60 * size / total, 0) as bigint))) as quota from s),
 r as (select doc_id, d.source, lang, quota, greatest(1, cast(round_even(quota * count(*) over (partition by d.source, lang) / size, 0) as bigint)) as share, row_number() over (partition by d.source, lang order by sha256('y|' || doc_id), doc_id) as r from documents d join q using (source)),
 l as (select *, row_number() over (partition by source order by sha256('y2|' || doc_id), doc_id) as l from r where r <= share)
select doc_id, source, lang from l where l <= quota""")
def stratified_years(spark, sf):
    """Rows by author quota, spread over a second stratum."""
    return sample.by_year(table(spark, sf, "documents").select("doc_id", "source", "lang"), "source", "lang", "doc_id", 60, 3, "y")


@query("""with r as (select doc_id, n_chars > 1000 as flag, row_number() over (partition by n_chars > 1000 order by sha256('t|' || doc_id), doc_id) as r from documents), n as (select least(count(*) filter (flag), 24) as k from r)
select doc_id, case when r <= case when flag then k else 40 - k end then 'test' else 'dev' end as split from r, n""")
def flag_split(spark, sf):
    return sample.split_by_flag(table(spark, sf, "documents").select("doc_id", "n_chars"), F.col("n_chars") > 1000, "doc_id", 40, 0.6, "t").select("doc_id", "split")


@query("""select doc_id, row_number() over (order by sha256('owner|' || doc_id), doc_id) <= 25 as owner_subset from documents""")
def nested_subset(spark, sf):
    return sample.marked_subset(table(spark, sf, "documents").select("doc_id"), "doc_id", 25, "owner", "owner_subset")


@query("""select substr(sha256('b|' || doc_id), 1, 10) as blind_id, lang from documents join labels using (doc_id)""")
def blind_export(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")
    return sample.blind(d, "doc_id", ["quality", "toxic"], "b")


@query()
def two_pass_greedy(spark, sf):
    """Flagged rows first up to twenty, then others up to ten more, then any; at most six of a source."""
    d = table(spark, sf, "documents").select("doc_id", "source", (F.col("n_chars") > 1000).alias("flag"))
    return sample.passes(d, "source", "doc_id", [("flagged", F.col("flag"), 20), ("other", ~F.col("flag"), 10), ("top_up", F.lit(True), 5)], 6, "p")
