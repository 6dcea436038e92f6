"""Queries that score extractors and raters."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.functions import stats as S
from sievework.operators import evaluate as E
from sievework.plans.registry import query, table

_PAIRS = "with p as (select lang, quality = 1 as a, n_chars >= 500 as b from documents join labels using (doc_id))"


def _pairs(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return j.select("doc_id", "lang", (F.col("quality") == 1).alias("a"), (F.col("n_chars") >= 500).alias("b"), "quality", "toxic", "n_chars")


@query(_PAIRS + """, g as (select count(*) as n, avg(cast(a = b as double)) as o, avg(cast(a as double)) as x, avg(cast(b as double)) as y from p)
select n, round(o, 3) as observed, round((o - (x * y + (1 - x) * (1 - y))) / (1 - (x * y + (1 - x) * (1 - y))), 3) as kappa from g""")
def kappa_binary(spark, sf):
    return E.kappa_binary(_pairs(spark, sf), "a", "b")


_BAND = "case when n_chars >= {0} then 'full_text' when n_chars > 0 then 'excerpt' else 'title_only' end"


@query(f"""with p as (select {_BAND.format(1000)} as a, {_BAND.format(2000)} as b from documents), n as (select count(*) as n, count(*) filter (a = b) as same from p),
 m as (select sum(x * y) as xy from (select a as c, count(*) as x from p group by a) join (select b as c, count(*) as y from p group by b) using (c))
select n, round(same / n, 3) as observed, round(case when xy / (n * n) < 1 then (same / n - xy / (n * n)) / (1 - xy / (n * n)) else 1.0 end, 3) as kappa from n, m""")
def kappa_multi(spark, sf):
    d = table(spark, sf, "documents").select(X.depth(F.col("n_chars")).alias("a"), X.depth(F.col("n_chars"), 2000).alias("b"))
    return E.kappa_multi(d, "a", "b")


@query(_PAIRS + """select lang, count(*) filter (a and b) as tp, count(*) filter (b and not a) as fp, count(*) filter (a and not b) as fn,
  round(count(*) filter (a and b) / nullif(count(*) filter (b), 0), 3) as precision, round(count(*) filter (a and b) / nullif(count(*) filter (a), 0), 3) as recall from p where a or b group by lang""")
def precision_recall(spark, sf):
    p = _pairs(spark, sf)
    return E.precision_recall(p.filter("a").select("doc_id", "lang"), p.filter("b").select("doc_id", "lang"), ["doc_id", "lang"], ["lang"])


_STANCE = "case doc_id % {0} when 0 then null when 1 then 'buy' when 2 then 'sell' else 'hold' end"


@query(f"""with p as (select doc_id, {_STANCE.format(5)} as g, {_STANCE.format(4)} as f from documents),
 c as (select case when g is null and f is null then 'both_silent' when f is null then 'missed' when g is null then 'invented' when g = f then 'right'
  when (g in ('buy', 'add', 'bullish', 'hold')) = (f in ('buy', 'add', 'bullish', 'hold')) then 'wrong_stance' else 'wrong_direction' end as error from p)
select error, count(*) as n from c group by error""")
def error_taxonomy(spark, sf):
    stance = lambda m: F.when(F.col("doc_id") % m == 0, None).when(F.col("doc_id") % m == 1, "buy").when(F.col("doc_id") % m == 2, "sell").otherwise("hold")
    return table(spark, sf, "documents").select(E.error_class(stance(5), stance(4)).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query("""with p as (select doc_id, case when doc_id % 4 = 0 then null when doc_id % 3 = 0 then 'buy' else 'sell' end as l, case when doc_id % 5 = 0 then null when doc_id % 2 = 0 then 'hold' else 'trim' end as r from documents)
select doc_id, case when r is null then 'left_only' when l is null then 'right_only' else 'both' end as held, coalesce((l = 'buy') = (r = 'hold'), false) as agree from p where l is not null or r is not null""")
def polarity_agreement(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    k = F.col("doc_id")
    left = d.filter(k % 4 != 0).withColumn("stance", F.when(k % 3 == 0, "buy").otherwise("sell"))
    right = d.filter(k % 5 != 0).withColumn("stance", F.when(k % 2 == 0, "hold").otherwise("trim"))
    return E.agreement(left, right, ["doc_id"], "stance")


@query("""with s as (select lang, avg(cast(toxic = 1 as double)) as share from documents join labels using (doc_id) group by lang), p as (select lang, count(*) as n from documents group by lang)
select round(sum(n * share) / sum(n), 3) as share, cast(sum(n) as bigint) as population from s join p using (lang)""")
def weighted_share(spark, sf):
    d = table(spark, sf, "documents")
    return E.weighted_share(d.join(table(spark, sf, "labels"), "doc_id"), d.groupBy("lang").agg(F.count("*").alias("n")), "lang", F.col("toxic") == 1)


@query("""select split, lang, cast(sum(toxic) as bigint) as toxic, count(*) as n, round(sum(toxic) / count(*), 3) as share from (select lang, toxic, case when doc_id % 2 = 0 then 'dev' else 'test' end as split from documents join labels using (doc_id)) group by grouping sets ((split), (split, lang))""")
def breakdown(spark, sf):
    """Scores by split, and by split and kind, in one pass."""
    p = _pairs(spark, sf).withColumn("split", F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("test"))
    g = p.groupingSets([["split"], ["split", "lang"]], "split", "lang").agg(F.sum("toxic").cast("long").alias("toxic"), F.count("*").alias("n"))
    return g.withColumn("share", S.ratio(F.col("toxic"), F.col("n")))
