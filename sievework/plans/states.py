"""Queries over budgets, histories, manifests and proofs of cover."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import cover, history, merkle, quota
from sievework.plans.registry import query, table

_WALK = """with recursive a as (select event_id, cast(cast(ts as date) as varchar) as day, case when value < 20 then 'm1' when value < 35 then 'm2' else 'm3' end as model,
  case event_type when 'error' then 429 when 'click' then 503 when 'signup' then 403 else 200 end as status, row_number() over (partition by cast(ts as date) order by ts, event_id) as i from events where value is not null),
 w as (select distinct day, 0 as i, 0 as calls, false as dead, []::varchar[] as spent, null::bigint as event_id, null::varchar as outcome from a
  union all select day, i, calls + case when o in ('admitted', 'error', 'exhausted') then 1 else 0 end, dead or o = 'exhausted', case when o = 'fallback_spent' then list_append(spent, model) else spent end, event_id, o
  from (select a.*, w.calls, w.dead, w.spent, case when dead or calls >= 40 then 'refused' when a.model <> 'm1' and list_contains(spent, a.model) then 'skipped' when status = 503 then 'refunded'
   when status = 429 and a.model <> 'm1' then 'fallback_spent' when status = 429 then 'exhausted' when status = 200 then 'admitted' else 'error' end as o from w join a on a.day = w.day and a.i = w.i + 1) as x)"""


def attempts(events):
    """Events as call attempts of a day; errors are spent quotas, clicks overloads, and small values the first model."""
    model = F.when(F.col("value") < 20, "m1").when(F.col("value") < 35, "m2").otherwise("m3")
    status = F.when(F.col("event_type") == "error", 429).when(F.col("event_type") == "click", 503).when(F.col("event_type") == "signup", 403).otherwise(200)
    return events.filter("value is not null").select("event_id", "ts", F.to_date("ts").cast("string").alias("day"), model.alias("model"), status.alias("status"))


def _outcomes(spark, sf):
    return quota.outcomes(attempts(table(spark, sf, "events")), "day", ["ts", "event_id"], "model", "status", "m1", 40)


@query(_WALK + " select event_id, outcome from w where i > 0")
def refund_outcomes(spark, sf):
    """What each call attempt came to under a day's budget with refunds."""
    return _outcomes(spark, sf).select("event_id", "outcome")


@query(_WALK + """ select day, count(*) filter (outcome in ('admitted', 'error', 'exhausted')) as calls, count(*) filter (outcome = 'admitted') as admitted, count(*) filter (outcome in ('error', 'refunded', 'fallback_spent')) as errors,
  count(*) filter (outcome in ('refunded', 'fallback_spent')) as refunded, bool_or(outcome = 'exhausted') as exhausted, coalesce(array_to_string(list_sort(list_distinct(max(spent))), ','), '') as spent from w where i > 0 group by day""")
def refund_budgets(spark, sf):
    """The state of each day's budget, refunds given back and spent fallbacks listed."""
    return quota.budgets(_outcomes(spark, sf), "day", "model").withColumn("spent", F.array_join("spent", ","))


_MONTHS = """with o as (select o_custkey, (year(o_orderdate) * 12 + month(o_orderdate)) as m, o_orderstatus, o_orderkey from orders where o_orderdate is not null),
 v as (select o_custkey, m - (select min(m) from o) as version, arg_max(o_orderstatus, o_orderkey) as status, count(*) as n from o group by 1, 2)"""


def _months(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderdate is not null").withColumn("m", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    start = o.agg(F.min("m")).first()[0] or 0
    return o.groupBy("o_custkey", (F.col("m") - start).alias("version")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.count("*").alias("n"))


@query(_MONTHS + """, s as (select *, case when version - 1 = lag(version) over w and status is not distinct from lag(status) over w and n = lag(n) over w then 0 else 1 end as s from v window w as (partition by o_custkey order by version)),
 r as (select *, sum(s) over (partition by o_custkey order by version) as run from s) select o_custkey, any_value(status) as status, any_value(n) as n, min(version) as first, max(version) as last from r group by o_custkey, run""")
def version_spans(spark, sf):
    """Monthly snapshots of customers as intervals of equal content."""
    return history.intervals(_months(spark, sf), "o_custkey", "version", ["status", "n"])


@query(_MONTHS + " select o_custkey, status, n from v where version = 30")
def version_as_of(spark, sf):
    """One month's snapshot, read from the intervals."""
    return history.intervals(_months(spark, sf), "o_custkey", "version", ["status", "n"]).filter("first <= 30 and last >= 30").select("o_custkey", "status", "n")


_ROWS = """select left(sha1(cast(doc_id as varchar)), 20) as id, sha256(coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode({text})) || ':' || {text}, '-')) as d from documents"""


def _keyed(docs):
    return docs.withColumn("id", F.substring(F.sha1(F.col("doc_id").cast("string")), 1, 20))


@query("with r as (" + _ROWS.format(text="text") + """), n2 as (select left(id, 4) as prefix, count(*) as n, sha256(string_agg(id || '=' || d, chr(10) order by id, d)) as digest from r group by 1),
 n1 as (select left(prefix, 2) as p, sum(n) as n, sha256(string_agg(prefix || '=' || digest, chr(10) order by prefix)) as digest from n2 group by 1),
 n0 as (select sum(n) as n, sha256(string_agg(p || '=' || digest, chr(10) order by p)) as digest from n1)
select 2 as level, prefix, n, digest from n2 union all select 1, p, n, digest from n1 union all select 0, '', n, digest from n0""")
def manifest_tree(spark, sf):
    """All nodes of the manifest of the documents, in order of their content keys."""
    return merkle.tree(_keyed(table(spark, sf, "documents")), "id", ["lang", "text"], 2)


@query("with a as (" + _ROWS.format(text="text") + " where source <> 'src3'), b as (" + _ROWS.format(text="case when lang = 'es' then lower(text) else text end") + """ where source <> 'src5')
 select coalesce(a.id, b.id) as key, case when a.id is null then 'added' when b.id is null then 'lost' else 'changed' end as kind from a full join b on a.id = b.id where a.d is distinct from b.d""")
def manifest_difference(spark, sf):
    """Rows in which two states of the documents differ, found under unequal nodes."""
    d = _keyed(table(spark, sf, "documents"))
    other = d.filter("source <> 'src5'").withColumn("text", F.when(F.col("lang") == "es", F.lower("text")).otherwise(F.col("text")))
    return merkle.differing(d.filter("source <> 'src3'"), other, "id", ["lang", "text"], 2)


_PAGES = """with read as (select o_orderpriority as source, datediff('day', timestamp '1990-01-01', o_orderdate) as lo, datediff('day', timestamp '1990-01-01', o_orderdate) + o_custkey % 2 as hi from orders where o_orderstatus = 'P'),
 e as (select o_orderpriority as source, min(datediff('day', timestamp '1990-01-01', o_orderdate)) as a, max(datediff('day', timestamp '1990-01-01', o_orderdate)) as b from orders where o_orderdate is not null and o_orderpriority is not null group by 1),
 p as (select source, unnest(range(a, b + 1)) as page from e), c as (select distinct source, unnest(range(lo, hi + 1)) as page from read), m as (select * from p except select * from c),
 g as (select source, page, page - row_number() over (partition by source order by page) as island from m), gaps as (select source, min(page) as lo, max(page) as hi from g group by source, island)"""


def _read(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderdate is not null and o_orderpriority is not null").withColumn("day", F.datediff("o_orderdate", F.lit("1990-01-01")).cast("long"))
    read = o.filter("o_orderstatus = 'P'").select(F.col("o_orderpriority").alias("source"), F.col("day").alias("lo"), (F.col("day") + F.col("o_custkey") % 2).alias("hi"))
    return read, o.groupBy(F.col("o_orderpriority").alias("source")).agg(F.min("day").alias("lo"), F.max("day").alias("hi")), o


@query(_PAGES + " select source, lo, hi from gaps")
def cover_gaps(spark, sf):
    """Days of the whole span of each priority that no partial order reaches."""
    read, wanted, _ = _read(spark, sf)
    return cover.gaps(read, wanted, "source")


@query(_PAGES + """, f as (select o_orderpriority as source, count(*) as failed from orders where o_totalprice > 490000 group by 1)
 select e.source, coalesce(n, 0) as gaps, coalesce(missing, 0) as missing, coalesce(failed, 0) as failed, coalesce(n, 0) = 0 and coalesce(failed, 0) = 0 as scan_complete
 from e left join (select source, count(*) as n, cast(sum(hi - lo + 1) as bigint) as missing from gaps group by source) as g using (source) left join f using (source)""")
def proven_discovery(spark, sf):
    """Whether the read days of each priority prove that nothing was left out."""
    read, wanted, o = _read(spark, sf)
    return cover.proven(read, wanted, "source", o.filter("o_totalprice > 490000").select(F.col("o_orderpriority").alias("source")))
