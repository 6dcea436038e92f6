"""The numbered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, decontam, hpylm, jaccard, lines, manifest, pii, quality, secrets, suffix, template, variants, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and spans removed from every document, a digest of what is kept, the share removed and the text kept."""
    found = suffix.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                        (F.col("n_removed") / F.greatest("n_bytes", F.lit(1))).alias("removed_share"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""
    found = bpe.tokenize(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return found.select("doc_id", *(c.alias(k) for k, c in bpe.digests(F.col("ids"), F.col("decoded")).items()))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, and all spans."""
    p = F.col("parts")

    def listed(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(p, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(p, lambda s: s["order"] < len(secrets.BASE))
    found = secrets.scan(documents(spark, sf_dir))
    return found.select("doc_id", *map(count, secrets.BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(p).alias("spans"))


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and model score of every document."""
    return hpylm.score(documents(spark, sf_dir))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id and number of links of every document."""
    return jaccard.join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, visible lines, lines taken out, and a digest of the text that is left."""
    found = lines.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


_ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ID = secrets.ID.replace("'", "''")
SQL["op6_secret_scan"] = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
k(o, kind, p) as (values (0, 'assign', '{_ASSIGN}'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'),
  (3, 'linked_secret', '[A-Za-z0-9/+=]+'), (4, 'linked_endpoint', 'https?://[^\x20\x09-\x0D"''<>]+'), (5, 'linked_id', '{_ID}')),
a as (select r, o, kind, p, regexp_extract_all(t, p) as m, string_split(regexp_replace(t, p, chr(1), 'g'), chr(1)) as g from d, k),
u as (select r, o, kind, p, unnest(range(1, len(m) + 1)) as i, unnest(m) as m, unnest(g[1:len(m)]) as g from a),
s as (select r, o, kind, m, p, cast(sum(length(g) + length(m)) over (partition by r, o order by i) as bigint) as e from u),
h as (select r, o, kind, m, e - length(m) as b, e from s where case o when 0 then length(regexp_extract(m, p, 2)) >= 6
  when 1 then length(m) >= 20 when 2 then length(m) >= 24 when 3 then length(m) = 40 and not contains(m, '=') when 4 then length(m) > 8 else length(m) >= 8 end),
n as (select h.*, exists (from h x where x.r = h.r and x.o = 1 and (x.b <= h.b and h.b - x.e <= 400 or x.b >= h.b and x.b - h.e <= 400)) as by_access,
  exists (from h x where x.r = h.r and x.o in (0, 2, 3) and (x.b <= h.b and h.b - x.e <= 400 or x.b >= h.b and x.b - h.e <= 400)) as by_secret,
  exists (from h x where x.r = h.r and x.o = 5 and (x.b <= h.b and h.b - x.e <= 400 or x.b >= h.b and x.b - h.e <= 400)) as by_name,
  exists (from h x where x.r = h.r and x.o in (0, 2) and (x.b <= h.b and h.b - x.e <= 400 or x.b >= h.b and x.b - h.e <= 400)) as by_firm,
  exists (from h x where x.r = h.r and (x.o in (0, 2) and x.b <= h.b and x.e >= h.e or x.o = 2 and x.b = h.b)) as known from h),
f as (select * from n where o < 3 or o = 3 and by_access and not known or o = 4 and (by_access and by_secret or by_name and by_firm) or o = 5 and by_firm)
select d.doc_id, count(*) filter (o = 0) as n_assign, count(*) filter (o = 1) as n_access, count(*) filter (o = 2) as n_hex,
  sha256(coalesce(string_agg(kind || ':' || b || ':' || e, ',' order by b, o) filter (o < 3), '')) as base_sha256,
  coalesce(string_agg(kind || ':' || b || ':' || e, ',' order by b, o) filter (o >= 0), '') as spans
from d left join f on f.r = d.r group by d.r, d.doc_id
"""


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of ``pages`` give back, one row per page."""
    chunks = warc.round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return chunks.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    return quality.score(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_STOP = ", ".join(f"'{w}'" for w in quality.CASED)
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL["op8_quality_rules"] = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS} as w from documents),
l as (select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines,
        sum(cast(rtrim(x, ' ') like '%...' or rtrim(x, ' ') like '%…' as int)) as n_ell
      from (select r, unnest(string_split(t, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]') group by r),
g as (select r, i, row(w[i], w[i + 1], w[i + 2]) as g from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) > 2)),
c as (select r, i, count(*) over (partition by r, g) as n from g),
p as (select r, count(distinct i + k) as n_rep from c, (values (0), (1), (2)) as s(k) where n > 1 group by r),
f as (select d.r, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(regexp_extract_all(t, '\p{{Lu}}')) as n_cap,
        len(list_filter(w, lambda x: x in ({_STOP}))) as n_stop, len(list_filter(w, lambda x: ends_with(x, '!!'))) as n_shout,
        coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_ell, 0) as n_ell, coalesce(n_rep, 0) as n_repeat_words
      from d left join l on l.r = d.r left join p on p.r = d.r),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and word_chars >= 2 * n_words and word_chars <= 20 * n_words and n_symbols <= 0.1 * n_words
  and n_stop >= 0.02 * n_words and n_dup_lines <= 0.5 * n_lines and n_shout <= 0.3 * n_words and n_cap <= 0.5 * word_chars
  and n_ell <= 0.5 * n_lines as kept
from b
"""


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the number of pseudonyms by kind, and the text with pseudonyms."""
    found = pii.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)
    return found.select("doc_id", *(F.col(f"n_{k}") for k in pii.KINDS), F.sha2("text", 256).alias("text_sha256"), "text")


#: A real run passes a key of its own, from a secret store.
PII_KEY = "key for tests"


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and item_id of each benchmark item found in a document, with the exact containment."""
    found = decontam.contained(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", F.round("containment", 6).alias("containment"))


SQL["op10_decontamination"] = r"""
with w as (select distinct doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from documents),
d as (select row_number() over () as r, doc_id, w from w),
b as (select distinct item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from benchmark),
i as (select item_id, w, least(len(w), 5) as k from b where len(w) > 0),
s as (select distinct item_id, w, k, array_to_string(w[p:p + k - 1], ' ') as g from (select *, unnest(range(1, len(w) - k + 2)) as p from i)),
n as (select *, count(*) over (partition by item_id, w) as n_item from s),
e as (select distinct r, doc_id, k, array_to_string(w[p:p + k - 1], ' ') as g
  from (select r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, (select distinct k from i))),
c as (select e.r, e.doc_id, n.item_id, n.w, n_item, count(*) as n_shared from e join n on e.k = n.k and e.g = n.g group by all)
select doc_id, item_id, cast(n_shared as bigint) as n_shared, cast(n_item as bigint) as n_item, round(n_shared / n_item, 6) as containment
from c where n_shared >= 0.8 * n_item
""".replace("\\\\", "\\")


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page and its length."""
    return template.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents with their form, root and counts."""
    return variants.variants(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op13_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and a digest of the siblings of each document; the root folded from its leaf, lower-cased where
    3 divides the crc32 of doc_id (a null doc_id has none); and whether that is the root."""
    docs = documents(spark, sf_dir)
    named = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = manifest.leaf(*named, F.col("text"))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    read = docs.select("doc_id", "lang", own.alias("leaf"), F.when(chosen, manifest.leaf(*named, lower)).otherwise(own).alias("now"))
    found = manifest.prove(read, "doc_id", "lang", "leaf", ["now"]).withColumn("folded_root", manifest.fold(F.col("now"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", manifest.siblings(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Unsigned crc32 of a string as DuckDB reads it: the table is computed from the polynomial.
_CRC_TABLE = "crc(t) as (select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)))"


def _crc(text: str) -> str:
    return f"xor(4294967295, list_reduce(list_transform(range(octet_length(encode({text}))), lambda i: cast(('0x' || substr(hex(encode({text})), 2 * i + 1, 2)) as bigint)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::bigint))"


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || {c}, '-')"


SQL["op13_dataset_manifest"] = f"""
with recursive {_CRC_TABLE},
d as (select row_number() over () as d, *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
  doc_id is not null and {_crc("cast(doc_id as varchar)")} % 3 = 0 as chosen from documents, crc),
l as (select d, doc_id, coalesce('=' || lang, '') as g, sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) as leaf,
  sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "case when chosen then low else text end")))}) as now from d),
r as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by g) as n from l),
nodes as (select g, 0 as v, i, n, leaf as h from r
  union all select g, v + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' order by i)) from nodes where n > 1 group by g, v, i // 8, n),
tops as (select g, h, row_number() over (order by g) - 1 as i, count(*) over () as n from nodes where n = 1),
heads as (select 0 as v, i, n, h from tops
  union all select v + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' order by i)) from heads where n > 1 group by v, i // 8, n),
every as (select g, v, i, n, h from nodes union all select null, v, i, n, h from heads),
sib as (select x.g, x.v, x.i, coalesce(string_agg(y.h, '' order by y.i) filter (y.i < x.i), '') as l, coalesce(string_agg(y.h, '' order by y.i) filter (y.i > x.i), '') as q
  from every x join every y on x.g is not distinct from y.g and x.v = y.v and x.i // 8 = y.i // 8 where x.n > 1 group by x.g, x.v, x.i),
walk as (select d, g, v, i, now as h, '' as p from (select *, 0 as v from r)
  union all select walk.d, walk.g, walk.v + 1, walk.i // 8, sha256(l || h || q), p || l || q from walk join sib on sib.g = walk.g and sib.v = walk.v and sib.i = walk.i),
sub as (select * from walk qualify row_number() over (partition by d order by v desc) = 1),
climb as (select d, 0 as v, tops.i, sub.h, p from sub join tops using (g)
  union all select climb.d, climb.v + 1, climb.i // 8, sha256(l || h || q), p || l || q from climb join sib on sib.g is null and sib.v = climb.v and sib.i = climb.i),
f as (select * from climb qualify row_number() over (partition by d order by v desc) = 1),
root as (select h as root from heads where n = 1)
select r.doc_id, leaf, tops.h as subroot, root, sha256(p) as proof_sha256, f.h as folded_root, f.h = root as verified
from r join tops using (g) join f using (d), root
"""

SQL["op12_spelling_variants"] = rf"""
with recursive {_CRC_TABLE},
w as (select coalesce(cast(doc_id as varchar), '') || ':' as k, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as w from documents),
r as (select w, count(*) as n, {_crc("k || w")} as h from (select k, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w from w where length(w) >= 7), crc group by k, w, t),
v as (select case when h % 31 = 0 then left(w, cast(h % length(w) as bigint)) || substr(w, cast(h % length(w) as bigint) + 2) else w end as word, sum(n) as n from r group by 1),
d as (select word, cast(n as bigint) as n from v where length(word) >= 7 and n >= 2),
x as (select word, n, unnest(range(length(word))) as i from d),
g as (select word, n, left(word, i) || '?' || substr(word, i + 2) as hole, left(word, i) || substr(word, i + 2) as cut from x),
p as (select a.word, b.word as other, b.n from g a join g b on a.hole = b.hole and a.word <> b.word
  union select a.word, b.word, b.n from g a join d b on a.cut = b.word union select b.word, a.word, a.n from g a join d b on a.cut = b.word),
m as (select word, count(*) as n_near, max(n) as top from p group by word),
o as (select p.word, min(other) as other from p join m on m.word = p.word and p.n = m.top group by p.word),
f as (select d.word, d.n, coalesce(n_near, 0) as n_near, case when top >= 10 * d.n then other end as form, case when top >= 10 * d.n then top end as form_n
  from d left join m on m.word = d.word left join o on o.word = d.word),
s as (select word, word as root, 0 as k from f union all select s.word, f.form, k + 1 from s join f on f.word = s.root where f.form is not null),
e as (select word, max_by(root, k) as root from s group by word)
select f.word, form, root, n, n_near, form_n from f join e on e.word = f.word
"""
