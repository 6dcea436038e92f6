"""Secret scans with multipart credential linking, in DataFrame operations only.

Each kind of part has one pattern whose matches never cross a line end. A text is split at a pattern's matches, so the
lengths of the gaps and matches, summed along the text, give the places; only texts that a cheap test lets through are
split. Parts then lie on one axis per document. Identifiers (access keys, and names and ids of accounts in several
forms), secrets and endpoints are joined where their intervals lie within ``scope`` code points of each other: the
nearest neighbour of each complementary kind before and after a part decides that, so the join is two running maxima
and never lists pairs. Weak candidates (a bare 40-character secret, an account's name, an endpoint) are reported only
where complementary parts co-occur; ``links`` gives each secret with its nearest identifier and endpoint.

Edge cases: a null text counts as empty; a text without parts has counts 0 and empty spans; null ids and extra columns
are allowed and repeated rows stay separate; parts at one place are ordered by start, then kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pattern and least length by kind, in the order in which kinds are listed.
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Accounts: a name or id that is assigned, a temporary access key, a key of a web service, a token of a code host, a UUID.
ID = r"""(?:[Uu][Ss][Ee][Rr](?:_?[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]_?[Ii][Dd]|[Tt][Ee][Nn][Aa][Nn][Tt]_?[Ii][Dd])["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]+|ASIA[A-Z0-9]{16}|AIza[A-Za-z0-9_-]{35}|gh[opsu]_[A-Za-z0-9]{36}|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"""
KINDS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "linked_secret": r"[A-Za-z0-9/+=]{40,}",
    "linked_endpoint": r"""https?://[^\x20\x09-\x0D"'<>]+""",
    "linked_id": ID,
}
BASE = ("assign", "access", "hex")
_ORDER = list(KINDS)


def _parts(text: Column, kind: str, wanted: Column) -> Column:
    """Array of (kind, number, gap before, match) for each match of a kind; empty where ``wanted`` is false."""
    gaps, matches = F.split(text, KINDS[kind], -1), F.regexp_extract_all(text, F.lit(KINDS[kind]), F.lit(0))
    made = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match")),
        lambda x, i: F.struct(F.lit(_ORDER.index(kind)).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["match"].alias("match")),
    )
    return F.when(wanted, made).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,match:string>>"))


def _holds(kind: Column, match: Column) -> Column:
    """Whether a match is long enough for its kind."""
    n = F.length(match)
    value = F.length(F.regexp_extract(match, ASSIGN, 2))
    return (
        F.when(kind == 0, value >= 6).when(kind == 1, n >= 20).when(kind == 2, n >= 24)
        .when(kind == 3, (n == 40) & ~F.contains(match, F.lit("="))).when(kind == 4, n > 8).otherwise(n >= 8)
    )


#: Numbers of the kinds that identify, that are secrets by themselves, and that are secrets at all.
IDS, FIRM, SECRETS = (1, 5), (0, 2), (0, 2, 3)


def linked(found: DataFrame, keys: list[str], scope: int = 400) -> DataFrame:
    """Drop weak parts without complementary parts in scope: a bare secret needs an access key, and must not be known as
    another kind; an account's name needs a secret that stands by itself; an endpoint needs an access key and any
    secret, or an account's name and a secret that stands by itself."""
    before, after = W.partitionBy(*keys).orderBy("start", "kind"), W.partitionBy(*keys).orderBy(F.desc("start"), F.desc("kind"))
    kind = F.col("kind")

    def near(*kinds: int) -> Column:
        last = F.max(F.when(kind.isin(*kinds), F.col("end"))).over(before)
        first = F.min(F.when(kind.isin(*kinds), F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(first - F.col("end") <= scope, F.lit(False))

    inside = F.max(F.when(kind.isin(*FIRM), F.col("end"))).over(before) >= F.col("end")
    same = F.coalesce(inside, F.lit(False)) | F.coalesce(F.min(F.when(kind == 2, F.col("start"))).over(after) <= F.col("start"), F.lit(False))
    seen = found.withColumns({"_access": near(1), "_secret": near(*SECRETS), "_name": near(5), "_firm": near(*FIRM), "_known": same})
    weak = {3: F.col("_access") & ~F.col("_known"), 4: F.col("_access") & F.col("_secret") | F.col("_name") & F.col("_firm"), 5: F.col("_firm")}
    keep = ~kind.isin(*weak)
    for number, holds in weak.items():
        keep = keep | (kind == number) & holds
    return seen.filter(keep).drop("_access", "_secret", "_name", "_firm", "_known")


def scan(docs: DataFrame, text: str = "text", scope: int = 400) -> DataFrame:
    """doc_id and ``parts``, an array of (start, order, kind, end) by start, then kind: one row per row of ``docs``."""
    kept, keys = _kept(docs, text, scope)
    part = F.when(F.col("kind") >= 0, F.struct("start", F.col("kind").alias("order"), F.get(F.array(*map(F.lit, _ORDER)), F.greatest("kind", F.lit(0))).alias("kind"), "end"))
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias("parts")).select("doc_id", "parts")


def links(docs: DataFrame, text: str = "text", scope: int = 400) -> DataFrame:
    """(doc_id, kind, start, end, identifier, endpoint) of each reported secret that has an identifier in scope: the nearest
    one, and the nearest endpoint in scope if there is one, as structs of kind, start and end. Of two equally near ones
    that before is taken."""
    kept, keys = _kept(docs, text, scope)
    before, after = W.partitionBy(*keys).orderBy("start", "kind"), W.partitionBy(*keys).orderBy(F.desc("start"), F.desc("kind"))
    name = F.get(F.array(*map(F.lit, _ORDER)), F.greatest("kind", F.lit(0)))

    def nearest(*kinds: int) -> Column:
        own = F.col("kind").isin(*kinds)
        last = F.max(F.when(own, F.struct("end", "start", name.alias("kind")))).over(before)
        first = F.min(F.when(own, F.struct("start", "end", name.alias("kind")))).over(after)
        gap = lambda there, d: F.when(there.isNotNull(), F.greatest(d, F.lit(0)))
        back, ahead = gap(last, F.col("start") - last["end"]), gap(first, first["start"] - F.col("end"))
        shape = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
        return F.when(F.coalesce(back <= F.least(F.coalesce(ahead, back), F.lit(scope)), F.lit(False)), shape(last)).when(ahead <= scope, shape(first))

    found = kept.withColumns({"identifier": nearest(*IDS), "endpoint": nearest(4)}).filter(F.col("kind").isin(*SECRETS) & F.col("identifier").isNotNull())
    return found.select("doc_id", name.alias("kind"), "start", "end", "identifier", "endpoint")


def _kept(docs: DataFrame, text: str, scope: int) -> tuple[DataFrame, list[str]]:
    """All parts that are reported, and for each row of ``docs`` one of kind -1, so that none falls away; and the columns
    that tell rows apart. The number of a row is made and used up within one job."""
    t, keys = F.col("t"), ["row", "doc_id"]
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t")).withColumn("row", F.monotonically_increasing_id())
    assigned, access, hexed = t.rlike(r"""(?i)(?:passw|secret|token|api_?key)[a-z]*["']?\x20*[:=]"""), F.contains(t, F.lit("AKIA")), t.rlike("[0-9a-f]{24}")
    firm = assigned | hexed
    own = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("match")))
    named = firm & t.rlike(r"""(?i)(?:user|login|client_?id|account_?id|tenant_?id)[a-z_]*["']?\x20*[:=]|ASIA|AIza|gh[opsu]_|[0-9a-f]{8}-[0-9a-f]{4}-""")
    found = F.concat(
        own, _parts(t, "assign", assigned), _parts(t, "access", access), _parts(t, "hex", hexed), _parts(t, "linked_secret", access & t.rlike("[A-Za-z0-9/+=]{40}")),
        _parts(t, "linked_endpoint", (access | named) & F.contains(t, F.lit("://"))), _parts(t, "linked_id", named))
    parts = rows.select(*keys, F.explode(found).alias("p")).select(*keys, "p.*")
    along = W.partitionBy(*keys, "kind").orderBy("i")
    placed = parts.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(along))
    placed = placed.withColumn("start", F.col("end") - F.length("match")).filter((F.col("kind") < 0) | _holds(F.col("kind"), F.col("match")))
    return linked(placed.select(*keys, "kind", "start", "end"), keys, scope), keys
