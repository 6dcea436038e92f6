"""Claim and action extraction from Chinese and English sentences; a version is a row of tables and switches.

Patterns run under Unicode rules. Everything is an expression over one text column, so a scan stays a scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.functions import rules as R
from sievework.functions import text as T


@dataclass(frozen=True)
class Version:
    name: str
    extra: tuple = ()  # cue tables that are asked before the stances of version 4, the newest first
    tickers: tuple[str, ...] = R.CLAIM_TICKERS
    conditional: str = R.CONDITIONAL
    own_voice: str = R.OWN_VOICE_4
    abstain: tuple[str, ...] = (R.THIRD_PARTY,)  # matched without the writer's own voice: no claim
    carry: bool = False  # a post's only symbol also serves sentences that name none
    short: bool = False  # a text too short for a sentence is one


V4 = Version("ce-4")
V6 = Version("ce-6", (R.STANCE_6,), R.CLAIM_TICKERS + R.CLAIM_TICKERS_6, R.CONDITIONAL_6, R.OWN_VOICE, (R.THIRD_PARTY, R.HISTORICAL), True)
V7 = Version("ce-7", (R.STANCE_7, R.STANCE_6), R.CLAIM_TICKERS + R.CLAIM_TICKERS_6 + R.CLAIM_TICKERS_7, R.CONDITIONAL_6, R.OWN_VOICE, (R.THIRD_PARTY, R.HISTORICAL, "(?i)" + R.IF_YOU), True, True)


def matches(text: Column, pattern: str, cased: bool = False) -> Column:
    return text.rlike(("(?U)" if cased else "(?iuU)") + pattern)


def sentences(text: Column) -> Column:
    """Squeezed sentences of six characters or more, longer ones in chunks of at most 160 cut at the last comma or
    space behind the 40th character."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[。！？!?；;])|(?<=\.)\s+|\n+"), T.squeeze)

    def pieces(s: Column) -> Column:
        def cut(a: Column, _: Column) -> Column:
            rest = a["rest"]
            at = F.length(F.regexp_extract(F.substring(rest, 1, 160), r"(?s)^(.*)[，, ]", 1))
            n = F.when(at > 40, at).otherwise(160)
            more = F.struct(F.concat(a["out"], F.array(T.ustrip(F.substring(rest, F.lit(1), n)))).alias("out"), F.regexp_replace(F.substring(rest, n + 1, F.length(rest)), "^[ ，,]+|[ ，,]+$", "").alias("rest"))
            return F.when(F.length(rest) > 160, more).otherwise(a)

        start = F.struct(F.array().cast("array<string>").alias("out"), s.alias("rest"))
        turns = F.sequence(F.lit(0), F.floor(F.length(s) / 41).cast("int"))
        return F.aggregate(turns, start, cut, lambda a: F.concat(a["out"], F.when(F.length(a["rest"]) >= 6, F.array(a["rest"])).otherwise(F.array().cast("array<string>"))))

    return F.flatten(F.transform(parts, lambda s: F.when(F.length(s) > 160, pieces(s)).when(F.length(s) >= 6, F.array(s)).otherwise(F.array().cast("array<string>"))))


def symbols(s: Column, tickers: tuple[str, ...] = R.CLAIM_TICKERS) -> Column:
    listed = X.detect(s, R.ALIASES, R.TICKERS, R.CAPITALS_ONLY)
    listed = F.filter(listed, lambda x: (x != "BE") | s.rlike("(?<![A-Za-z])BE(?![A-Za-z])"))
    more = [F.when(F.contains(s, F.lit(k)), v) for k, v in R.CLAIM_ALIASES.items()]
    more += [F.when(F.contains(s, F.lit(t)) & s.rlike(rf"(?<![A-Za-z0-9]){t}(?![A-Za-z0-9])"), t) for t in tickers]
    return F.array_distinct(F.concat(listed, F.array_compact(F.array(*more))))


def _cues(s: Column, table) -> Column:
    return F.array_compact(F.array(*(F.when(matches(s, p), label) for label, p in table)))


def stances(s: Column, version: Version) -> Column:
    """Labels of the cues that match, the newest table's first."""
    low = F.lower(s)
    base = _cues(low, R.STANCE)
    for table in reversed(version.extra):
        own = _cues(s if table is R.STANCE_7 else low, table)
        if table is R.STANCE_6:
            clash, gone = F.array_contains(own, "bearish"), ("buy", "add")
        else:
            clash, gone = F.array_contains(own, "bullish") & matches(low, "put|葡萄"), ("sell", "trim")
        base = F.array_distinct(F.concat(own, F.filter(base, lambda x: ~(clash & x.isin(*gone)))))
    return base


def _is_question(s: Column) -> Column:
    return T.ustrip(s).rlike("[?？吗]$")


def claims(text: Column, version: Version = V4, context: Column | None = None, limit: int = 30, carry_chars: int = 600) -> Column:
    """Array of claims: symbol, stance, stance_cues, horizon, conditional, question, price, ticker_source,
    evidence_sha256, evidence_chars. ``context`` is the text that a reply answers; its only symbol serves a reply
    without any."""
    units = sentences(text)
    whole = T.squeeze(F.coalesce(text, F.lit("")))
    if version.short:
        units = F.when((F.size(units) == 0) & (whole != ""), F.array(whole)).otherwise(units)
    none = F.array().cast("array<string>")

    def carried(said: Column) -> Column:
        """The symbols that sentences without any take over."""
        if not version.carry:
            return none
        post = F.array_distinct(F.flatten(F.transform(said, lambda u: u["own"])))
        out = F.when((F.size(post) == 1) & (F.length(F.coalesce(text, F.lit(""))) <= carry_chars), post)
        if context is not None and version.short:
            around = symbols(F.coalesce(context, F.lit("")), version.tickers)
            out = out.when((F.size(post) == 0) & (F.size(around) == 1), around)
        return out.otherwise(none)

    said = T.bound(units, lambda us: F.transform(us, lambda s: F.struct(s.alias("s"), symbols(s, version.tickers).alias("own"))))
    return T.bound(said, lambda x: T.bound(carried(x), lambda c: F.slice(F.array_distinct(F.flatten(F.transform(x, lambda u: _claimed(u, c, version)))), 1, limit)))


def _claimed(u: Column, carried: Column, version: Version) -> Column:
    """The claims of one sentence."""
    own = F.size(u["own"]) > 0
    named = F.when(own, u["own"]).otherwise(carried)
    # stance rules are looked at only where there is a symbol to take them
    cue = F.when(F.size(named) > 0, stances(u["s"], version)).otherwise(F.array().cast("array<string>"))
    return T.bound(cue, lambda c: _with_cue(u["s"], own, named, c, version))


def _with_cue(s: Column, own: Column, named: Column, cue: Column, version: Version) -> Column:
    low = F.lower(s)
    silent = F.lit(False)
    for p in version.abstain:
        silent = silent | matches(s, p, cased=True)
    speaks = ~silent | matches(s, version.own_voice, cased=True)
    horizon = F.coalesce(*(F.when(matches(low, p), label) for label, p in R.HORIZON))
    made = F.transform(named, lambda x: F.struct(
        x.alias("symbol"), F.get(cue, F.lit(0)).alias("stance"), F.slice(cue, 1, 3).alias("stance_cues"), horizon.alias("horizon"), matches(low, version.conditional).alias("conditional"),
        _is_question(s).alias("question"), T.null_if_empty(F.regexp_extract(s, "(?iuU)" + R.PRICE, 1)).cast("double").alias("price"), F.when(own, "text").otherwise("context").alias("ticker_source"),
        F.sha2(s, 256).alias("evidence_sha256"), F.length(s).alias("evidence_chars"), s.alias("_s")))
    return F.when((F.size(cue) > 0) & speaks, made).otherwise(F.filter(made, lambda _: F.lit(False)))


def without_text(found: Column) -> Column:
    """Claims without their sentence: what may be stored."""
    return F.transform(found, lambda c: c.dropFields("_s"))


def _located(text: Column, width: int) -> Column:
    """Each sentence with its number, symbols, whether it holds a stance cue, its hash, and ``width`` characters around the
    first name or ticker of its symbols."""

    def of(s: Column, i: Column) -> Column:
        return T.bound(symbols(s), lambda syms: placed(s, i, syms))

    def placed(s: Column, i: Column, syms: Column) -> Column:
        names = F.array_compact(F.array(*(F.when(F.array_contains(syms, v) & F.contains(s, F.lit(k)), k) for k, v in R.CLAIM_ALIASES.items())))
        places = F.filter(F.transform(F.concat(names, syms), lambda k: F.instr(s, k)), lambda p: p > 0)
        first = F.coalesce(F.array_min(places), F.lit(1)) - 1
        start = F.greatest(F.lit(0), F.least(first - width // 2, F.length(s) - width))
        cue = F.exists(F.array(*(matches(F.lower(s), p) for _, p in R.STANCE)), lambda x: x)
        return F.struct(i.alias("i"), syms.alias("symbols"), cue.alias("stance_cue"), F.substring(s, start + 1, F.lit(width)).alias("excerpt"), F.sha2(s, 256).alias("sha256"), F.length(s).alias("chars"))

    return F.transform(sentences(text), of)


def locators(text: Column, most: int = 25, width: int = 40) -> Column:
    """Struct of the places of sentences with a symbol or a cue, those with a symbol first, and how many there are."""
    def told(hit: Column) -> Column:
        ranked = F.concat(F.filter(hit, lambda x: F.size(x["symbols"]) > 0), F.filter(hit, lambda x: F.size(x["symbols"]) == 0))
        return F.struct(F.slice(ranked, 1, most).alias("places"), F.size(hit).cast("long").alias("total"))

    return T.bound(F.filter(_located(text, width), lambda x: (F.size(x["symbols"]) > 0) | x["stance_cue"]), told)


def review_material(text: Column, most: int = 30, most_missed: int = 5, width: int = 40) -> Column:
    """Struct of the sentences with a symbol that claim something, of those that claim nothing, and how many the latter are."""
    named = F.filter(_located(text, width), lambda x: F.size(x["symbols"]) > 0)
    missed = F.filter(named, lambda x: ~x["stance_cue"])
    return F.struct(F.slice(F.filter(named, lambda x: x["stance_cue"]), 1, most).alias("claimed"), F.slice(missed, 1, most_missed).alias("missed"), F.size(missed).cast("long").alias("missed_total"))


def high_precision(text: Column, limit: int = 30) -> Column:
    """Claims of version 4 that pass a gate, with ``status`` and ``hp_gate``: trades that the writer has made or plans
    under a condition, explicit positions, and sold puts. Sentences with several symbols and stances abstain."""
    found = F.filter(claims(text, V4, limit=1000), lambda c: ~c["question"])

    def gated(c: Column) -> Column:
        s, low = c["_s"], F.lower(c["_s"])
        voice = matches(s, R.OWN_VOICE, cased=True)
        own = voice | ~matches(s, R.OTHERS, cased=True)
        beside = F.filter(found, lambda o: o["_s"] == s)
        mixed = (F.size(F.array_distinct(F.transform(beside, lambda o: o["symbol"]))) > 1) & (F.size(F.array_distinct(F.transform(beside, lambda o: o["stance"]))) > 1)
        trade = c["stance"].isin("buy", "add", "sell", "trim")
        gate = (
            F.when(trade & own & matches(low, R.EXECUTED, cased=True) & ~c["conditional"], "first_person_executed_trade")
            .when(trade & own & matches(s, R.CONDITIONAL_PLAN, cased=True), "first_person_conditional_plan")
            .when((c["stance"] == "hold") & matches(s, R.HOLD_POSITION, cased=True) & (own | matches(s, r"(?:保持|维持)\s*\d")), "explicit_position_hold")
            .when((c["stance"] == "bullish") & matches(low, R.SELL_PUT, cased=True), "sell_put_willing_to_own")
        )
        gate = F.when(~mixed & (voice | ~matches(s, R.THIRD_PARTY, cased=True)) & ((gate == "first_person_executed_trade") | ~matches(low, R.FORECAST, cased=True)), gate)
        status = F.when(gate == "first_person_executed_trade", "executed").when(gate == "first_person_conditional_plan", "conditional").otherwise("opinion")
        return c.withField("status", status).withField("hp_gate", gate)

    return F.slice(F.filter(F.transform(found, gated), lambda c: c["hp_gate"].isNotNull()), 1, limit)


def _shares(s: Column, tracked: list[str]) -> Column:
    """(key, value) of each tracked symbol that a text gives a share in percent."""

    def share(sym: str) -> Column:
        forms = (rf"([0-9]{{1,3}}(?:\.[0-9]+)?)\s*%\s*(?:的)?(?:仓位)?\s*(?:在|于|放|是)?\s*{sym}", rf"{sym}\s*(?:仓位|总仓位|占)?\s*(?:的)?\s*([0-9]{{1,3}}(?:\.[0-9]+)?)\s*%")
        return F.coalesce(*(T.null_if_empty(F.regexp_extract(s, "(?iuU)" + p, 1)) for p in forms)).cast("double")

    return F.filter(F.array(*(F.struct(F.lit(t).alias("key"), share(t).alias("value")) for t in tracked)), lambda e: e["value"].isNotNull())


def allocation(text: Column, tracked: list[str]) -> Column:
    """Map of tracked symbols to their share in percent, empty where none is given, null for a null text."""
    return F.when(text.isNotNull(), F.map_from_entries(_shares(text, tracked)))


def actions(text: Column, tracked: list[str], limit: int = 20) -> Column:
    """Array of actions on the ``tracked`` symbols of a position holder: symbol, action_type, confidence, size_pct,
    price, allocation_pct, evidence_quote, evidence_sha256."""
    units = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[。！？!?；;\n])"), T.squeeze), lambda s: F.length(s) >= 4)
    number = lambda s, *ps: F.coalesce(*(T.null_if_empty(F.regexp_extract(s, "(?iuU)" + p, 1)) for p in ps)).cast("double")

    def of(s: Column) -> Column:
        low = F.lower(s)
        hits = F.array_compact(F.array(*(F.when(s.rlike(rf"(?i)(?<![A-Za-z]){t}(?![A-Za-z])"), t) for t in tracked)))
        done, plan, hold, moved, sell, buy = (matches(low, p, cased=True) for p in (R.ACT_EXECUTED, R.ACT_PLANNED, R.ACT_HOLD, R.ACT_REBALANCE, R.ACT_SELL, R.ACT_BUY))
        entries = _shares(s, tracked)
        side = lambda tail: F.when(sell, "SELL" + tail).otherwise("BUY" + tail)
        pair = lambda kind, sure: F.struct(kind.alias("t"), sure.alias("c"))
        is_ = F.lit
        kind = (
            F.when(done & plan & ~F.contains(s, F.lit("了")), pair(is_("UNCLEAR"), is_("low")))
            .when(moved & (F.size(hits) > 1), pair(is_("REBALANCE"), F.when(done, "high").otherwise("medium")))
            .when(hold & matches(s, R.ACT_NOT_TRIGGERED), pair(is_("HOLD"), is_("medium")))
            .when(done & (sell | buy), pair(side("_EXECUTED"), is_("high"))).when(plan & (sell | buy), pair(side("_PLANNED"), is_("high")))
            .when(hold, pair(is_("HOLD"), F.when(F.size(entries) > 0, "high").otherwise("medium"))).when(sell | buy, pair(is_("UNCLEAR"), is_("low")))
            .otherwise(pair(is_("COMMENTARY"), is_("medium")))
        )
        amounts = ~kind["t"].isin("HOLD", "COMMENTARY")
        return F.transform(hits, lambda x: F.struct(
            x.alias("symbol"), kind["t"].alias("action_type"), kind["c"].alias("confidence"), F.when(amounts, number(s, *R.ACT_SIZE)).alias("size_pct"), F.when(amounts, number(s, R.ACT_PRICE)).alias("price"),
            F.to_json(F.map_from_entries(F.when(F.size(entries) > 0, entries))).alias("allocation_pct"), F.substring(s, 1, 40).alias("evidence_quote"), F.sha2(s, 256).alias("evidence_sha256")))

    return F.slice(F.array_distinct(F.flatten(F.transform(units, of))), 1, limit)


def headline(found: Column) -> Column:
    """The action that comes first by kind, then by place: symbol and kind."""
    ranked = F.transform(found, lambda a, i: F.struct(F.array_position(F.array(*map(F.lit, R.ACT_ORDER)), a["action_type"]).alias("r"), i.alias("i"), F.concat_ws(" ", a["symbol"], a["action_type"]).alias("h")))
    return F.array_min(ranked)["h"]


def exported(records: DataFrame, flags: DataFrame, now: Column, days: int) -> DataFrame:
    """One row per distinct claim of records that were published and first seen within ``days``, with the record's data; a
    record whose flags exclude it gives none. ``records``: id, author, url, published_at, captured_at, title, excerpt;
    ``flags``: id, first_seen, provenance, exclude, one row an id. Times that can't be read keep a record out."""
    since = now - F.make_dt_interval(F.lit(days))
    when = lambda c: F.try_to_timestamp(F.regexp_replace(F.substring(c, 1, 19), "T", " "))
    seen = F.coalesce(T.null_if_empty(F.col("first_seen")), F.col("captured_at"))
    rows = records.join(flags, "id", "left").withColumn("first_seen", seen).filter((when(F.col("first_seen")) >= since) & (when(F.col("published_at")) >= since) & ~F.coalesce("exclude", F.lit(False)))
    found = high_precision(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("excerpt", F.lit(""))))
    claim = rows.withColumn("c", F.explode(found)).withColumn("instrument", F.when(F.col("c.hp_gate") == "sell_put_willing_to_own", "sell_put").otherwise("stock"))
    return claim.select(
        F.col("id").alias("record_id"), "author", "url", "published_at", "first_seen", F.coalesce("provenance", F.lit("unaudited")).alias("provenance"), "c.symbol", "c.stance", "c.status", "c.hp_gate", "instrument", "c.price",
        F.col("c.evidence_sha256").alias("sentence_sha256")).dropDuplicates(["record_id", "symbol", "stance", "sentence_sha256"])
