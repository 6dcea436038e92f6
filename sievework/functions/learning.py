"""Structured learning from texts: operations with their attribution, rules, lessons, method signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import extract as X
from sievework.functions import rules as R
from sievework.functions import text as T
from sievework.functions.claims import matches


def units(text: Column, long: int = 260) -> Column:
    """Lines without blank ones; a line of more than ``long`` characters is split behind its sentence ends."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), T.ustrip), lambda x: x != "")
    cut = lambda x: F.filter(F.transform(F.split(x, "(?<=[。！？；])"), T.ustrip), lambda s: s != "")
    return F.flatten(F.transform(lines, lambda x: F.when(F.length(x) <= long, F.array(x)).otherwise(cut(x))))


def without_promotion(text: Column) -> Column:
    """(kept, units, removed, ratio) of the units of a text under the words of advertising."""
    return X.without_noise(units(text), [w.lower() for w in R.PROMOTION])


def attribution(title: Column, unit: Column, context: Column) -> Column:
    """Struct of who acts, and how sure that is."""
    named = F.lit(False)
    for name in R.THIRD_NAMES:
        named = named | F.contains(F.lower(F.concat_ws(" ", title, unit)), F.lit(name.lower()))
    first, plan = matches(context, R.FIRST_PERSON, cased=True), matches(context, R.PLAN, cased=True)
    pair = lambda a, b: F.struct(F.lit(a).alias("who"), F.lit(b).alias("confidence"))
    return (
        F.when(first & plan, pair("author_plan", "high")).when(first, pair("author_action", "high")).when(named, pair("third_party_example", "high"))
        .when(plan, pair("author_plan", "medium")).otherwise(pair("unconfirmed_author_context", "needs_review"))
    )


def _labels(text: Column, table) -> Column:
    return F.array_compact(F.array(*(F.when(matches(text, p), label) for label, p in table)))


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return T.null_if_empty(F.regexp_extract(text, "(?iuU)" + pattern, group)).cast("double")


def operations(text: Column, most: int = 20) -> Column:
    """Operations of the units that name a symbol and an action or a level. The context of a unit is the unit and the
    three before it."""
    return T.bound(units(text), lambda u: _operations(u, most))


def _operations(u: Column, most: int) -> Column:
    def of(unit: Column, i: Column) -> Column:
        context = F.array_join(F.slice(u, F.greatest(i - 2, F.lit(1)), F.least(i + 1, F.lit(4))), " ")
        who = attribution(F.get(u, F.lit(0)), unit, context)
        target = F.array(_number(unit, R.OP_TARGET, 1), _number(unit, R.OP_TARGET, 2))
        named = X.detect(unit, R.ALIASES, R.TICKERS, R.CAPITALS_ONLY)
        acts = _labels(unit, R.OP_ACTIONS)
        levels = matches(unit, R.OP_TARGET)
        for p in R.OP_FIELDS.values():
            levels = levels | matches(unit, p)
        made = F.struct(
            named.alias("symbols"), *(_number(unit, p).alias(k) for k, p in R.OP_FIELDS.items()), F.when(matches(unit, R.OP_TARGET), target).alias("target_range"),
            acts.alias("actions"), _labels(unit, R.OP_CONDITIONS).alias("conditions"), who["who"].alias("attribution"), who["confidence"].alias("attribution_confidence"))
        return F.when((F.size(named) > 0) & ((F.size(acts) > 0) | levels), made)

    return F.slice(F.array_distinct(F.array_compact(F.transform(u, of))), 1, most)


def portfolio_rules(text: Column, most: int = 12) -> Column:
    return F.slice(F.array_distinct(F.flatten(F.transform(units(text), lambda u: _labels(u, R.PORTFOLIO_RULES)))), 1, most)


def lessons(text: Column, most: int = 12) -> Column:
    return F.slice(F.array_distinct(F.flatten(F.transform(units(text), lambda u: _labels(u, R.LESSONS)))), 1, most)


def signals(text: Column, most: int = 12) -> Column:
    """Method signals: the first place of each condition, over a unit and its neighbours, with a short excerpt and its
    hash; the document's state goes with each."""
    return T.bound(units(text), lambda u: _signals(u, most))


def _signals(u: Column, most: int) -> Column:
    contexts = F.transform(u, lambda _, i: F.array_join(F.slice(u, F.greatest(i, F.lit(1)), F.when(i == 0, 2).otherwise(3)), " "))
    return T.bound(F.struct(contexts.alias("c"), F.lower(F.array_join(u, " ")).alias("w")), lambda x: _first_places(x["c"], x["w"], most))


def _first_places(contexts: Column, whole: Column, most: int) -> Column:
    state = F.coalesce(*(F.when(matches(whole, p), label) for label, p in R.STATES), F.lit(None))

    def found(placed: Column) -> Column:
        each = [T.bound(F.get(F.filter(placed, _holds(name, pattern)), F.lit(0)), _signal(place, name, ready, state)) for place, (name, pattern, ready) in enumerate(R.SIGNALS)]
        return F.slice(F.sort_array(F.array_compact(F.array(*each))), 1, most)

    return T.bound(F.transform(contexts, lambda c, i: F.struct(i.alias("i"), c.alias("c"), F.lower(c).alias("low"))), found)


def _signal(place: int, name: str, ready: bool, state: Column):
    def made(first: Column) -> Column:
        excerpt = F.substring(T.squeeze(first["c"]), 1, 180)
        return F.when(first.isNotNull(), F.struct(
            first["i"].alias("unit"), F.lit(place).alias("place"), F.lit(name).alias("condition_id"), F.lit(ready).alias("machine_ready"), excerpt.alias("evidence_excerpt"), F.sha2(excerpt, 256).alias("evidence_hash"), state.alias("state_hint")))

    return made


#: Words of which a text that fulfils a condition holds one from each list: they spare the search for what can't be there.
NEEDED = {
    "tcds_cross_zero": (("tcds",),), "ppo_above_signal": (("ppo",),), "ppo_hist_positive": (("histogram", "柱状图", "柱线"),), "price_above_ma50": (("ma",), ("50",), ("站上", "突破", "高于", "above")),
    "price_below_ma50": (("ma",), ("50",), ("跌破", "低于", "below")), "ma50_hold_two_sessions": (("ma",), ("50",), ("连续",)), "supertrend_bullish": (("supertrend",),), "macd_hist_positive": (("macd",),),
}


def _holds(name: str, pattern: str):
    def held(x: Column) -> Column:
        low, all_of = x["low"], F.lit(True)
        for words in NEEDED[name]:
            any_of = F.lit(False)
            for word in words:
                any_of = any_of | F.contains(low, F.lit(word))
            all_of = all_of & any_of
        return all_of & matches(low, pattern)

    return held


def themes(text: Column) -> Column:
    return X.themes(F.coalesce(text, F.lit("")), R.THEMES, R.OTHER_THEME)
