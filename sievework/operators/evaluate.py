"""Evaluation of extractors and raters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import stats as S

POSITIVE = ("buy", "add", "bullish", "hold")


def polarity(stance: Column) -> Column:
    return F.when(stance.isin(*POSITIVE), "pos").otherwise("neg")


def precision_recall(gold: DataFrame, found: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """True and false positives and misses of two sets of ``keys``, and their ratios, by ``by`` (part of the keys)."""
    g, f = gold.select(*keys).distinct().withColumn("_g", F.lit(True)), found.select(*keys).distinct().withColumn("_f", F.lit(True))
    both = g.join(f, keys, "full")
    tp, fp, fn = (F.count_if(c) for c in (F.col("_g").isNotNull() & F.col("_f").isNotNull(), F.col("_g").isNull(), F.col("_f").isNull()))
    out = both.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    return out.withColumns({"precision": S.ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": S.ratio(F.col("tp"), F.col("tp") + F.col("fn"))})


def error_class(gold: Column, found: Column) -> Column:
    return (
        F.when(gold.isNull() & found.isNull(), "both_silent").when(found.isNull(), "missed").when(gold.isNull(), "invented")
        .when(gold == found, "right").when(polarity(gold) == polarity(found), "wrong_stance").otherwise("wrong_direction")
    )


def kappa_multi(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa over any number of categories; 1 where chance agreement is certain. Marginals are summed by
    category, so no pair of categories is formed."""
    n = pairs.agg(F.count("*").alias("n"), F.count_if(F.col(a) == F.col(b)).alias("same"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col(a).alias("c"), F.lit(1).alias("x"), F.lit(0).alias("y")), F.struct(F.col(b).alias("c"), F.lit(0).alias("x"), F.lit(1).alias("y")))).alias("s"))
    marginal = sides.groupBy("s.c").agg((F.sum("s.x") * F.sum("s.y")).alias("xy")).agg(F.sum("xy").alias("xy"))
    observed, expected = F.col("same") / F.col("n"), F.col("xy") / (F.col("n") * F.col("n"))
    return n.join(marginal, F.lit(True)).select("n", F.round(observed, 3).alias("observed"), S.kappa(observed, expected, certain=1.0).alias("kappa"))


def kappa_binary(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two boolean ratings; null where chance agreement is certain."""
    x, y = F.avg(F.col(a).cast("double")), F.avg(F.col(b).cast("double"))
    g = pairs.agg(F.count("*").alias("n"), F.avg((F.col(a) == F.col(b)).cast("double")).alias("o"), x.alias("x"), y.alias("y"))
    e = F.col("x") * F.col("y") + (1 - F.col("x")) * (1 - F.col("y"))
    return g.select("n", F.round("o", 3).alias("observed"), S.kappa(F.col("o"), e).alias("kappa"))


def agreement(left: DataFrame, right: DataFrame, keys: list[str], stance: str) -> DataFrame:
    """Per key: who has it, and whether the sides share a polarity."""
    side = lambda d, n: d.groupBy(*keys).agg(F.collect_set(polarity(F.col(stance))).alias(n))
    j = side(left, "_l").join(side(right, "_r"), keys, "full")
    held = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return j.select(*keys, held.alias("held"), F.coalesce(F.arrays_overlap("_l", "_r"), F.lit(False)).alias("agree"))


def weighted_share(rows: DataFrame, population: DataFrame, stratum: str, condition: Column) -> DataFrame:
    """Share of a condition over strata, weighted by their population."""
    s = rows.groupBy(stratum).agg(F.avg(condition.cast("double")).alias("share"))
    return s.join(population, stratum).agg(F.round(F.sum(F.col("n") * F.col("share")) / F.sum("n"), 3).alias("share"), F.sum("n").alias("population"))


def split_scores(items: DataFrame, gold: DataFrame, found: DataFrame) -> DataFrame:
    """Per split: items, those left out (ambiguous, unavailable), traceability, and the sets' precision, recall, coverage
    and abstention over what is left. ``items`` has item, split, ambiguous and available; the others item, symbol, stance."""
    usable = items.filter(~F.col("ambiguous") & F.col("available")).select("item", "split")
    n = items.groupBy("split").agg(F.count("*").alias("items"), F.count_if("ambiguous").alias("ambiguous"), F.count_if(~F.col("ambiguous") & ~F.col("available")).alias("unavailable"))
    keys = ["item", "symbol", "stance"]
    g, f = gold.select(*keys).distinct().withColumn("_g", F.lit(1)), found.select(*keys).distinct().withColumn("_f", F.lit(1))
    per = usable.join(g.join(f, keys, "full"), "item", "left").groupBy("split", "item").agg(
        F.count_if(F.col("_g").isNotNull() & F.col("_f").isNotNull()).alias("tp"), F.count_if(F.col("_g").isNull() & F.col("_f").isNotNull()).alias("fp"), F.count_if(F.col("_g").isNotNull() & F.col("_f").isNull()).alias("fn"))
    silent = F.col("tp") + F.col("fp") == 0
    sums = per.groupBy("split").agg(F.count("*").alias("scored"), *(F.sum(c).alias(c) for c in ("tp", "fp", "fn")), F.count_if(silent).alias("abstained"), F.count_if(silent & (F.col("fn") == 0)).alias("abstained_rightly"))
    tp, fp, fn = (F.coalesce(c, F.lit(0)) for c in ("tp", "fp", "fn"))
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return n.join(sums, "split", "left").select(
        "split", "items", "ambiguous", "unavailable", z("scored"), z("tp"), z("fp"), z("fn"), z("abstained"), z("abstained_rightly"),
        S.ratio(F.coalesce("scored", F.lit(0)), F.col("items") - F.col("ambiguous")).alias("traceability"), S.ratio(tp, tp + fp).alias("precision"),
        S.ratio(tp, tp + fn).alias("recall"), S.ratio(tp + fp, tp + fn).alias("coverage"), S.ratio(F.col("abstained"), F.col("scored")).alias("abstain_rate"))


def by_gate(gold: DataFrame, found: DataFrame, keys: list[str], gate: str) -> DataFrame:
    """Right and wrong claims of each gate."""
    g = gold.select(*keys).distinct().withColumn("_g", F.lit(1))
    return found.filter(F.col(gate).isNotNull()).join(g, keys, "left").groupBy(gate).agg(F.count_if(F.col("_g").isNotNull()).alias("correct"), F.count_if(F.col("_g").isNull()).alias("wrong"))


def union(*found: DataFrame) -> DataFrame:
    """The claims of several extractors as one set."""
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def kappa_by(pairs: DataFrame, a: str, b: str, by: str) -> DataFrame:
    """Binary kappa of each group; null where chance agreement is certain."""
    x, y = F.avg(F.col(a).cast("double")), F.avg(F.col(b).cast("double"))
    g = pairs.groupBy(by).agg(F.count("*").alias("n"), F.avg((F.col(a) == F.col(b)).cast("double")).alias("o"), x.alias("x"), y.alias("y"))
    e = F.col("x") * F.col("y") + (1 - F.col("x")) * (1 - F.col("y"))
    return g.select(by, "n", F.round("o", 3).alias("observed"), S.kappa(F.col("o"), e).alias("kappa"))


def channels(rows: DataFrame, **conditions: Column) -> DataFrame:
    """Each row once for each channel it is part of; channels may overlap."""
    return rows.withColumn("channel", F.explode(F.array_compact(F.array(*(F.when(c, n) for n, c in conditions.items())))))


def blind_pairs(items: DataFrame, gold: DataFrame, answers: DataFrame) -> DataFrame:
    """(item, symbol, gold, answer, skipped): decisions side by side, ``none`` where one side has no such symbol, and one
    row of ``_none_`` where neither has any. Items that a side can't judge are one row with the reason."""
    reason = F.when(F.col("status").isin("unavailable", "ambiguous"), F.col("status")).when(F.col("ambiguous"), "gold_ambiguous")
    judged = items.withColumn("skipped", reason)
    g, a = gold.select("item", "symbol", F.col("stance").alias("gold")), answers.select("item", "symbol", F.col("stance").alias("answer"))
    both = judged.filter("skipped is null").select("item").join(g.join(a, ["item", "symbol"], "full"), "item", "left")
    rows = both.select("item", F.coalesce("symbol", F.lit("_none_")).alias("symbol"), F.coalesce("gold", F.lit("none")).alias("gold"), F.coalesce("answer", F.lit("none")).alias("answer"), F.lit(None).cast("string").alias("skipped"))
    null = F.lit(None).cast("string")
    return rows.unionByName(judged.filter("skipped is not null").select("item", null.alias("symbol"), null.alias("gold"), null.alias("answer"), "skipped"))


def adjudicated(items: DataFrame, patches: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """Items with the newest patch of ``column``; ``refused`` marks patches of items that aren't dev, which change
    nothing."""
    last = patches.groupBy(key).agg(F.max_by(column, order).alias("_new"), F.lit(True).alias("_patched"))
    j = items.join(last, key, "left")
    patched = F.coalesce("_patched", F.lit(False))
    return j.withColumns({column: F.when(patched & (F.col("split") == "dev"), F.col("_new")).otherwise(F.col(column)), "refused": patched & (F.col("split") != "dev")}).drop("_new", "_patched")


#: What stances are compared as, and the labels of errors.
COARSE = {"buy": "long", "add": "long", "sell": "reduce", "trim": "reduce", "hold": "hold", "bullish": "bullish", "bearish": "bearish", "avoid": "avoid"}
OPTION = "sell_put"
ERRORS = ("wrong_stance", "wrong_stance_option_semantics", "claim_where_none", "wrong_symbol", "stance_mismatch", "missed_symbol_not_detected", "missed_stance")


def error_classes(gold: DataFrame, found: DataFrame, detected: DataFrame) -> DataFrame:
    """(item, error) for each wrong or missed pair of an item's gold labels (item, symbol, stance, instrument) and claims
    (item, symbol, stance), stances taken coarsely. A claim is wrong in its stance if the symbol is labelled (and once
    more by option semantics if any label of the item sells a put), else without ground where the item has no label,
    else wrong in its symbol. A label that no claim meets is a mismatch if its symbol is claimed, else missed: with its
    symbol, if that isn't among those ``detected`` (item, symbol), or in its stance only."""
    stance = F.coalesce(*(F.when(F.col("stance") == k, v) for k, v in COARSE.items()), F.col("stance"))
    g = gold.select("item", "symbol", stance.alias("stance"), F.coalesce(F.col("instrument") == OPTION, F.lit(False)).alias("put")).groupBy("item", "symbol", "stance").agg(F.max("put").alias("put"), F.lit(True).alias("_g"))
    f = found.select("item", "symbol", stance.alias("stance"), F.lit(True).alias("_f")).distinct()
    keys = ["item", "symbol", "stance"]
    both = g.join(f, keys, "full").withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("_g", "_f", "put")})
    item, pair = W.partitionBy("item"), W.partitionBy("item", "symbol")
    seen = detected.select("item", "symbol", F.lit(True).alias("_d")).distinct()
    known = both.withColumns({"_gold": F.max("_g").over(item), "_put": F.max("put").over(item), "_gs": F.max("_g").over(pair), "_fs": F.max("_f").over(pair)}).join(seen, ["item", "symbol"], "left")
    claim = F.when(F.col("_gs") & F.col("_put"), F.array(F.lit(ERRORS[0]), F.lit(ERRORS[1]))).when(F.col("_gs"), F.array(F.lit(ERRORS[0]))).when(~F.col("_gold"), F.array(F.lit(ERRORS[2]))).otherwise(F.array(F.lit(ERRORS[3])))
    label = F.when(F.col("_fs"), ERRORS[4]).when(F.col("_d").isNull(), ERRORS[5]).otherwise(ERRORS[6])
    return known.filter(F.col("_g") != F.col("_f")).select("item", F.explode(F.when(F.col("_f"), claim).otherwise(F.array(label))).alias("error"))
