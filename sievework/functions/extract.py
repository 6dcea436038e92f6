"""Rule-based extraction. Rule tables are data and come in as arguments; lexicons belong to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T


def detect(text: Column, aliases: dict[str, str], tokens: list[str], cased: tuple[str, ...] = (), most: int = 12) -> Column:
    """Symbols named in a text: aliases first, the longest first (an ASCII alias stands alone, others are substrings),
    then listed tokens by length, then name; ``cased`` tokens count in capitals only. Distinct, ``most`` at most."""
    return T.bound(F.struct(text.alias("text"), F.lower(text).alias("low")), lambda x: _detect(x["text"], x["low"], aliases, tokens, cased, most))


def _detect(text: Column, low: Column, aliases: dict[str, str], tokens: list[str], cased: tuple[str, ...], most: int) -> Column:
    found = []
    for a in sorted(aliases, key=lambda a: (-len(a), a)):
        found.append(F.when(T.has_token(text, a, low) if a.isascii() else F.contains(text, F.lit(a)), aliases[a]))
    for t in sorted(tokens, key=lambda t: (-len(t), t)):
        alone = F.contains(text, F.lit(t)) & text.rlike(rf"(?<![A-Za-z0-9]){t}(?![A-Za-z0-9])") if t in cased else T.has_token(text, t, low)
        found.append(F.when(alone, t))
    return F.slice(F.array_distinct(F.array_compact(F.array(*found))), 1, most)


def themes(text: Column, groups: dict[str, list[str]], default: str, most: int = 8) -> Column:
    """Names of the groups any of whose words a lower-cased text holds; the default if none."""
    def hits(low: Column) -> Column:
        hit = []
        for name, words in groups.items():
            any_word = F.lit(False)
            for w in words:
                any_word = any_word | F.contains(low, F.lit(w.lower()))
            hit.append(F.when(any_word, name))
        return F.array_compact(F.array(*hit))

    return T.bound(T.bound(F.lower(text), hits), lambda got: F.slice(F.when(F.size(got) == 0, F.array(F.lit(default))).otherwise(got), 1, most))


def without_noise(units: Column, words: list[str]) -> Column:
    """(kept, units, removed, ratio): units that hold none of the words, in either case."""
    def noisy(u: Column) -> Column:
        return T.bound(F.lower(u), holding)

    def holding(low: Column) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | F.contains(low, F.lit(w))
        return out

    kept = F.filter(units, lambda u: ~noisy(u))
    n, gone = F.size(units), F.size(units) - F.size(kept)
    return F.struct(kept.alias("kept"), n.alias("units"), gone.alias("removed"), F.round(F.coalesce(F.try_divide(gone, n), F.lit(0.0)), 3).alias("ratio"))


def boilerplate(text: Column, markers: list[str], least: int, most_chars: int) -> Column:
    """A short text with ``least`` or more of the markers."""
    low = F.lower(text)
    return (sum((F.contains(low, F.lit(m)).cast("int") for m in markers), F.lit(0)) >= least) & (F.length(text) < most_chars)


def depth(chars: Column, full: int = 1000) -> Column:
    return F.when(chars >= full, "full_text").when(chars > 0, "excerpt").otherwise("title_only")


def first_cue(sentence: Column, cues: list[tuple[str, str]]) -> Column:
    """The label of the first rule, in order, that matches; null if none does."""
    out = F.when(sentence.rlike(cues[0][0]), cues[0][1])
    for pattern, label in cues[1:]:
        out = out.when(sentence.rlike(pattern), label)
    return out


def claims(units: Column, symbols, cues: list[tuple[str, str]], skip: str | None = None, unless: str | None = None, conditional: str = "(?iu)\\bif\\b|如果", question: str = "[?？]", most: int = 20) -> Column:
    """Claims of the sentences of a text: each symbol of a sentence with the sentence's first stance cue. ``symbols``
    maps a sentence to its symbols. Sentences that match ``skip`` and not ``unless`` (other people's views) abstain.
    Distinct by symbol, stance and sentence; no wording is kept, only its hash."""
    def of(s: Column) -> Column:
        stance = first_cue(s, cues)
        speaks = F.lit(True) if skip is None else ~s.rlike(skip) | (s.rlike(unless) if unless else F.lit(False))
        made = F.transform(symbols(s), lambda x: F.struct(
            x.alias("symbol"), stance.alias("stance"), s.rlike(conditional).alias("conditional"), s.rlike(question).alias("question"),
            F.sha2(s, 256).alias("evidence_sha256"), F.length(s).alias("evidence_chars")))
        return F.filter(made, lambda c: c["stance"].isNotNull() & speaks)

    return F.slice(F.array_distinct(F.flatten(F.transform(units, of))), 1, most)


#: Stances that can be scored later.
CHECKABLE = ("buy", "add", "sell", "trim", "avoid", "bullish", "bearish", "hold")


def checkable(claim: Column) -> Column:
    """A claim that can be scored later: no question, and a stance that has a direction. An unknown question is none."""
    return ~F.coalesce(claim["question"], F.lit(False)) & F.coalesce(claim["stance"].isin(*CHECKABLE), F.lit(False))


def title_only(excerpt: Column, chars: Column) -> Column:
    """Whether a record has nothing but its title: a blank excerpt, and no characters of content."""
    return (T.ustrip(F.coalesce(excerpt, F.lit(""))) == "") & (F.coalesce(chars, F.lit(0)) == 0)


#: Passages that go to all tasks; more meet the texts in a shuffle.
MOST_SENT = 200_000


def without_passages(docs: DataFrame, passages: DataFrame, key: str, text: str, words: int = 3, most_sent: int = MOST_SENT, block: int = 1000) -> DataFrame:
    """Rows whose text holds none of the passages, rows without a key too. The inner words of a passage are whole words
    of any text that holds it, so a passage is looked up by the hash of its first ``words`` inner words, or of all if it
    has fewer, and only then compared whole, while the text is at hand. Passages of one or two words have no inner word
    and are compared with each text, ``block`` of them at a time."""
    split = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    p = passages.select(F.col("text").alias("passage")).filter("passage <> ''").distinct().withColumn("w", split(F.col("passage")))
    inner = F.least(F.size("w") - 2, F.lit(words))
    known = p.filter(F.size("w") > 2).select("passage", inner.alias("n"), F.xxhash64(inner, F.array_join(F.slice("w", F.lit(2), inner), " ")).alias("_s"))
    sizes = {r["n"]: r["count"] for r in known.groupBy("n").count().collect()}  # at most ``words`` rows
    own = F.xxhash64(F.col(key), F.col(text)), F.xxhash64(F.col(text), F.col(key), F.lit(1))
    d = docs.select(*(h.alias(f"_k{i}") for i, h in enumerate(own)), F.col(text).alias("_text"))

    def window(n: int) -> Column:
        return F.transform(F.slice("w", 1, F.greatest(F.size("w") - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(F.lit(n), F.concat_ws(" ", x, *(F.get("w", i + j) for j in range(1, n)))))

    hits = d.limit(0).select("_k0", "_k1")
    if sizes:
        looked = d.withColumn("w", F.when(F.monotonically_increasing_id() >= 0, split(F.col("_text")))).withColumn("_s", F.explode(F.array_distinct(F.concat(*map(window, sizes)))))
        if sum(sizes.values()) <= most_sent:
            found = looked.join(F.broadcast(known), "_s")
        else:
            found = looked.select("_k0", "_k1", "_s").join(known, "_s").select("_k0", "_k1", "passage").distinct().join(d, ["_k0", "_k1"])
        hits = found.filter(F.contains("_text", "passage")).select("_k0", "_k1")
    held = []
    for r in p.filter(F.size("w") <= 2).select("passage").toLocalIterator():
        held.append(r["passage"])
        if len(held) == block:
            hits, held = hits.union(_holding(d, held)), []
    gone = (hits.union(_holding(d, held)) if held else hits).distinct()
    return docs.join(gone, (own[0] == F.col("_k0")) & (own[1] == F.col("_k1")), "left_anti")


def _holding(d: DataFrame, passages: list[str]) -> DataFrame:
    return d.filter(F.exists(F.array(*map(F.lit, passages)), lambda x: F.contains("_text", x))).select("_k0", "_k1")
