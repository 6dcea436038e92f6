"""Quality rules: a threshold table compiled into one Spark projection.

Every feature is a built-in DataFrame expression and every rule is a row of ``RULES``; ``verdict`` folds the rows into
one boolean column, so no user function runs and no row moves between tasks.

Edge cases: a null text counts as empty; a text without words has all features 0 and fails; null ids and extra
columns pass through; texts of any length are judged whole; repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Very common words of the four corpus languages.
STOP_WORDS = (
    "a an and are as at be by for from have in is it not of on or that the this to was were with "
    "das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "de del el en es la las los no para por que se su un una y "
    "au avec ce dans du est et le les pas pour qui sur une"
).split()
#: As they stand and at the start of a sentence.
CASED = STOP_WORDS + [w.capitalize() for w in STOP_WORDS]
SYMBOLS = "#*$%&|<>"
SPACE_RUN = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """Reject a document whose ``numerator / denominator`` is under ``low`` or over ``high``."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: The verdict's thresholds. Lengths are in words or code points, ratios in parts of one.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.10),
    Rule("stop_word_share", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", high=0.50),
    Rule("shouted_word_share", "n_shouted", "n_words", high=0.30),
    Rule("capital_share", "n_capitals", "word_chars", high=0.50),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", high=0.50),
)


def features(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the counted features as long columns named ``prefix`` + name.

    Words are runs without space, tab, line feed, vertical tab, form feed and carriage return. ``n_repeat_words``
    counts the words inside three-word windows that occur twice or more in the text. Windows are compared by their
    64-bit hash, within one text only.
    """
    p = f"__{prefix}q_"
    out = df.withColumn(p + "t", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    t = F.col(p + "t")
    out = out.withColumns({
        p + "w": F.filter(F.split(t, SPACE_RUN), lambda w: w != ""),
        p + "l": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    w, lines = F.col(p + "w"), F.col(p + "l")
    window = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = out.withColumn(p + "u", window).withColumn(p + "h", F.sort_array(p + "u"))
    out = out.withColumn(p + "d", F.array_distinct(F.filter(p + "h", lambda x, i: x == F.get(p + "h", i + 1))))
    u, dup = F.col(p + "u"), F.col(p + "d")
    # A text with few repeated windows looks each window up; one with many sorts its windows with their places.
    found = F.filter(F.transform(u, lambda x, i: F.when(F.array_contains(dup, x), i)), lambda i: i.isNotNull())
    placed = F.sort_array(F.transform(u, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn(p + "s", F.when(F.size(dup) > 48, placed))
    s = F.col(p + "s")
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])))
    out = out.withColumn(p + "p", F.when(F.size(dup) == 0, F.lit(None)).when(F.size(dup) <= 48, found).otherwise(F.transform(twice, lambda x: x["i"])))
    inside = F.size(F.array_distinct(F.flatten(F.transform(p + "p", lambda i: F.array(i, i + 1, i + 2)))))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(F.size(dup) > 0, inside).otherwise(0),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(CASED))),
        "n_shouted": F.size(F.filter(w, lambda x: x.endswith("!!"))),
        "n_capitals": F.regexp_count(t, F.lit(r"\p{Lu}")),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
    }
    return out.withColumns({prefix + k: v.cast("long") for k, v in counts.items()}).drop(*(p + x for x in ("t", "w", "l", "u", "h", "d", "s", "p")))


def verdict(rules: tuple[Rule, ...] = RULES, prefix: str = "", min_words: int = 50, max_repeat: float = 0.5) -> Column:
    """True for a document that no row of the table rejects; ``min_words`` and ``max_repeat`` are the base rule."""
    kept = ~base_failed(prefix, min_words, max_repeat)
    for r in rules:
        a, b = F.col(prefix + r.numerator), F.col(prefix + r.denominator)
        if r.low is not None:
            kept = kept & (a >= r.low * b)
        if r.high is not None:
            kept = kept & (a <= r.high * b)
    return kept


def base_failed(prefix: str = "", min_words: int = 50, max_repeat: float = 0.5) -> Column:
    n = F.col(prefix + "n_words")
    return (n < min_words) | (100 * F.col(prefix + "n_repeat_words") > 100 * max_repeat * n)


def _pinned(c: Column) -> Column:
    """``c``, kept where it stands: the optimizer moves no filter on it below the features, whose expressions the filter
    would repeat."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def score(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept``: one row per row of ``docs``."""
    found = features(docs.select("doc_id", F.col(f"`{text}`").alias("text")))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), _pinned(verdict(rules)).alias("kept"),
    )


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the table keeps, with the columns of ``docs``."""
    prefix = "__kept_"
    judged = features(docs, text, prefix).withColumn(prefix, _pinned(verdict(rules, prefix)))
    return judged.filter(F.col(prefix)).select(*(F.col(f"`{c}`") for c in docs.columns))
