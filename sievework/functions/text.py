"""Column functions over strings, keys, URLs and dates. Nothing here reads a clock; times are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ustrip(c: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return ustrip(F.regexp_replace(c, r"(?U)\s+", " "))


def is_empty(c: Column) -> Column:
    """Null or the empty string; for arrays see ``F.size``."""
    return c.isNull() | (c == "")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def content_key(*parts: Column, length: int = 20) -> Column:
    """Leading hex digits of the SHA-1 of parts joined by a bar; a null part is an empty one and keeps its place."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 1, length)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def without_query(url: Column) -> Column:
    """Without query and fragment, trimmed."""
    return F.regexp_replace(F.trim(url), "[#?].*$", "")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def folded_url(url: Column) -> Column:
    """Scheme and host in lower case, path and query as they are, no fragment."""
    head = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.concat(F.lower(head), F.substring(without_fragment(url), F.length(head) + 1, F.length(url)))


def has_token(text: Column, token: str, low: Column | None = None) -> Column:
    """Whether an ASCII word stands alone in a text, in either case. The pattern runs only where the word occurs. ``low`` is
    the text in lower case, for callers that ask for many words."""
    return F.contains(F.lower(text) if low is None else low, F.lit(token.lower())) & text.rlike(rf"(?i)(?<![A-Za-z0-9]){token}(?![A-Za-z0-9])")


def sentences(text: Column, ends: str = "。！？；!?;", least: int = 6) -> Column:
    """Sentences of a text: after any of ``ends``, after a full stop with a space, and at line ends; squeezed, and
    ``least`` characters or longer."""
    parts = F.split(F.regexp_replace(F.regexp_replace(text, f"([{ends}])", "$1\n"), r"\. ", ".\n"), "\n")
    return F.filter(F.transform(parts, squeeze), lambda s: F.length(s) >= least)


def chunked(sentence: Column, most: int = 160, early: int = 40) -> Column:
    """A long sentence in pieces of at most ``most`` characters, cut behind the last comma or space past ``early``."""
    step = F.struct(F.array().cast("array<string>").alias("out"), sentence.alias("rest"))

    def cut(a: Column, _: Column) -> Column:
        head = F.substring(a["rest"], 1, most)
        at = F.length(F.regexp_extract(head, r"(?s)^(.*[，, ])", 1))
        n = F.when(at > early, at).otherwise(most)
        long = F.length(a["rest"]) > most
        return F.struct(
            F.when(long, F.concat(a["out"], F.array(ustrip(F.substring(a["rest"], F.lit(1), n))))).otherwise(a["out"]).alias("out"),
            F.when(long, ustrip(F.substring(a["rest"], n + 1, F.length(a["rest"])))).otherwise(a["rest"]).alias("rest"),
        )

    turns = F.sequence(F.lit(0), F.ceil(F.length(sentence) / early).cast("int"))
    return F.aggregate(turns, step, cut, lambda a: F.concat(a["out"], F.array(a["rest"])))


def excerpt(text: Column, n: int = 360) -> Column:
    return F.substring(text, 1, n)


def window_around(text: Column, needle: Column, width: int = 160) -> Column:
    """``width`` characters with the first ``needle`` near the middle; the beginning if there is none."""
    at = F.greatest(F.lit(1), F.position(needle, text) - width // 2)
    return F.substring(text, at, F.lit(width))


def redacted(text: Column, pattern: str = r"AIza[0-9A-Za-z_-]+", most: int = 200) -> Column:
    return F.substring(F.regexp_replace(text, pattern, "[key]"), 1, most)


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\w.-]+", "_")


def folded(text: Column) -> Column:
    """Letters and digits only, in lower case, for loose comparison."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")


def video_id(url: Column) -> Column:
    """The id in any of the usual forms of a video URL, else null."""
    forms = (r"[?&]v=([A-Za-z0-9_-]{11})", r"youtu\.be/([A-Za-z0-9_-]{11})", r"/(?:shorts|live|embed)/([A-Za-z0-9_-]{11})")
    return F.coalesce(*(null_if_empty(F.regexp_extract(url, p, 1)) for p in forms))


def when(text: Column) -> Column:
    """A tolerant timestamp: T or a space, Z or an offset or none (UTC), or a bare date; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(F.trim(text), "T", " "), "Z$", "+00:00"))


def month_of(text: Column) -> Column:
    """``YYYY-MM`` of ``YYYY-MM…`` or ``MM/DD/YYYY``, else ``unknown``."""
    iso, us = r"^(\d{4}-\d{2})", r"^(\d{1,2})/\d{1,2}/(\d{4})"
    return (
        F.when(text.rlike(iso), F.regexp_extract(text, iso, 1))
        .when(text.rlike(us), F.concat(F.regexp_extract(text, us, 2), F.lit("-"), F.lpad(F.regexp_extract(text, us, 1), 2, "0"))).otherwise("unknown")
    )


def free_date(text: Column) -> Column:
    """The first date in running text, year first with year signs or dashes, or month/day/year."""
    cjk, us = r"(\d{4})\s*[年/-]\s*(\d{1,2})\s*[月/-]\s*(\d{1,2})", r"(\d{1,2})/(\d{1,2})/(\d{4})"
    part = lambda p, *g: F.concat_ws("-", *(F.regexp_extract(text, p, i) for i in g))
    return F.coalesce(F.try_to_timestamp(part(cjk, 1, 2, 3), F.lit("yyyy-M-d")), F.try_to_timestamp(part(us, 3, 1, 2), F.lit("yyyy-M-d"))).cast("date")


def hours_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 3.6e9


def days_between(earlier: Column, later: Column) -> Column:
    """Whole days of elapsed time, rounded down: not the number of midnights."""
    return F.floor(hours_between(earlier, later) / 24)


def gap_class(hours: Column, near: float = 36, late: float = 72) -> Column:
    """Provenance of a capture: earlier than published counts as near."""
    return (
        F.when(hours.isNull(), "unprovable").when(hours <= near, "near_publication_observed").when(hours <= late, "delayed_capture").otherwise("backfill_proven")
    )


def backoff_seconds(failures: Column, base: int = 5, most: int = 300) -> Column:
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2), F.least(failures, F.lit(6)))).cast("long")


def ceil_div(a: Column, b: Column) -> Column:
    return F.ceil(a / b).cast("long")


def bound(value: Column, made) -> Column:
    """``made(value)`` with the value worked out once a row: an expression that a lambda uses would be worked out again
    for each element."""
    return F.get(F.transform(F.array(value), made), F.lit(0))
