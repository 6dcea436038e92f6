"""Column functions over dates and clocks. Times of day and zones are arguments; text that is no date gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T


def stamp(text: Column) -> Column:
    """A timestamp of which, without a space in it, only the first ten characters count."""
    s = F.trim(text)
    spaced = F.coalesce(*(F.try_to_timestamp(F.substring(s, 1, 19), F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")))
    return F.when(F.contains(s, F.lit(" ")), spaced).otherwise(F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd")))


def compact_date(text: Column) -> Column:
    """ISO date of ``YYYYMMDD…``, else the empty string."""
    return F.when(text.rlike(r"^\d{8}"), F.regexp_replace(F.substring(text, 1, 8), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")).otherwise("")


def epoch_date(seconds: Column) -> Column:
    """ISO date (UTC) of seconds since 1970, else the empty string."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"), F.lit(""))


def first_date(*texts: Column) -> Column:
    """The first that is not empty, as text; the empty string if all are."""
    return F.coalesce(*(T.null_if_empty(t) for t in texts), F.lit(""))


def months(first: Column, last: Column) -> Column:
    """``YYYY-MM`` of each month from one date to another, both included."""
    return F.transform(F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))


def timely(published: Column, captured: Column, early: float = -24, late: float = 168) -> Column:
    return T.hours_between(published, captured).between(early, late)


def quota_day(utc: Column, zone: str = "America/Los_Angeles") -> Column:
    """The calendar day of a UTC time in a zone."""
    return F.from_utc_timestamp(utc, zone).cast("date")


def rolled_over(month_day: Column, year: Column, root_month: Column) -> Column:
    """ISO date of ``MM-DD``: in the year after ``year`` where the month lies before the root's month."""
    month = F.substring(month_day, 1, 2).cast("int")
    return F.concat_ws("-", (year + (month < root_month).cast("int")).cast("string"), month_day)


def page_clock(text: Column) -> Column:
    """The latest ``MM/DD/YYYY HH:MM:SS`` that stands in a page's text, with or without a mark between."""
    found = F.regexp_extract_all(text, F.lit(r"(\d{2}/\d{2}/\d{4})\s*(?:postreply)?\s*(?:\d{2}:\d{2}:\d{2})"), F.lit(0))
    plain = F.transform(found, lambda x: F.concat(F.substring(x, 1, 10), F.lit(" "), F.substring(x, -8, 8)))
    return F.array_max(F.transform(plain, lambda x: F.try_to_timestamp(x, F.lit("MM/dd/yyyy HH:mm:ss"))))


def recent(published: Column, now: Column, days: int = 7) -> Column:
    """From 0 to ``days`` whole days old; false if there is no date."""
    day = F.try_to_timestamp(F.substring(published, 1, 10), F.lit("yyyy-MM-dd"))
    return F.coalesce(T.days_between(day, now).between(0, days), F.lit(False))


def on_hold(first_seen: Column, now: Column, hours: int = 48) -> Column:
    """Still waiting for its date: first seen under ``hours`` ago. Seen only now is waiting; an unreadable time isn't."""
    return F.when(T.is_empty(first_seen), F.lit(True)).otherwise(F.coalesce(T.hours_between(T.when(first_seen), now) < hours, F.lit(False)))


def historical(published: Column, discovered: Column) -> Column:
    """Published on a day before it was discovered, where both days are known."""
    day = lambda c: F.when(c.rlike(r"^.{4}-.{2}-.{2}"), F.substring(c, 1, 10))
    return F.coalesce(day(published) < day(discovered), F.lit(False))
