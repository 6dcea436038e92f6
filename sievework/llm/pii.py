"""Format-preserving Feistel pseudonyms for personal data, in DataFrame operations only.

One pattern cuts a text into gaps and matches; a match that passes the check of its kind (Luhn, mod 97, octets up to
255, a real calendar date) is turned into symbols with a radix each, the symbols are permuted by a keyed Feistel
network, and the result is put back in the match's own format, with check digits made anew. The permutation depends on
key, kind and value alone: equal values get equal pseudonyms in every document, however they are punctuated, and
different values of one format never meet. Only texts with a digit or an at sign are cut.

What is permuted: all digits of a card number but the check digit; the digits of an IBAN's account part; the last ten
digits of a phone number or all of a shorter one; area, group and serial number of a social security number, each
within what is ever given out; the octets of an IPv4
address; dates within the 400 years from 1800, in any of four layouts (those that only a month in front makes a date,
such as 02/17/1990, among themselves); letters and digits of an e-mail's local part,
each within its own alphabet, capital letters like small ones.

Edge cases: a null text stays null with counts 0; other columns pass through; rows are independent; texts are
processed whole; matches that fail their check stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import fresh

KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
#: One alternative per format, the longest first where they can start alike.
PATTERN = "|".join((
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![./-]?\d)",
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<![\d])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|(?<![\d])\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    r"\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    r"(?<![\d])\d(?:[ -]?\d){12,18}(?!\d)",
))
ROUNDS = 8
#: 400 Gregorian years are 146,097 days, which is 189 x 773: a domain that two symbols fill exactly.
FIRST_DAY, DAY_HIGH, DAY_LOW = "1800-01-01", 189, 773
WALK = 64


def feistel(symbols: Column, radices: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """Permute an array of ints, each within its radix. Even rounds add a keyed stream made of the right half to the
    left one, odd rounds the other way round, so each round can be undone."""
    half = F.floor(F.size(symbols) / 2).cast("int")

    def turn(a: Column, r: Column) -> Column:
        other = F.when(r % 2 == 0, F.slice(a, half + 1, F.size(a) - half)).otherwise(F.slice(a, 1, half))
        stream = F.sha2(F.concat_ws("|", F.lit(key), tweak, r, F.array_join(other.cast("array<string>"), ",")), 256)
        step = lambda k: F.transform(a, lambda x, i: F.when(
            (i < half) == (r % 2 == 0), F.pmod(x + F.conv(F.substring(k, i * 4 % 61 + 1, F.lit(4)), 16, 10).cast("int"), F.get(radices, i))).otherwise(x))
        return F.get(F.transform(F.array(stream), step), F.lit(0))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), symbols, turn)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def _ints(digits: Column) -> Column:
    return F.filter(F.split(digits, ""), lambda c: c != "").cast("array<int>")


def _put(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by those of a string of as many digits."""
    chars = F.filter(F.split(m, ""), lambda c: c != "")
    state = F.struct(F.lit(0).alias("n"), F.lit("").alias("s"))
    isd = lambda c: c.rlike("^[0-9]$")
    return F.aggregate(chars, state, lambda a, c: F.struct(
        (a["n"] + F.when(isd(c), 1).otherwise(0)).alias("n"), F.concat(a["s"], F.when(isd(c), F.substring(digits, a["n"] + 1, F.lit(1))).otherwise(c)).alias("s")), lambda a: a["s"])


def _luhn(digits: Column) -> Column:
    """Sum for the Luhn test, in which the last digit counts once."""
    d = F.reverse(_ints(digits))
    return F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + x)


def _mod97(chars: Column) -> Column:
    """Remainder by 97 of a string of digits and capital letters, a letter being 10 to 35."""
    parts = F.filter(F.split(chars, ""), lambda c: c != "")
    return F.aggregate(parts, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _permuted(digits: Column, kind: str, key: str) -> Column:
    n = F.length(digits)
    return F.array_join(feistel(_ints(digits), F.array_repeat(F.lit(10), n), F.concat(F.lit(kind), n.cast("string")), key).cast("array<string>"), "")


#: Layouts of dates, as a pattern for the match and one for Spark.
DATES = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}\.", "dd.MM.yyyy"), (r"^\d{2}/", "dd/MM/yyyy"))


def _day(m: Column) -> Column:
    """Days from ``FIRST_DAY``; null if the match is no date of the domain."""
    found = F.coalesce(*(F.when(m.rlike(p), F.try_to_timestamp(m, F.lit(f)).cast("date")) for p, f in DATES), F.when(m.rlike(r"^\d{2}/"), F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).cast("date")))
    n = F.datediff(found, F.lit(FIRST_DAY).cast("date"))
    return F.when(n.between(0, DAY_HIGH * DAY_LOW - 1), n)


def _month_first(day: Column, moved) -> Column:
    """The pseudonym of a date that can be read with its month first only. It must be one too, or it would meet that of
    another date, so the permutation goes on until the day of the month can't be a month: this permutes such dates among
    themselves. Three in five days will do, so over ``WALK`` steps are an error that no key is known to cause."""
    date = lambda d: F.date_add(F.lit(FIRST_DAY).cast("date"), d)
    fits = lambda d: F.dayofmonth(date(d)) > 12
    end = _let(day, lambda d: F.aggregate(F.sequence(F.lit(2), F.lit(WALK)), moved(d), lambda x, _: F.when(fits(x), x).otherwise(moved(x))))
    return _let(end, lambda d: F.when(fits(d), date(d)).otherwise(F.raise_error(F.lit("no pseudonym for a date")).cast("date")))


def kind_of(m: Column) -> Column:
    """The kind of a match that passes its kind's check, else null."""
    digits, plain = _digits(m), F.regexp_replace(m, "[ -]", "")
    octets = F.split(m, r"\.").cast("array<int>")
    return (
        F.when(F.contains(m, F.lit("@")), "email")
        .when(m.rlike("^[A-Z]"), F.when((F.length(plain) >= 15) & (_mod97(F.concat(F.substring(plain, 5, 99), F.substring(plain, 1, 4))) == 1), F.lit("iban")))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.forall(octets, lambda x: x <= 255), F.lit("ip")))
        .when(m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})$"), F.when(_day(m).isNotNull(), F.lit("date")))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(~m.rlike(r"^(000|666|9)|-00-|-0000$"), F.lit("ssn")))
        .when(F.contains(m, F.lit("+")) | m.rlike(r"^\(?\d{3}\)?[ .-]+\d{3}[ .-]\d{4}$"), F.when(F.length(digits).between(7, 15), F.lit("phone")))
        .when(F.length(digits).between(13, 19) & (_luhn(digits) % 10 == 0), F.lit("card"))
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match of a kind, in the match's format."""
    digits = _digits(m)
    card = _let(_permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), "card", key), lambda p: F.concat(p, F.pmod(-_luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
    tail = F.least(F.length(digits), F.lit(10))
    phone = F.concat(F.substring(digits, F.lit(1), F.length(digits) - tail), _permuted(F.substring(digits, F.length(digits) - tail + 1, tail), "phone", key))
    # Areas 001 to 899 without 666, groups from 01, serial numbers from 0001.
    area = F.substring(digits, 1, 3).cast("int")
    places = F.array(area - F.when(area > 666, 2).otherwise(1), F.substring(digits, 4, 2).cast("int") - 1, F.substring(digits, 6, 4).cast("int") - 1)
    ssn = _let(feistel(places, F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key), lambda s: F.concat_ws(
        "-", *(F.lpad((x + k).cast("string"), n, "0") for x, k, n in ((s[0], F.when(s[0] > 664, 2).otherwise(1), 3), (s[1], F.lit(1), 2), (s[2], F.lit(1), 4)))))
    ip = F.array_join(feistel(F.split(m, r"\.").cast("array<int>"), F.array_repeat(F.lit(256), 4), F.lit("ip"), key).cast("array<string>"), ".")
    moved = lambda d: _let(feistel(F.array(F.floor(d / DAY_LOW).cast("int"), d % DAY_LOW), F.array(F.lit(DAY_HIGH), F.lit(DAY_LOW)), F.lit("date"), key), lambda s: s[0] * DAY_LOW + s[1])
    date = _let(_day(m), lambda d: F.date_add(F.lit(FIRST_DAY).cast("date"), moved(d)))
    american = m.rlike(r"^\d{2}/") & F.try_to_timestamp(m, F.lit("dd/MM/yyyy")).isNull()
    laid = F.when(american, F.date_format(_month_first(_day(m), moved), "MM/dd/yyyy"))
    for p, f in DATES:
        laid = laid.when(m.rlike(p), F.date_format(date, f))
    local, at = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    chars = F.filter(F.split(local, ""), lambda c: c != "")
    base = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65)
    width = F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1))
    shape = F.regexp_replace(F.regexp_replace(local, "[0-9]", "0"), "[A-Za-z]", "a")
    symbols = F.transform(chars, lambda c: F.coalesce(F.ascii(c) - base(c), F.lit(0)))
    email = F.concat(_let(feistel(symbols, width, F.concat(F.lit("email"), shape, F.lower(at)), key), lambda s: F.array_join(F.transform(chars, lambda c, i: F.coalesce(F.char(base(c) + F.get(s, i)), c)), "")), F.lit("@"), at)
    body = F.regexp_replace(F.substring(m, 5, 99), "[ -]", "")
    account = _put(body, _let(_digits(body), lambda d: _permuted(d, "iban", key)))
    iban = _let(account, lambda a: F.concat(F.lpad((98 - _mod97(F.concat(a, F.substring(m, 1, 2), F.lit("00")))).cast("string"), 2, "0"), a))
    spaced = F.concat(F.substring(m, 1, 2), _let(iban, lambda a: F.aggregate(F.filter(F.split(F.substring(m, 3, 99), ""), lambda c: c != ""), F.struct(F.lit(0).alias("n"), F.lit("").alias("s")),
        lambda t, c: F.struct((t["n"] + F.when(c == " ", 0).otherwise(1)).alias("n"), F.concat(t["s"], F.when(c == " ", c).otherwise(F.substring(a, t["n"] + 1, F.lit(1)))).alias("s")), lambda t: t["s"])))
    return (
        F.when(kind == "card", _put(m, card)).when(kind == "phone", _put(m, phone)).when(kind == "ssn", ssn)
        .when(kind == "ip", ip).when(kind == "date", laid).when(kind == "email", email).when(kind == "iban", spaced).otherwise(m)
    )


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the number of them by kind as ``n_`` + kind (long)."""
    t = F.col(f"`{text}`")
    some = F.coalesce(t.rlike("[0-9]|@"), F.lit(False))
    matches = F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))
    typed = F.transform(matches, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    found, gaps = fresh(docs, "_found"), fresh(docs, "_gaps")
    out = docs.withColumn(found, F.when(some, typed)).withColumn(gaps, F.when(some & (F.size(found) > 0), F.split(t, PATTERN, -1)))
    new = F.transform(found, lambda x: pseudonym(x["m"], x["kind"], key))
    joined = F.array_join(F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter(found, lambda x: F.coalesce(x["kind"] == kind, F.lit(False)))), F.lit(0)).cast("long")

    out = out.withColumns({f"n_{k}": F.when(some, count(k)).otherwise(F.lit(0).cast("long")) for k in KINDS})
    return out.withColumn(text, F.when(F.size(gaps) > 1, joined).otherwise(t)).drop(found, gaps)
