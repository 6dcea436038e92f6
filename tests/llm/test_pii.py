"""Pseudonyms against plain Python, text by text, and dates that must not meet."""

import datetime
import hashlib

import regex
from pyspark.sql import functions as F

from sievework.llm import pii, queries

KEY, START = "key for tests", datetime.date(1800, 1, 1)


def feistel(xs, radices, tweak):
    xs = list(xs)
    half = len(xs) // 2
    for r in range(pii.ROUNDS):
        other = xs[half:] if r % 2 == 0 else xs[:half]
        k = hashlib.sha256(f"{KEY}|{tweak}|{r}|{','.join(map(str, other))}".encode()).hexdigest()
        xs = [(x + int(k[i * 4 % 61 : i * 4 % 61 + 4], 16)) % radices[i] if (i < half) == (r % 2 == 0) else x for i, x in enumerate(xs)]
    return xs


def digits(t):
    return regex.sub("[^0-9]", "", t)


def put(m, new):
    new = iter(new)
    return "".join(next(new) if c in "0123456789" else c for c in m)


def permuted(d, kind):
    return "".join(map(str, feistel(map(int, d), [10] * len(d), f"{kind}{len(d)}")))


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d))))


def mod97(t):
    return int("".join(str(int(c, 36)) for c in t)) % 97


def read(m, *forms):
    for f in forms:
        try:
            return datetime.datetime.strptime(m, f).date()
        except ValueError:
            pass
    return None


def pseudonym(m):
    d, plain = digits(m), regex.sub("[ -]", "", m)
    if "@" in m:
        local, at = m[: m.index("@")], m[m.rindex("@") + 1 :]
        base = lambda c: 48 if c in "0123456789" else 97 if c.islower() else 65
        isl = [c.isascii() and c.isalnum() for c in local]
        shape = regex.sub("[A-Za-z]", "a", regex.sub("[0-9]", "0", local))
        new = feistel([ord(c) - base(c) if s else 0 for c, s in zip(local, isl, strict=True)], [1 if not s else 10 if c.isdigit() else 26 for c, s in zip(local, isl, strict=True)], "email" + shape + at.lower())
        return "email", "".join(chr(base(c) + x) if s else c for c, s, x in zip(local, isl, new, strict=True)) + "@" + at
    if regex.match("[A-Z]", m):
        if len(plain) < 15 or mod97(plain[4:] + plain[:4]) != 1:
            return None, m
        body = plain[4:]
        account = put(body, permuted(digits(body), "iban"))
        new = iter(f"{98 - mod97(account + plain[:2] + '00'):02d}" + account)
        return "iban", m[:2] + "".join(c if c == " " else next(new) for c in m[2:])
    if regex.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", m):
        octets = list(map(int, m.split(".")))
        return ("ip", ".".join(map(str, feistel(octets, [256] * 4, "ip")))) if max(octets) < 256 else (None, m)
    if regex.fullmatch(r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}", m):
        form = "%Y-%m-%d" if m[4] == "-" else "%Y/%m/%d" if m[4] == "/" else "%d.%m.%Y" if m[2] == "." else "%d/%m/%Y"
        day = read(m, form)
        if day is None and form == "%d/%m/%Y":
            form, day = "%m/%d/%Y", read(m, "%m/%d/%Y")
        n = (day - START).days if day else -1
        if not 0 <= n < pii.DAY_HIGH * pii.DAY_LOW:
            return None, m
        while True:
            a, b = feistel([n // pii.DAY_LOW, n % pii.DAY_LOW], [pii.DAY_HIGH, pii.DAY_LOW], "date")
            n = a * pii.DAY_LOW + b
            new = START + datetime.timedelta(n)
            if form != "%m/%d/%Y" or new.day > 12:
                return "date", new.strftime(form)
    if regex.fullmatch(r"\d{3}-\d{2}-\d{4}", m):
        if regex.search(r"^(000|666|9)|-00-|-0000$", m):
            return None, m
        a, g, s = map(int, m.split("-"))
        x = feistel([a - (2 if a > 666 else 1), g - 1, s - 1], [898, 99, 9999], "ssn")
        return "ssn", f"{x[0] + (2 if x[0] > 664 else 1):03d}-{x[1] + 1:02d}-{x[2] + 1:04d}"
    if "+" in m or regex.fullmatch(r"\(?\d{3}\)?[ .-]+\d{3}[ .-]\d{4}", m):
        if not 7 <= len(d) <= 15:
            return None, m
        return "phone", put(m, d[:-10] + permuted(d[-10:], "phone"))
    if 13 <= len(d) <= 19 and luhn(d) % 10 == 0:
        p = permuted(d[:-1], "card")
        return "card", put(m, p + str(-luhn(p + "0") % 10))
    return None, m


def plain(text):
    counts = dict.fromkeys(pii.KINDS, 0)

    def one(m):
        kind, new = pseudonym(m[0])
        if kind:
            counts[kind] += 1
        return new

    return (None if text is None else regex.sub(pii.PATTERN, one, text)), counts


MORE = ["mail Jo.Doe+x9@Example.COM, 1.2.3.4 and 256.1.1.1", "DE89 3704 0044 0532 0130 00; GB82WEST12345698765432", "2024-02-29 2024/02/30 31.12.1999 12/31/1999 02/03/1995 1700-01-01", "123-45-6789 666-12-1234 667-01-0001", "+49 30 1234567, (212) 555-0199, 4111 1111 1111 1111, 4111111111111112", ""]


def test_query_equals_plain_python(spark):
    """Whole texts and counts of the given documents and of some with each kind."""
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: plain(r.text) for r in queries.documents(spark, sf).select("doc_id", "text").collect()}
    for r in queries.op9_pii(spark, sf).collect():
        text, counts = want[r.doc_id]
        assert r.text == text and {k: r[f"n_{k}"] for k in pii.KINDS} == counts
    total = [sum(c[k] for _, c in want.values()) for k in pii.KINDS]
    assert sum(total) > 20
    df = spark.createDataFrame([(i, t) for i, t in enumerate(MORE)], "doc_id int, text string")
    got = {r.doc_id: r for r in pii.pseudonymize(df, KEY).collect()}
    for i, t in enumerate(MORE):
        text, counts = plain(t)
        assert got[i].text == text and {k: got[i][f"n_{k}"] for k in pii.KINDS} == counts
    assert all(sum(got[i][f"n_{k}"] for i in got) for k in pii.KINDS)


def test_dates_of_ten_years_in_both_orders_never_meet(spark):
    days = [datetime.date(1990, 1, 1) + datetime.timedelta(i) for i in range(3652)]
    texts = sorted({d.strftime(f) for d in days for f in ("%d/%m/%Y", "%m/%d/%Y")})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.text for r in df.select(pii.pseudonym(F.col("text"), F.lit("date"), KEY).alias("text")).collect()]
    assert len(texts) > 5000 and len(set(got)) == len(texts)
    assert all(read(t, "%d/%m/%Y") is None for o, t in zip(texts, got, strict=True) if read(o, "%d/%m/%Y") is None)
