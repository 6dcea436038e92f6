"""Whether a seen title is the wanted one: matching by longest common blocks, channel names and shared symbols."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T

#: Ratios that do alone and with a channel, shared symbols that do with a channel, what a symbol looks like.
ALONE, WITH_CHANNEL, SYMBOLS = 0.6, 0.35, 2
SYMBOL = r"(?<![A-Za-z])[A-Z]{2,5}(?![A-Za-z])"
#: The same, but not next to a digit or an underscore either.
WHOLE_SYMBOL = r"(?<![A-Za-z0-9_])[A-Z]{2,5}(?![A-Za-z0-9_])"
#: From this length of the second text on, characters that make up over a hundredth of it start no block.
LONG = 200


def matched(a: str, b: str) -> int:
    """Characters in common blocks: the longest block that starts first in ``a``, then first in ``b``, and in the same way
    the blocks on its left and on its right (Ratcliff and Obershelp)."""
    places = defaultdict(list)
    for j, c in enumerate(b):
        places[c].append(j)
    if len(b) >= LONG:
        for c, n in Counter(b).items():
            if n > len(b) // 100 + 1:
                del places[c]
    total, open_ = 0, [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        at_a, at_b, size, before = a0, b0, 0, {}
        for i in range(a0, a1):
            now = {}
            for j in places.get(a[i], ()):
                if j >= b1:
                    break
                if j >= b0:
                    n = now[j] = before.get(j - 1, 0) + 1
                    if n > size:
                        at_a, at_b, size = i - n + 1, j - n + 1, n
            before = now
        # characters that start no block may still lengthen one
        while at_a > a0 and at_b > b0 and a[at_a - 1] == b[at_b - 1]:
            at_a, at_b, size = at_a - 1, at_b - 1, size + 1
        while at_a + size < a1 and at_b + size < b1 and a[at_a + size] == b[at_b + size]:
            size += 1
        if size:
            total += size
            open_ += [(a0, at_a, b0, at_b), (at_a + size, a1, at_b + size, b1)]
    return total


def ratio(a: Column, b: Column) -> Column:
    """Twice the matched characters over all characters: 1 for two empty texts, null where one is null. It isn't
    symmetric."""

    @F.pandas_udf("long")
    def count(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([None if p is None or q is None else matched(p, q) for p, q in zip(x, y, strict=True)], dtype="Int64")

    both = F.length(a) + F.length(b)
    return F.when(both == 0, 1.0).otherwise(2 * count(a, b) / both)


def symbols(text: Column, symbol: str = SYMBOL) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(symbol), F.lit(0)))


def same_title(seen: Column, channel: Column, named: Column, title: Column, author: Column, symbol: str = SYMBOL) -> Column:
    """Struct of the ratio of the folded titles, whether a name of the author (names are split at / and |) is part of the
    channel or the other way round, the number of shared symbols (what ``symbol`` finds; those ``named`` count as seen), and
    the verdict, false where a folded title is empty."""
    own, want, on = (T.folded(F.coalesce(c, F.lit(""))) for c in (seen, title, channel))
    names = F.filter(F.transform(F.split(F.coalesce(author, F.lit("")), "[/|]"), T.folded), lambda n: n != "")
    hit = (on != "") & F.exists(names, lambda n: F.contains(on, n) | F.contains(n, on))
    wanted = symbols(title, symbol)
    shared = F.size(F.array_intersect(wanted, F.array_union(symbols(seen, symbol), F.transform(F.coalesce(named, F.array().cast("array<string>")), F.upper))))
    r = ratio(own, want)
    same = (own != "") & (want != "") & ((r >= ALONE) | hit & ((r >= WITH_CHANNEL) | (F.size(wanted) >= SYMBOLS) & (shared >= SYMBOLS)))
    return F.struct(r.alias("ratio"), hit.alias("channel_hit"), shared.cast("long").alias("shared"), same.alias("same"))
