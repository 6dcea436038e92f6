"""Merkle manifest of a dataset: a radix-ranked trie over its rows, one subtree a group, and a proof for each row.

Ranks come from digit histograms: rows are counted by the leading digits of their key, one level of the histogram for
each digit, and a row's rank is the number of rows under smaller digits at each level plus its place among the rows
that share all digits but the last. No task sorts more than one such bucket, however large a group is. Digits of the
rank in the base of the fan-out then key the trie's nodes: rows that share all but the last three digits meet in one
shuffle, which reduces three levels at once, and so on up to the root. Proofs go back down the same blocks.

Everything is built from Spark's functions. Edge cases: keys that are null come first in their group, and a null group
before all others; rows with equal keys are ordered by digest, and rows with equal digests are alike, so which of them
takes which place can't be told; each repeated row has a leaf of its own. An empty table gives no rows. Columns that
aren't asked for are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.llm.shared import dropped, written
from sievework.operators import order

#: Children of a node, as bits of a rank.
FAN = 3
#: Levels that one shuffle reduces; a block holds 8 ** LEVELS nodes.
LEVELS = 3
#: Bits of a key that one level of the histogram counts by.
DIGIT = 10
#: Rows of a bucket that one task sorts; more are told apart by digits of their digests.
BUCKET = 1 << 16
#: Equal rows that are counted and laid out in one piece.
PIECE = 1 << 16

PATH = "array<struct<l:string,r:string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of values that follow one another."""
    return F.sha2(F.concat(*values), 256)


def leaf(*fields: Column) -> Column:
    """Digest of fields, each as its UTF-8 byte count, a colon and the value, or a dash for null."""
    own = [f.cast("string") for f in fields]
    return digest(*(F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in own))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to, given its siblings."""
    return F.aggregate(path, start, lambda h, s: digest(s["l"], h, s["r"]))


def siblings(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def prove(df: DataFrame, key: str, group: str, leaf: str, carry: list[str]) -> DataFrame:
    """Each row's ``key``, ``leaf`` and ``carry`` columns, with ``subroot`` (of its group), ``root`` and ``path``."""
    spark = df.sparkSession
    row = F.struct(F.col(key).alias("key"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))).alias("row")
    # a null group sorts before "=", which each other group begins with
    rows = df.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"), F.col(key).cast("long").alias("k"), F.col(leaf).alias("h"), row)
    counted = written(rows.groupBy("g", "k", "h").agg(F.count("*").alias("n"), F.first("row").alias("row")), "manifest-rows")
    blocks = _up(_laid_out(_ranked(counted)))
    dropped(spark, counted)
    if not blocks:
        return df.select(key, leaf, *carry).limit(0).withColumns({"subroot": F.lit(""), "root": F.lit(""), "path": F.lit(None).cast(PATH)})
    groups = order.numbered(_tops(blocks), [F.col("g").asc()], "r")
    of_all = groups.select(F.lit("").alias("g"), "r", F.lit(groups.count()).alias("size"), "h", F.struct("g").alias("row"))
    above = _up(of_all)
    root = _tops(above).select("g", F.lit(None).cast(PATH).alias("up"), F.struct(F.col("h").alias("root")).alias("told"))
    tops = _down(above, root).select(F.col("row.g").alias("g"), F.col("path").alias("up"), F.struct(F.col("h").alias("subroot"), "told.root").alias("told"))
    found = _down(blocks, tops)
    return found.select(F.col("row.key").alias(key), F.col("h").alias(leaf), *(F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)), "told.subroot", "told.root", "path")


def _ranked(counted: DataFrame) -> DataFrame:
    """``r``, the number of rows of the group before each row in the order of (k, h), and ``size``, the group's rows."""
    ends = counted.agg(F.min("k"), F.max("k")).first()
    shifts = [DIGIT]
    while ends[0] is not None and (ends[1] >> shifts[-1]) - (ends[0] >> shifts[-1]) >= 1 << DIGIT:
        shifts.append(shifts[-1] + DIGIT)

    def levels(hexes: int) -> list[tuple[int, int]]:
        """Bits of the key left out and hex digits of the digest used, from the finest level up."""
        return [*((0, d) for d in range(hexes, -1, -3) if hexes), *((s, 0) for s in shifts)]

    def prefix(k: Column, h: Column, level: tuple[int, int]) -> dict[str, Column]:
        return {"z": F.when(k.isNull(), 0).otherwise(1), "p": F.coalesce(F.shiftright(k, level[0]), F.lit(0)), "q": F.substring(h, 1, level[1])}

    def histogram(level: tuple[int, int]) -> DataFrame:
        return counted.withColumns(prefix(F.col("k"), F.col("h"), level)).groupBy("g", "z", "p", "q").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))

    widest = histogram((shifts[0], 0)).agg(F.max("rows")).first()[0] or 0
    hexes = 0
    while widest > BUCKET << (4 * hexes):  # digests are spread evenly, so each digit divides a bucket by 16
        hexes += 3
    chain = levels(hexes)
    tables = [histogram(chain[0])]
    for lower, upper in zip(chain, chain[1:], strict=False):
        step = upper[0] - lower[0]
        tables.append(tables[-1].withColumns({"p": F.shiftright("p", step), "q": F.substring("q", 1, upper[1])}).groupBy("g", "z", "p", "q").agg(F.sum("n").alias("n")))
    before = lambda *by: F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy("z", "p", "q").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    found = tables[-1].select("g", "z", "p", "q", before("g").alias("off"), F.sum("n").over(W.partitionBy("g")).alias("size"))
    for table, lower, upper in zip(tables[-2::-1], chain[-2::-1], chain[:0:-1], strict=True):
        up = {"up_p": F.shiftright("p", upper[0] - lower[0]), "up_q": F.substring("q", 1, upper[1])}
        own = table.withColumns(up).withColumn("own", before("g", "z", "up_p", "up_q"))
        above = found.select("g", "z", F.col("p").alias("up_p"), F.col("q").alias("up_q"), "off", "size")
        found = own.join(above, ["g", "z", "up_p", "up_q"]).select("g", "z", "p", "q", (F.col("off") + F.col("own")).alias("off"), "size")
    bucket = W.partitionBy("g", "z", "p", "q").orderBy("k", "h").rowsBetween(W.unboundedPreceding, -1)
    rows = counted.withColumns(prefix(F.col("k"), F.col("h"), chain[0])).join(found, ["g", "z", "p", "q"])
    return rows.select("g", (F.col("off") + F.coalesce(F.sum("n").over(bucket), F.lit(0))).alias("r"), "size", "n", "h", "row")


def _laid_out(ranked: DataFrame) -> DataFrame:
    """A row for each place that equal rows take."""
    one = ranked.filter("n = 1").drop("n")
    pieces = ranked.filter("n > 1").withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {PIECE}")))).repartition("g", "r", "piece")
    places = F.explode(F.sequence(F.col("piece") * PIECE, F.least((F.col("piece") + 1) * PIECE, F.col("n")) - 1))
    many = pieces.select("g", "r", "size", "h", "row", places.alias("place")).select("g", (F.col("r") + F.col("place")).alias("r"), "size", "h", "row")
    return one.unionByName(many)


def _height(size: Column) -> Column:
    """Levels above the leaves: the least t with 8 ** t >= size."""
    return F.when(size < 2, 0).otherwise(F.ceil(F.length(F.bin(size - 1)) / FAN)).cast("int")


def _run(nodes: Column) -> Column:
    """Digests of runs of eight consecutive nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / (1 << FAN)).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * (1 << FAN) + 1, F.lit(1 << FAN)), ""), 256))


def _up(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of nodes from the leaves up: a block's nodes ``l0`` and what they reduce to, ``l1`` to ``l3``; levels above
    the group's own root are empty."""
    out, nodes = [], leaves.select("g", "r", _height(F.col("size")).alias("t"), "h", "row")
    while True:
        base, carries = LEVELS * len(out), not out
        member = F.struct("r", "h", *(["row"] if carries else []))
        found = nodes.groupBy("g", "t", F.shiftright("r", FAN * LEVELS).alias("b")).agg(F.sort_array(F.collect_list(member)).alias("m"))
        found = found.withColumn("l0", F.col("m.h"))
        for i in range(1, LEVELS + 1):
            found = found.withColumn(f"l{i}", F.when(F.col("t") >= base + i, _run(F.col(f"l{i - 1}"))))
        table = written(found.withColumn("rows", F.col("m.row")).drop("m") if carries else found.drop("m"), "manifest-blocks")
        out.append(table)
        highest = table.agg(F.max("t")).first()[0]
        if highest is None:
            return []
        if highest <= base + LEVELS:
            return out
        nodes = table.filter(F.col("t") > base + LEVELS).select("g", F.col("b").alias("r"), "t", F.col(f"l{LEVELS}")[0].alias("h"))


def _tops(blocks: list[DataFrame]) -> DataFrame:
    """The root of each group."""
    out = None
    for i, table in enumerate(blocks):
        own = table.filter(F.col("t").between(LEVELS * i + 1 if i else 0, LEVELS * (i + 1)))
        last = F.coalesce(*(F.col(f"l{j}") for j in range(LEVELS, -1, -1)))[0]
        own = own.select("g", last.alias("h"))
        out = own if out is None else out.unionByName(own)
    return out


def _down(blocks: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each leaf with its path: its siblings in the block, then the path of the block's root; ``tops`` gives each group what
    lies above its root (``up``) and what its rows are told (``told``)."""
    tops = tops.withColumn("up", F.coalesce("up", F.lit(None).cast(PATH), F.array().cast(PATH)))
    found = None
    for i in range(len(blocks) - 1, -1, -1):
        table, base = blocks[i], LEVELS * i
        # a group's root block is its only one at that height
        own = table.filter(F.col("t").between(base + 1 if i else 0, base + LEVELS)).select("g").join(tops, "g").select("g", F.lit(0).cast("long").alias("b"), "up", "told")
        ups = own if found is None else own.unionByName(found.select("g", F.col("r").alias("b"), F.col("path").alias("up"), "told"))
        held = table.join(ups, ["g", "b"])
        at = F.col("at")

        def step(level: int, base: int = base, at: Column = at) -> Column:
            nodes, own = F.col(f"l{level}"), F.shiftright(at, FAN * level)
            first = own - own.bitwiseAND((1 << FAN) - 1)
            left = F.array_join(F.slice(nodes, first + 1, own - first), "")
            right = F.array_join(F.slice(nodes, own + 2, first + ((1 << FAN) - 1) - own), "")
            return F.when(F.col("t") > base + level, F.array(F.struct(left.alias("l"), right.alias("r")))).otherwise(F.array().cast(PATH))

        each = held.select("g", "b", "t", *(f"l{j}" for j in range(LEVELS)), "up", "told", *(["rows"] if not i else []), F.posexplode("l0").alias("at", "h"))
        path = F.concat(*(step(j) for j in range(LEVELS)), F.col("up"))
        row = [F.col("rows")[at].alias("row")] if not i else []
        found = each.select("g", (F.col("b") * (1 << (FAN * LEVELS)) + at).alias("r"), "h", path.alias("path"), "told", *row)
    return found
