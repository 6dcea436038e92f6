"""Text reports: digests, messages of bounded length, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.feed import first_of


def messages(text: Column, most: int = 3800) -> Column:
    """A text in pieces of at most ``most`` characters, cut at line ends; a longer line is cut where it must be."""
    def pieces(line: Column) -> Column:
        return F.when(F.length(line) <= most, F.array(line)).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.length(line) - 1) / most).cast("int")), lambda i: F.substring(line, i * most + 1, F.lit(most))))

    def add(a: Column, line: Column) -> Column:
        fits = (a["now"] != "") & (F.length(a["now"]) + 1 + F.length(line) <= most)
        return F.struct(
            F.when(fits | (a["now"] == ""), a["out"]).otherwise(F.concat(a["out"], F.array(a["now"]))).alias("out"),
            F.when(fits, F.concat(a["now"], F.lit("\n"), line)).otherwise(line).alias("now"))

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("now"))
    lines = F.flatten(F.transform(F.split(text, "\n"), pieces))
    return F.aggregate(lines, start, add, lambda a: F.when(a["now"] != "", F.concat(a["out"], F.array(a["now"]))).otherwise(a["out"]))


def digest(df: DataFrame, group: str, line: Column, order: list, shown: int = 8) -> DataFrame:
    """(group, text): the first ``shown`` lines of each group, and how many more there are."""
    rows = df.select(group, line.alias("_line"), F.struct(*order).alias("_order"))
    top = first_of(rows, [group], ["_order"], shown).groupBy(group).agg(F.sort_array(F.collect_list(F.struct("_order", "_line"))).alias("_l"))
    both = top.join(df.groupBy(group).agg(F.count("*").alias("_n")), group)
    more = F.when(F.col("_n") > shown, F.array(F.concat(F.lit("+"), (F.col("_n") - shown).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    return both.select(group, F.array_join(F.concat(F.transform("_l", lambda x: x["_line"]), more), "\n").alias("text"))


def by_symbol(df: DataFrame, symbols: str, key: str) -> DataFrame:
    """(symbol, rows, keys): rows per symbol, most first; rows without a symbol under an empty one."""
    one = df.select(key, F.explode_outer(symbols).alias("symbol")).withColumn("symbol", F.coalesce("symbol", F.lit("")))
    g = one.groupBy("symbol").agg(F.countDistinct(key).alias("rows"), F.min(key).alias("first"))
    return g.orderBy((F.col("symbol") == "").asc(), F.desc("rows"), "symbol")


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def written(posts: DataFrame, folder: str, mark: str = "posts") -> None:
    """The reports of a collection, in the order of (date, id) over all files of each: an index as CSV, the posts as JSON
    lines and as Markdown. ``posts`` has id, date, author, title, url, text and images (an array)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = posts.withColumns({"_date": blank("date"), "_id": blank("id")})
    keys = [F.col("_date").asc(), F.col("_id").asc()]
    pictures = F.coalesce(F.col("images"), F.array().cast(posts.schema["images"].dataType))
    index = rows.select("_date", "_id", blank("author").alias("author"), blank("title").alias("title"), F.length(blank("text")).alias("chars"), F.size(pictures).alias("images"), blank("url").alias("url"))
    ranged = index.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.select(F.col("_date").alias("date"), "author", "title", "chars", "images", "url").write.mode("overwrite").option("header", True).csv(f"{folder}/index")
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_date", "_id").write.mode("overwrite").json(f"{folder}/{mark}")
    shown = F.when(F.size(pictures) > 0, F.concat(F.lit("图片链接: "), F.array_join(pictures, " "), F.lit("\n\n"))).otherwise("")
    text = F.concat(F.lit("## "), F.col("_date"), F.lit(" | "), blank("title"), F.lit("\n\n原文: "), blank("url"), F.lit("\n\n"), blank("text"), F.lit("\n\n"), shown, F.lit("---\n"))
    rows.select("_date", "_id", text.alias("value")).repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.mode("overwrite").text(f"{folder}/markdown")


def as_json(**sections: DataFrame) -> DataFrame:
    """One row, ``report``: the sections as JSON. A section called ``total...`` is one row and an object, others are lists in the order of their
    first column; sections are summaries, so keep them small."""
    out = None
    for name, df in sections.items():
        one = df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias("_rows"))
        one = one.select(F.struct(F.col("_rows")[0].alias(name)) if name.startswith("total") else F.struct(F.col("_rows").alias(name))).toDF(f"_{name}")
        out = one if out is None else out.join(one, F.lit(True))
    return out.select(F.to_json(F.struct(*(F.col(f"_{n}.{n}").alias(n) for n in sections))).alias("report"))
