"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the same query as SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(rows: list[tuple]) -> str:
    """Rows as the list of an SQL VALUES clause."""

    def one(x) -> str:
        if x is None:
            return "null"
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        if isinstance(x, (list, tuple)):
            return "[" + ", ".join(map(one, x)) + "]"
        return str(x).lower() if isinstance(x, bool) else repr(x)

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def pick(by: str, *options: str | None) -> str:
    """A CASE over the remainder of a column, in the SQL that Spark and DuckDB share; ``{}`` in an option is SQL."""
    def text(o: str | None) -> str:
        return "null" if o is None else "concat(" + ", ".join(p if i % 2 else f"'{p}'" for i, p in enumerate(o.replace("{", "}").split("}"))) + ", '')"

    return f"case {by} % {len(options)} " + " ".join(f"when {i} then {text(o)}" for i, o in enumerate(options)) + " end"
