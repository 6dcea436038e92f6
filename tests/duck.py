"""Compare a query with its SQL on DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order) for r in values)


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows([tuple(r) for r in df.collect()], df.columns)
    result = connect(sf_dir).execute(sql)
    columns = [x[0] for x in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(result.fetchall(), columns)
