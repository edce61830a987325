"""Runs SQL in DuckDB over the carrier tables, and compares its rows with Spark's."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def _value(x):
    if isinstance(x, float):
        return None if x != x else round(x, 6)
    return str(x)[:19] if hasattr(x, "year") else x


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in values), key=lambda r: tuple(map(str, r)))


def same(spark_df, connection, sql):
    cursor = connection.execute(sql)
    theirs = [d[0] for d in cursor.description]
    assert sorted(spark_df.columns) == sorted(theirs)
    mine = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    assert mine == rows(theirs, cursor.fetchall())
    return len(mine)
