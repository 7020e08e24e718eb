"""Comparison of a registered query with its SQL in DuckDB."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"create view {t} as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def rows(columns, values):
    return sorted(repr([plain(v) for v in x]) for x in values)


def same(spark, sf_dir: str, query, sql: str) -> None:
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    relation = connect(sf_dir).sql(sql)
    assert columns == sorted(relation.columns)
    want = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert rows(columns, df.select(*columns).collect()) == rows(columns, want)
