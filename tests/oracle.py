"""Compares queries with their SQL in DuckDB."""

import decimal
import math

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir=SF):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def same_rows(df, sql, sf_dir=SF):
    columns = sorted(df.columns)
    got = sorted(repr([plain(x) for x in row]) for row in df.select(*columns).collect())
    found = connect(sf_dir).sql(sql)
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(row[i]) for i in at]) for row in found.fetchall())
