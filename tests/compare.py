"""A Spark result beside DuckDB's, as sorted lists of plain values."""

import datetime as dt

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return v


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in records)


def oracle(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def assert_same(df, sql, sf=SF):
    columns, records = oracle(sql, sf)
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, records)
