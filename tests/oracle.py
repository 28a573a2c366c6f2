"""Holds a query's rows against DuckDB's for the same files."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


def rows_match(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    want = sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)
    assert got == want
    return len(got)
