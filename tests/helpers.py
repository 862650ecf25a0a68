"""Comparing a Spark result with DuckDB's rows."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return str(v.tolist()) if hasattr(v, "tolist") else v


def bag(rows):
    return Counter(tuple(map(plain, r)) for r in rows)


def same(df, con, sql):
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(f'"{c}"' for c in cols)} FROM ({sql})").fetchall()
    got = df.select(*cols).collect()
    a, b = bag(map(tuple, got)), bag(want)
    assert a == b, (list((a - b).elements())[:3], list((b - a).elements())[:3])
    return len(got)
