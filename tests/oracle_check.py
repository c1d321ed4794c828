"""Compare a query with its SQL statement the way results are judged: names, rows, values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v)
    return str(v) if not isinstance(v, int) else v


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def differences(df, con, sql) -> list[str]:
    """Empty when both sides agree."""
    a_names, a = spark_rows(df)
    b_names, b = sql_rows(con, sql)
    if a_names != b_names:
        return [f"columns {a_names} != {b_names}"]
    out = []
    if sum(a.values()) != sum(b.values()):
        out.append(f"rows {sum(a.values())} != {sum(b.values())}")
    for label, extra in (("spark only", a - b), ("sql only", b - a)):
        for row in list(extra)[:3]:
            out.append(f"{label}: {row}")
    return out
