"""Run a registered query in Spark and its oracle in DuckDB, compare results.

Comparison is order-insensitive over whole rows: same column names, same
row count, same multiset of rows (floats compared to 9 significant digits).
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    return v


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(v) for v in r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = [d_cols.index(c) for c in s_cols] if s_cols != d_cols else None
    if order is not None:
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"rows differ; spark-only {only_s} duck-only {only_d}"
    return True, f"{len(s_rows)} rows"
