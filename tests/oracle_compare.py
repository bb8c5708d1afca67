"""Compare a Spark result with its DuckDB oracle (test helper).

Results are small at the test scale factors; both sides are collected and
compared as multisets of rows with columns sorted by name.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def compare(df, con, sql: str) -> tuple[bool, str]:
    spark_cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in spark_cols) for r in df.select(*spark_cols).collect()]
    rel = con.sql(sql)
    duck_cols = list(rel.columns)
    if sorted(duck_cols) != spark_cols:
        return False, f"columns differ: spark={spark_cols} oracle={sorted(duck_cols)}"
    idx = [duck_cols.index(c) for c in spark_cols]
    orows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(rows) != len(orows):
        return False, f"row counts differ: spark={len(rows)} oracle={len(orows)}"
    a, b = Counter(rows), Counter(orows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_o = list((b - a).elements())[:3]
        return False, f"values differ: spark-only={only_s} oracle-only={only_o}"
    return True, f"{len(rows)} rows"
