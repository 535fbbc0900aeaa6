"""Compare a registered query with its SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import collections
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expected = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: spark-only {set(df.columns) - set(names)}, sql-only {set(names) - set(df.columns)}"
    order = sorted(df.columns)
    got = [tuple(_cell(r[c]) for c in order) for r in df.collect()]
    idx = [names.index(c) for c in order]
    want = [tuple(_cell(r[i]) for i in idx) for r in expected]
    a, b = collections.Counter(got), collections.Counter(want)
    if a == b:
        return None
    extra, missing = list((a - b).elements()), list((b - a).elements())
    return (
        f"rows {len(got)} vs {len(want)}; {len(extra)} only in spark, {len(missing)} only in sql\n{order}\n"
        + "\n".join(f"+ {r}" for r in sorted(extra, key=str)[:4])
        + "\n"
        + "\n".join(f"- {r}" for r in sorted(missing, key=str)[:4])
    )
