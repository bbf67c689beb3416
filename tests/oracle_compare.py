"""Compare a Spark DataFrame with a DuckDB query over the driver tables.

Columns are matched by name; rows are compared as sorted multisets. Floats are compared
exactly after the rounding both sides apply, or with ``tol`` when given.
"""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) if tol else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, tol)) for k, x in v.items()))
    return v


def rows_of(records, cols, tol):
    return sorted((tuple(_norm(r[c], tol) for c in cols) for r in records), key=repr)


def compare(spark_df, sql: str, sf_dir: str, tol: bool = False, con=None):
    """Return (ok, message)."""
    con = con or duck(sf_dir)
    sp = [r.asDict(recursive=True) for r in spark_df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    dk = [dict(zip(names, row)) for row in res.fetchall()]
    scols = sorted(spark_df.columns)
    if scols != sorted(names):
        return False, f"columns differ: spark {scols} vs sql {sorted(names)}"
    if len(sp) != len(dk):
        return False, f"row counts differ: spark {len(sp)} vs sql {len(dk)}"
    a, b = rows_of(sp, scols, tol), rows_of(dk, scols, tol)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark {bad[0][0]} vs sql {bad[0][1]}"
    return True, f"{len(sp)} rows match"
