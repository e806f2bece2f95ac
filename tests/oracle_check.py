"""Run a registered query and its SQL oracle side by side (DuckDB).

Used by the tests; mirrors the external check: same column names, same row
count, same multiset of rows (doubles compared after rounding).
"""

from __future__ import annotations

import math

import duckdb

from framewell.plans.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        try:
            v = v.replace(tzinfo=None)
        except TypeError:
            pass
        return v.isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


# Spark type name -> DuckDB type name of the same values
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
          "date": "DATE", "binary": "BLOB", "float": "FLOAT"}


def type_mismatches(sdf, sql: str, con) -> dict:
    """Columns whose Spark and DuckDB types differ (by the table above)."""
    s = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [x[0] for x in res.description]
    d_raw = res.fetchall()
    idx = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_raw]
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    try:
        a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    except TypeError:
        a, b = sorted(map(repr, s_rows)), sorted(map(repr, d_rows))
    out["values_match"] = a == b
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    if not out["values_match"]:
        diff_a = [r for r in a if r not in set(b)][:3] if len(a) < 200000 else []
        diff_b = [r for r in b if r not in set(a)][:3] if len(b) < 200000 else []
        out["spark_only"], out["oracle_only"] = diff_a, diff_b
    types = type_mismatches(sdf, sql, con)
    out["types_match"] = not types
    if types:
        out["type_mismatches"] = types
    out["ok"] = out["cols_match"] and out["values_match"] and out["types_match"] and len(s_rows) == len(d_rows)
    return out
