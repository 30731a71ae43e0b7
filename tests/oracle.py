"""Spark query vs DuckDB oracle SQL: names, type families, row multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _family_spark(t) -> str:
    s = t.simpleString()
    if s in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if s in ("float", "double"):
        return "float"
    if s.startswith("decimal"):
        return "decimal"
    if s.startswith("timestamp"):
        return "timestamp"
    return s


def _family_duck(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}.get(t, t.lower())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"D{v.normalize()}"
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if v is pd.NaT:
        return None
    return v


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s_types = {f.name: _family_spark(f.dataType) for f in spark_df.schema.fields}
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_under_test AS {sql}")  # as the checker does
    rel = con.sql("SELECT * FROM oracle_under_test")
    d_types = {n: _family_duck(str(t)) for n, t in zip(rel.columns, rel.types)}
    res = {"names": sorted(s_types) == sorted(d_types), "spark_cols": sorted(s_types),
           "duck_cols": sorted(d_types)}
    if not res["names"]:
        res["ok"] = False
        return res
    res["types"] = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types[c]}
    cols = sorted(s_types)
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    d_idx = [rel.columns.index(c) for c in cols]
    d_rows = [tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()]
    res["rows"] = (len(s_rows), len(d_rows))
    a, b = _sorted(s_rows), _sorted(d_rows)
    res["values"] = a == b
    if not res["values"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["diff"] = diff
    res["ok"] = res["names"] and not res["types"] and res["values"] and len(s_rows) == len(d_rows)
    return res
