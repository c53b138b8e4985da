"""Differential check of a Spark plan against its DuckDB oracle.

Row count, column names and an order-insensitive hash of the values.  Floats
are rounded to 6 decimals before hashing; dates/timestamps compare as ISO
text.  Used by the test-suite; it reads the same parquet files on both sides.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from tessera.sources.tables import TABLES, table_path


@dataclass
class CheckResult:
    name: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    hash_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.spark_rows == self.oracle_rows and self.columns_match and self.hash_match


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def run_oracle(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> CheckResult:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duckdb_connection(sf_dir)
    o_cols, o_rows = run_oracle(con, sql)
    cols_ok = sorted(s_cols) == sorted(o_cols)
    hash_ok = cols_ok and rows_digest(s_cols, s_rows) == rows_digest(o_cols, o_rows)
    detail = ""
    if not cols_ok:
        detail = f"spark cols {s_cols} vs oracle {o_cols}"
    elif not hash_ok:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        ss = sorted("\x1f".join(_norm(r[i]) for i in order_s) for r in s_rows)
        oo = sorted("\x1f".join(_norm(r[i]) for i in order_o) for r in o_rows)
        only_s = sorted(set(ss) - set(oo))[:3]
        only_o = sorted(set(oo) - set(ss))[:3]
        detail = f"cols {sorted(s_cols)}; spark-only {only_s}; oracle-only {only_o}"
    return CheckResult(name, len(s_rows), len(o_rows), cols_ok, hash_ok, detail)
