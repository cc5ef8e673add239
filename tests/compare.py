"""Run a registered query and its SQL, and compare all values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_text(v) for v in row) for row in frame.itertuples(index=False, name=None))


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(float(f"{value:.10g}"))
    if hasattr(value, "dtype") and value.dtype.kind in "iu":
        return repr(float(value))
    if isinstance(value, bool) or type(value).__name__ in ("bool", "bool_"):
        return str(bool(value))
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    mine = query(spark, sf_dir)
    got = mine.toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return [f"rows {len(a)} != {len(b)}"]
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    kinds = {
        (c, got[c].dtype.kind, want[c].dtype.kind)
        for c in got.columns
        if got[c].dtype.kind != want[c].dtype.kind and "O" not in (got[c].dtype.kind, want[c].dtype.kind)
    }
    out = [f"{len(wrong)} rows differ, first {wrong[0]}"] if wrong else []
    return out + [f"kinds {kinds}"] if kinds else out
