"""Compare a Spark result with the DuckDB result of its SQL check."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "~null"
        if isinstance(v, pd.Timestamp):
            return v.to_datetime64().astype("datetime64[us]").item().isoformat(" ")
        if hasattr(v, "isoformat"):
            return v.isoformat()
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v))
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def differences(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(duck_frame.columns)}"
    ours, theirs = _rows(spark_frame), _rows(duck_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
