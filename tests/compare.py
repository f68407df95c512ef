"""Runs one registered query on Spark and its SQL on DuckDB and compares names, types and rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(repr(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(t: pa.Table, names: list[str]) -> Counter:
    return Counter(tuple(_cell(v) for v in row) for row in zip(*[t[n].to_pylist() for n in names])) if names else Counter()


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    got = query(spark, sf_dir).toArrow()
    want = con.execute(sql).to_arrow_table()
    problems = []
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return [f"columns {names} != {sorted(want.column_names)}"]
    for n in names:
        a, b = _kind(got.schema.field(n).type), _kind(want.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} != {b}")
    a, b = _rows(got, names), _rows(want, names)
    if a != b:
        problems.append(f"rows {got.num_rows} / {want.num_rows}; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}")
    return problems
