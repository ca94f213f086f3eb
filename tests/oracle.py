"""Compare a registered query with its DuckDB SQL on the same Parquet tables."""

from __future__ import annotations

import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """None if both agree, else what differs."""
    df = query(spark, sf_dir)
    ours = df.collect()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = _rows(df.columns, ours), _rows(columns, theirs)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{name}: {len(ours)} vs {len(theirs)} rows; only ours {only_a}; only theirs {only_b}"
    return None
