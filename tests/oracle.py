"""Compare a registered query with its SQL twin, run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    """One form for equal values of both engines."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(value)
    if isinstance(value, int):
        return value
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def differences(df, con, sql: str) -> str | None:
    """None when both have the same columns and the same bag of rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    place = [names.index(c) for c in order]
    expected = Counter(tuple(plain(r[i]) for i in place) for r in expected_rows)
    found = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    if expected == found:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"{order}: {sum(expected.values())} rows expected, {sum(found.values())} found; "
        f"{sum(missing.values())} missing, e.g. {list(missing)[:3]}; "
        f"{sum(extra.values())} extra, e.g. {list(extra)[:3]}"
    )
