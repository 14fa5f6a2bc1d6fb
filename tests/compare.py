"""Compare a DataFrame with a SQL result: column names, rows, values."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return duck


def _plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def _counted(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def mismatch(df, duck: duckdb.DuckDBPyConnection, sql: str | None) -> str | None:
    """What differs, or None. Without SQL the query only has to run."""
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if df.columns else "no columns"
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    common = sorted(names)
    got = _counted(rows, [df.columns.index(n) for n in common])
    want = _counted(expected, [names.index(n) for n in common])
    if got == want:
        return None if rows else "both sides are empty"
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"rows {len(rows)} vs {len(expected)}; columns {common}\n   only here: {str(extra)[:900]}\n   only SQL:  {str(missing)[:900]}"
