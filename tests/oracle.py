"""Compare a query's rows with those of its SQL text in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def normal(value):
    """One spelling per value, whichever engine it comes from."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return f"{value:.2f}" if value != value.to_integral_value() or value.as_tuple().exponent < 0 else int(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns and rows agree, otherwise what differs."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; "
        f"extra {list(extra.items())[:8]}; missing {list(missing.items())[:8]}"
    )
