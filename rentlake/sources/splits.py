"""Predicates that cut a table into queries of even row counts, planned from keys that are at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the quantiles: ranks are off by one in so many rows at most


def even_predicates(keys: DataFrame, column: str, queries: int, within: str | None = None) -> list[str]:
    """Predicates for `sources.jdbc.read_jdbc_table`: each row of a table meets one of them, and
    each is met by about as many rows.

    `keys` has the key column (whole numbers) of an earlier load, of an index, or of a sample;
    no connection is used. Rows that came since are read too, by the ranges that they fall
    in, the first and last being open; NULLs go with the first. Ranges of equal width would
    put a hot region into one query; these end at quantiles. A key that alone holds more
    than a query's share is one query, or several by the remainder of `within`, a whole
    number that differs between its rows (NULL counts as 0).
    """
    if queries < 2:
        return ["1 = 1"]
    known = keys.select(F.col(column).cast("long").alias("k")).where("k IS NOT NULL")
    shares = [q / queries for q in range(1, queries)]
    bounds = known.agg(F.percentile_approx("k", shares, ACCURACY).alias("b")).first()["b"] or []
    # A bound that is met twice is a key with more than a query's share: fewer of them than there are queries.
    hot = sorted({a for a, b in zip(bounds, bounds[1:], strict=False) if a == b})
    edges = sorted({*bounds, *(h + 1 for h in hot)})
    ranges = _ranges(column, edges, hot)
    if not within or not hot:
        return [text for text, _ in ranges]
    total = max(1, known.count())
    counted = {r["k"]: r["n"] for r in known.where(F.col("k").isin(hot)).groupBy("k").agg(F.count("*").alias("n")).collect()}
    found = []
    for text, key in ranges:
        parts = max(1, round(counted.get(key, 0) * queries / total))
        found += [f"{text} AND ABS(MOD(COALESCE({within}, 0), {parts})) = {r}" for r in range(parts)] if parts > 1 else [text]
    return found


def _ranges(column: str, edges: list[int], hot: list[int]) -> list[tuple[str, int | None]]:
    """Ranges between edges, and the key of those that are one hot key."""
    if not edges:
        return [("1 = 1", None)]
    found: list[tuple[str, int | None]] = [(f"({column} < {edges[0]} OR {column} IS NULL)", None)]
    for low, high in zip(edges, edges[1:], strict=False):
        key = low if low in hot else None
        found.append((f"{column} = {low}" if key is not None else f"{column} >= {low} AND {column} < {high}", key))
    return [*found, (f"{column} >= {edges[-1]}", None)]
