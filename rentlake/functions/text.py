"""Text functions and the ordered concatenation of a group's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.workspace import Workspace


def full_name(first: Column | str, last: Column | str) -> Column:
    """`first last`; NULL if either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def capitalise(text: Column | str) -> Column:
    """First letter upper case, everything after it lower case (not per word)."""
    text = _col(text)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def ordered_parts(
    df: DataFrame, keys: Sequence[str], item: str, by: Sequence[str], separator: str, alias: str
) -> DataFrame:
    """Every group's list as numbered pieces: keys, `part`, `alias`.

    Rows are range-partitioned on (keys, by), so a group that holds a large share
    of all rows spreads over many tasks instead of one. The pieces of a group,
    taken in `part` order, are its whole list; no piece outgrows a partition.

    The rows are written first: range-partitioning reads its input twice, and must not
    run what comes before it twice.
    """
    spark, path = df.sparkSession, Workspace(df.sparkSession).path("list_rows")
    rows = df.select(*dict.fromkeys([*keys, item, *by]))
    rows.write.parquet(path)
    placed = spark.read.schema(rows.schema).parquet(path)
    placed = placed.repartitionByRange(*keys, *by).withColumn("part", F.spark_partition_id())
    return placed.groupBy(*keys, "part").agg(_listed(item, by, separator).alias(alias))


def ordered_concat(
    df: DataFrame, keys: Sequence[str], item: str, by: Sequence[str], separator: str, alias: str
) -> DataFrame:
    """Every group's values, sorted by `by` and joined into one text: keys, `alias`.

    NULL values are left out; a group of only NULLs gives NULL. One shuffle on the keys.
    A text is one cell and so limited to 2 GB by Spark, which also bounds what its task
    sorts; longer lists are read as `ordered_parts`.
    """
    return df.groupBy(*keys).agg(_listed(item, by, separator).alias(alias))


def _listed(item: str, by: Sequence[str], separator: str) -> Column:
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    order = ", ".join(f"`{c}`" for c in by)
    return F.expr(f"listagg(`{item}`, '{quoted}') within group (order by {order})")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
