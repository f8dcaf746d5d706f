"""Tables and queries of a database reached over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a JDBC scan is cut into parallel range queries on a numeric or date column.

    Rows outside the bounds are read too, by the first and last query.
    """

    column: str
    lower: int | str
    upper: int | str
    queries: int


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole table. Column pruning and filters are pushed into the database.

    The URL, driver and credentials come from the caller. Without `split` or
    `predicates` one task reads everything, so give one of them for large tables.
    """
    if split and predicates:
        raise ValueError("give either a split or predicates")
    properties = dict(properties or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if split:
        return spark.read.jdbc(
            url,
            table,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.queries,
            properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """The result of a SELECT that runs in the database."""
    select = query.strip().rstrip(";")
    return read_jdbc_table(spark, url, f"({select}) rentlake_query", properties, split)


def jdbc_view(
    spark: SparkSession,
    view: str,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A temporary view over a database table, replaced if it exists."""
    df = read_jdbc_table(spark, url, table, properties, split)
    df.createOrReplaceTempView(view)
    return df
