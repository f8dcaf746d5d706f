"""Table profile, pivot table and ordered preview."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, position, type and nullability of every column (metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN")


def table_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, rows, NULLs, distinct values, smallest and largest value.

    Approximate: one aggregation pass for all columns, one row per task shuffled.
    Exact: each column is first counted per value (combined before the shuffle),
    so the scan reads every column once and no row is widened or multiplied.
    """
    return _exact_profile(df) if exact else _approximate_profile(df)


def _exact_profile(df: DataFrame) -> DataFrame:
    def one(field) -> DataFrame:
        value = F.col(f"`{field.name}`")
        counted = df.select(value.alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        return counted.agg(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
            F.count("v").alias("n_distinct"),
            F.min("v").cast("string").alias("min_value"),
            F.max("v").cast("string").alias("max_value"),
        )

    return reduce(DataFrame.unionByName, [one(f) for f in df.schema])


def _approximate_profile(df: DataFrame) -> DataFrame:
    totals: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    rows: list[Column] = []
    for i, field in enumerate(df.schema):
        value = F.col(f"`{field.name}`")
        totals += [
            F.count(value).alias(f"filled_{i}"),
            F.approx_count_distinct(value).alias(f"distinct_{i}"),
            F.min(value).cast("string").alias(f"min_{i}"),
            F.max(value).cast("string").alias(f"max_{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("n_rows"),
                (F.col("n_rows") - F.col(f"filled_{i}")).alias("n_nulls"),
                F.col(f"distinct_{i}").alias("n_distinct"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
            )
        )
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: Column) -> DataFrame:
    """Pivot table of sums; naming the column values avoids a pass to find them."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.sum(measure))


def preview(df: DataFrame, n: int = 5, order: Sequence[Column | str] = ()) -> DataFrame:
    """The first `n` rows, in `order` if given (kept per task, never sorted whole)."""
    return (df.orderBy(*order) if order else df).limit(n)
