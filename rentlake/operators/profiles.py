"""Table profiles from stored sketches: one state for each part of a table, merged without reading it again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_K = 12  # HyperLogLog registers: 2 ** 12, a standard error of 1.6 %
RANK_ERROR = 0.02  # of a quantile, with the default size of a quantile sketch
QUANTILES = (0.25, 0.5, 0.75)


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _countable(value: Column, kind: T.DataType) -> Column:
    return value if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else value.cast("string")


def profile_state(df: DataFrame, part: str) -> DataFrame:
    """One row for each value of `part`: what a profile of those rows alone would need.

    For the column at place i: values set, smallest and largest one in the column's own
    type, a sketch of its distinct values, and one of its quantiles if it is a number. One
    pass over all columns; what a task has of a part is combined before the shuffle. Write
    it partitioned by `part`, a new part at a time.
    """
    totals = [F.count(F.lit(1)).alias("n_rows")]
    for i, field in enumerate(f for f in df.schema if f.name != part):
        value = F.col(f"`{field.name}`")
        totals += [
            F.count(value).alias(f"filled_{i}"),
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
            F.hll_sketch_agg(_countable(value, field.dataType), LOG_K).alias(f"distinct_{i}"),
        ]
        if _is_number(field.dataType):
            totals.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"quantiles_{i}"))
    return df.groupBy(F.col(part)).agg(*totals)


def merged_profile(state: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The profile of all parts whose states are given: column_name, data_type, n_rows, n_nulls,
    n_distinct, min_value, max_value, quantiles.

    `fields` are the profiled table's, without `part`, in their order. `n_distinct` and
    `quantiles` (at QUANTILES, as doubles, NULL for other columns) are estimates; all else
    is exact. Without a state there are no rows of the table.
    """
    merged = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    for i, field in enumerate(fields):
        merged += [
            F.coalesce(F.sum(f"filled_{i}"), F.lit(0)).alias(f"filled_{i}"),
            F.min(f"min_{i}").cast("string").alias(f"min_{i}"),
            F.max(f"max_{i}").cast("string").alias(f"max_{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{i}")).alias(f"distinct_{i}"),
        ]
        if _is_number(field.dataType):
            merged.append(F.kll_merge_agg_double(f"quantiles_{i}").alias(f"quantiles_{i}"))
    rows = []
    for i, field in enumerate(fields):
        quantiles = F.lit(None).cast("array<double>")
        if _is_number(field.dataType):
            sketch = F.col(f"quantiles_{i}")
            each = [F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in QUANTILES]
            quantiles = F.when(F.col(f"filled_{i}") > 0, F.array(*each))
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("n_rows"),
                (F.col("n_rows") - F.col(f"filled_{i}")).alias("n_nulls"),
                F.coalesce(F.col(f"distinct_{i}"), F.lit(0)).alias("n_distinct"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
                quantiles.alias("quantiles"),
            )
        )
    return state.agg(*merged).select(F.inline(F.array(*rows)))
