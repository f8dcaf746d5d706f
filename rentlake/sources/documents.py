"""Document collections: load, replace and find."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlake.sources.files import read_json_arrays


def read_documents(
    spark: SparkSession,
    source: str | None = None,
    schema: T.StructType | str | None = None,
    fmt: str = "json",
    **options,
) -> DataFrame:
    """A collection as a DataFrame, from a folder or through a connector's format name."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source) if source is not None else reader.load()


def replace_collections(
    spark: SparkSession,
    files: Mapping[str, str],
    dest: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
) -> dict[str, int]:
    """Replace each named collection under `dest` by the documents of its JSON file(s).

    Running it again gives the same collections. Returns the documents per collection,
    counted from what was written.
    """
    schemas = schemas or {}
    counts = {}
    for name, path in files.items():
        target = f"{dest.rstrip('/')}/{name}"
        documents = read_json_arrays(spark, path, schemas.get(name))
        documents.write.mode("overwrite").parquet(target)
        counts[name] = spark.read.schema(documents.schema).parquet(target).count()
    return counts


# Comparison names of a find filter and the Spark predicate each one stands for.
COMPARISONS = {
    "$eq": lambda field, value: field.isNull() if value is None else field.eqNullSafe(F.lit(value)),
    "$ne": lambda field, value: field.isNotNull() if value is None else ~field.eqNullSafe(F.lit(value)),
    "$gt": lambda field, value: field > F.lit(value),
    "$gte": lambda field, value: field >= F.lit(value),
    "$lt": lambda field, value: field < F.lit(value),
    "$lte": lambda field, value: field <= F.lit(value),
    "$in": lambda field, values: field.isin(list(values)),
    "$nin": lambda field, values: field.isNull() | ~field.isin(list(values)),
    "$exists": lambda field, wanted: field.isNotNull() if wanted else field.isNull(),
}


def matches(conditions: Mapping[str, object]) -> Column:
    """The Spark predicate of a find filter: every entry must hold.

    An entry is `field: value`, `field: {comparison: value, ...}`, or `$and` / `$or`
    with a list of filters.
    """
    parts: list[Column] = [F.lit(True)]
    for field, wanted in conditions.items():
        if field == "$and":
            parts += [matches(c) for c in wanted]
        elif field == "$or":
            parts.append(reduce(lambda a, b: a | b, [matches(c) for c in wanted]))
        elif isinstance(wanted, Mapping):
            parts += [COMPARISONS[name](F.col(field), value) for name, value in wanted.items()]
        else:
            parts.append(COMPARISONS["$eq"](F.col(field), wanted))
    return reduce(lambda a, b: a & b, parts)


def document_find(
    documents: DataFrame,
    conditions: Mapping[str, object] | Column | None = None,
    projection: Mapping[str, int] | Sequence[str] | None = None,
    sort: str | Sequence[tuple[str, int]] | None = None,
) -> DataFrame:
    """Documents that meet `conditions`, cut to `projection`, in `sort` order.

    Each argument works on its own; none of them needs the others. A projection is a
    list of fields, `{field: 1}` to keep or `{field: 0}` to leave out; a sort is a
    field name or (field, 1 or -1) pairs.
    """
    found = documents
    if conditions is not None:
        found = found.where(matches(conditions) if isinstance(conditions, Mapping) else conditions)
    if sort:
        pairs = [(sort, 1)] if isinstance(sort, str) else sort
        found = found.orderBy(*[F.col(f).asc() if way > 0 else F.col(f).desc() for f, way in pairs])
    if projection:
        if not isinstance(projection, Mapping):
            return found.select(*projection)
        kept = [f for f, flag in projection.items() if flag]
        found = found.select(*kept) if kept else found.drop(*projection)
    return found
