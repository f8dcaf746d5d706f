"""Dimension tables, whichever source delivers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentlake.sources import documents, files, jdbc, tables

READERS = {
    "csv": files.read_csv,
    "json": files.read_json_arrays,
    "documents": documents.read_documents,
    "jdbc": jdbc.read_jdbc_table,
    "query": jdbc.read_jdbc_query,
}


def read_dimension(spark: SparkSession, source: str, *args, **options) -> DataFrame:
    """A dimension from 'csv', 'json', 'documents', 'jdbc', 'query' or a catalog 'table'."""
    if source == "table":
        return spark.table(*args)
    return READERS[source](spark, *args, **options)


def load_dimension(
    spark: SparkSession, table: str, source: str, *args, location: str | None = None, **options
) -> DataFrame:
    """Read a dimension and overwrite its table with it."""
    return tables.replace_table(read_dimension(spark, source, *args, **options), table, location)
