"""Files read as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header row; types are inferred (one extra pass) unless a schema is given."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_arrays(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """JSON files that each hold one array of objects: one row per object.

    Without a schema the columns are inferred and come in alphabetical order. Such
    a file cannot be split, so many moderate files read faster than one huge one.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(with_corrupt(schema) if keep_corrupt else schema)
    return reader.json(path)


def with_corrupt(schema: T.StructType | str) -> T.StructType:
    """The schema plus the column that receives text which could not be parsed."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Path, name, size and modification time of the files in a folder.

    Only the listing is used: the content column is pruned, no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
