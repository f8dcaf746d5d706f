"""Files taken in once by what they hold, whatever they are called."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rentlake.sources import salvage
from rentlake.streaming.ingest import append_to_table

# By default the source passes over files a week older than the newest one it knows.
ANY_AGE = "36500d"


def stream_contents(
    spark: SparkSession, path: str, remember: str = "30 days", bytes_per_trigger: int | None = None
) -> DataFrame:
    """New contents of a folder as a stream: text, source_file, receipt_time, digest.

    A file whose bytes were seen before, in this batch or an earlier one, is left out. The
    digests are the keys of the stream's state; one is forgotten `remember` after its file
    was received. Time is that of receipt, so that nothing is ever late, however old a file
    says it is; the source remembers all paths for that. Of files alike in one batch any
    one may be the one that stays. Texts are shuffled once, by digest.
    """
    reader = spark.readStream.option("wholetext", True).option("maxFileAge", ANY_AGE)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    files = reader.text(path).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("receipt_time"),
        F.sha2(F.col("value").cast("binary"), 256).alias("digest"),
    )
    return files.withWatermark("receipt_time", remember).dropDuplicatesWithinWatermark(["digest"])


def ingest_contents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    table: str,
    checkpoint: str,
    location: str | None = None,
    remember: str = "30 days",
    bytes_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append every element of every new content to a table, good and bad ones, exactly once.

    The table has `row` for good elements and `reason` and `element` for bad ones, with
    file, position, digest and time of receipt (see `sources.salvage`).
    """
    found = salvage.elements(stream_contents(spark, path, remember, bytes_per_trigger), schema)
    return append_to_table(found, table, checkpoint, location)
