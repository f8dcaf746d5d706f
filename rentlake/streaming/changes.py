"""A derived table that follows a stream of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlake.operators.changes import apply_events, key_events, latest_events


def follow_changes(
    changes: DataFrame, path: str, checkpoint: str, key: str, values: Sequence[str], null_safe: bool = False
) -> None:
    """Reduce every batch of a change stream to the last events per key and keep them.

    Batch N goes to its own folder `batch=N`, replaced if the batch is repeated, so
    each change counts once even when executors or the driver are lost. The cost of a
    batch follows its size, not the size of the derived table.
    """

    def keep(batch: DataFrame, number: int) -> None:
        last = latest_events(key_events(batch, key, values, null_safe), key, values)
        last.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        changes.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_table(spark: SparkSession, base: DataFrame, path: str, key: str, values: Sequence[str]) -> DataFrame:
    """The derived table now: `base` with all kept events applied.

    Write it out as the next base from time to time, and then start a new folder of
    events; never overwrite the base that is being read.
    """
    fields = {f.name: f.dataType.simpleString() for f in base.schema}
    return apply_events(base, _kept_events(spark, base, path, key, values), key, values)


def _kept_events(spark: SparkSession, base: DataFrame, path: str, key: str, values: Sequence[str]) -> DataFrame:
    fields = {f.name: f.dataType.simpleString() for f in base.schema}
    columns = [f"`{key}` {fields[key]}", "seq BIGINT", "kind STRING", f"source {fields[key]}"]
    columns += [f"`{v}` {fields[v]}" for v in values]
    events = spark.read.schema(", ".join([*columns, "batch BIGINT"])).parquet(path)
    return events.select(key, "seq", "kind", "source", *values)


def compact_events(
    spark: SparkSession, base: DataFrame, path: str, target: str, key: str, values: Sequence[str]
) -> None:
    """Write all kept events of `path`, reduced to the last ones per key, as one batch of a new folder.

    Nothing that is being read is overwritten: readers change over to `target`, and
    `follow_changes` goes on there under its checkpoint.
    """
    kept = latest_events(_kept_events(spark, base, path, key, values), key, values)
    kept.write.mode("errorifexists").parquet(f"{target}/batch=-1")


def release_version(table: DataFrame, root: str, version: int) -> str:
    """Write the table as a new version next to the older ones; returns its folder."""
    target = f"{root}/version={version}"
    table.select(*[F.col(c) for c in table.columns]).write.mode("errorifexists").parquet(target)
    return target
