"""Tables that cut a plan, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentlake.workspace import Workspace


class Scratch:
    """Parquet tables below `spark.checkpoint.dir`, one fresh folder per operator call.

    A written table survives lost executors and is read column by column. `clear`
    empties a table as soon as nothing that will be returned reads it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.space = Workspace(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.space.path(name))
        return self.spark.read.schema(df.schema).parquet(self.space.path(name))

    def clear(self, *names: str) -> None:
        for name in names:
            self.spark.range(0).write.mode("overwrite").parquet(self.space.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
