"""Large jobs slice by slice, so that no more than one slice is shuffled and kept on disk at a time.

A slice holds the rows whose key hashes to its number: each row is in exactly one, NULL keys
included. Joins on that key see one slice of both sides, as Catalyst carries the filter over
to the other one. What a slice has shuffled is released before the next one starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 4_000_000
# Every slice reads its input anew, so beyond this number slices grow instead.
MOST = 8
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job go when it is done; else they stay until the driver collects its garbage.

    Streams started within keep to this for good.
    """
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def slices_for(rows: int) -> int:
    """How many slices so many rows are dealt to."""
    return max(1, min(MOST, -(-rows // ROWS)))


def slices(df: DataFrame, key: str, number: int) -> Iterator[DataFrame]:
    for k in range(number):
        yield df.where(F.pmod(F.xxhash64(key), F.lit(number)) == k) if number > 1 else df


def write_in_slices(rows: DataFrame, key: str, number: int, write: Callable[[DataFrame, str], None]) -> None:
    """Call `write(slice, mode)` for one slice after the other.

    The first one overwrites what an earlier attempt has left, the others append to it.
    """
    with shuffles_released(rows.sparkSession):
        for k, part in enumerate(slices(rows, key, number)):
            write(part, "append" if k else "overwrite")
