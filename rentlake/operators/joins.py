"""Joins of a large table to a table it looks up, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITTABLE = ("inner", "left", "left_outer", "left_semi", "left_anti")
ADAPTIVE = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
ADAPTIVE_STREAMS = "spark.sql.adaptive.streaming.stateless.enabled"


def skew_join_on(spark: SparkSession) -> bool:
    """Does this session split skewed join partitions by itself?"""
    return all(spark.conf.get(key, "true") == "true" for key in ADAPTIVE)


def require_adaptive_streams(spark: SparkSession) -> None:
    """Refuse a stream join in a session that would leave its hot keys in one task."""
    for key in (*ADAPTIVE, ADAPTIVE_STREAMS):
        try:
            on = spark.conf.get(key) == "true"
        except PySparkException:  # a version that does not know the setting
            on = False
        if not on:
            raise ValueError(f"set {key} to true: stream joins count on it to split hot keys")


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def hot_keys(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The key values that hold more than one in P of the rows, P being the shuffle partitions.

    A smaller key is no larger than an even partition. There are fewer than P such keys
    whatever the input. Counts are combined before the shuffle and only the key columns
    are read.
    """
    keys = [on] if isinstance(on, str) else list(on)
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * partitions_of(df.sparkSession) > total).select(*keys)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    keys_in: DataFrame | None = None,
) -> DataFrame:
    """Join `fact` to `dim` on equally named columns.

    * Catalyst, or adaptive execution from the measured size, broadcasts a `dim` below the
      session's threshold; nothing is hinted here. The skewed partitions of a shuffle join
      are split by adaptive execution;
    * a stream is refused where the session does not do so for streams;
    * a batch join in a session without adaptive skew handling salts hot (and NULL) keys
      over all shuffle partitions. They are counted in `keys_in`, the stored table from
      which the keys of `fact` come, so that earlier joins are not run twice.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in SPLITTABLE:
        raise ValueError(f"cannot spread hot keys of a {how} join")
    if fact.isStreaming:
        require_adaptive_streams(fact.sparkSession)
    elif not skew_join_on(fact.sparkSession):
        return salted_join(fact, dim, keys, how, hot_keys(fact if keys_in is None else keys_in, keys))
    joined = fact.join(dim, keys, how)
    # A semi or anti join gives the rows of `fact` as they were, not the keys first.
    return joined.select(*fact.columns) if how in ("left_semi", "left_anti") else joined


def salted_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str, hot: DataFrame) -> DataFrame:
    """Shuffle join that deals the rows of each hot key of `fact` to all partitions.

    The matching `dim` rows are copied once per shuffle partition. `hot` comes from
    `hot_keys` and has fewer rows than there are shuffle partitions, which makes its
    broadcast safe. The salt mixes the row's hash with its map task, so identical copies
    spread too, and a retried task salts its rows alike.
    """
    if how not in SPLITTABLE:
        raise ValueError(f"cannot spread hot keys of a {how} join")
    salts = partitions_of(fact.sparkSession)
    flags = F.broadcast(hot.select(*keys).distinct().withColumn("_hot", F.lit(True)))
    unmatchable = F.lit(False)
    for key in keys:
        unmatchable = unmatchable | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*[fact[c] for c in fact.columns]) + F.spark_partition_id(), F.lit(salts)).cast("int")
    left = (
        fact.withColumn("_spread", spread)
        .join(flags, list(keys), "left")
        .withColumn("_salt", F.when(F.col("_hot") | unmatchable, F.col("_spread")).otherwise(F.lit(0)))
        .drop("_hot", "_spread")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.join(flags, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    joined = left.join(right, [*keys, "_salt"], how).drop("_salt")
    return joined.select(*fact.columns) if how in ("left_semi", "left_anti") else joined
