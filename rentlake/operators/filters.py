"""Bloom filters of key columns: most rows are told apart without moving them.

A filter is a small table of 64-bit words. A key has one word, and four bits in it, by two
hashes; a row whose bits are not all set has no such key for certain. The rest are
candidates, and an exact join decides on them, so that only candidates are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.operators.joins import lookup_join
from rentlake.workspace import Workspace

BITS_PER_KEY = 16
WORDS_MOST = 1 << 21  # words that are broadcast: 16 bytes each, 32 MB, some 8 million keys
BITS = 4  # set for each key


@dataclass(frozen=True)
class KeyFilter:
    """The words of a set of keys; `words` of them, those without a key left out."""

    table: DataFrame
    words: int

    def split(self, df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        """The rows of `df` that may have a key of the set, and those that have none for certain (NULLs too).

        Both read `df`, which should be a stored table.
        """
        marked = df.withColumn("_word", _word(F.col(column), self.words)).join(F.broadcast(self.table), "_word", "left")
        mask = _mask(F.col(column))
        may = F.col(column).isNotNull() & F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
        return marked.where(may).select(*df.columns), marked.where(~may).select(*df.columns)


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    spread = F.xxhash64(F.lit(1), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(keys: DataFrame, column: str) -> KeyFilter | None:
    """The filter of a key column, sized from a count of its rows; None if that is too many to broadcast.

    One word may hold several keys, so the words are combined before the shuffle.
    """
    keys = keys.select(column).where(F.col(column).isNotNull())
    words = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    if words > WORDS_MOST:
        return None
    path = Workspace(keys.sparkSession).path("key_filter")
    table = keys.groupBy(_word(F.col(column), words).alias("_word")).agg(F.bit_or(_mask(F.col(column))).alias("_bits"))
    table.write.parquet(path)
    return KeyFilter(keys.sparkSession.read.schema(table.schema).parquet(path), words)


def filtered_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """`integrity.orphans` with a filter of the parent's keys in front.

    What the filter turns away is an orphan already; only the rest is joined. Worth its
    count where the parent is too large to be broadcast and many references are broken.
    """
    keys = parent.select(F.col(pk).alias(fk))
    found = key_filter(keys, fk)
    rows = child.where(F.col(fk).isNotNull())
    if found is None:
        return lookup_join(rows, keys, fk, "left_anti")
    may, without = found.split(rows, fk)
    return without.unionByName(lookup_join(may, keys, fk, "left_anti"))


def filtered_set_null(child: DataFrame, fk: str, deleted: DataFrame, pk: str) -> DataFrame:
    """`integrity.set_null_on_delete` with a filter of the deleted keys in front: other rows stay where they are."""
    gone = deleted.select(F.col(pk).alias(fk)).distinct()
    found = key_filter(gone, fk)
    may, without = found.split(child, fk) if found else (child, child.limit(0))
    return without.unionByName(cleared(may, fk, gone))


def cleared(child: DataFrame, fk: str, gone: DataFrame) -> DataFrame:
    """`child` with NULL where `fk` is one of `gone`, whose keys are distinct: one join for both kinds of rows."""
    joined = lookup_join(child, gone.withColumn("_gone", F.lit(True)), fk, "left")
    kept = F.when(F.col("_gone").isNull(), F.col(fk)).alias(fk)
    return joined.select(*[kept if c == fk else c for c in child.columns])
