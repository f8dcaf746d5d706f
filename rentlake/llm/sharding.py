"""Shards of nearly equal bytes, cut at splitters sampled by size.

Rows are ordered by a hash of their text, so that equal texts (a group) stand together. Keys
are drawn with a chance that grows with the row's size; every so many of them is a splitter,
and the ranges between splitters hold about equal work. Ranges that still hold more than
OVERFULL times their share are subdivided by a denser draw inside them, until none does:
within a group of copies the order goes on by hashes of the ids, so no group is too large.

Sizes are then added up exactly, range by range, and a shard begins where the sum reaches its
quantile. The law is `bytes`: two shards differ by about twice the GRAIN of a shard, unless
single documents are larger. For that, what is larger than a grain is placed by itself, there
being at most `shards / GRAIN` such groups: the largest first, each into the emptiest shard,
a group as a whole where it fits below the mean and document by document where it does not.
Documents larger than a grain are placed likewise; all others fill up the shards in their
order. So a group stays together unless it is larger than a shard can hold.

Texts are read once, for their size and hashes; `write_shards` reads them a second time to
deal them out. All other steps work on narrow rows; the driver sees splitters, one sum for a
range, and what is larger than a grain.

Edge cases: a null text has no bytes and weighs OVERHEAD; an empty table gives no rows;
repeated rows are kept, each with a slot of its own, and null ids are allowed; with fewer
documents than shards some shards stay empty; other columns are ignored by `assign` and kept
by `write_shards`, whose `shard`, `slot` and `size` take the place of columns of that name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.llm.scratch import Scratch

SHARDS = 24
OVERHEAD = 8  # bytes that a row takes besides its text
GRAIN = 0.01  # of a shard: what is larger is placed by itself
DRAWS = 32  # keys drawn for a range
OVERFULL = 3  # times the mean work of a range
LOWEST = -(1 << 63)

KEY = ("group", "salt", "row")
UNIT = ("group", "unit_salt", "unit_row")


def _sortable(columns: list[np.ndarray]) -> np.ndarray:
    """Three signed numbers as bytes that sort like them."""
    flipped = np.stack([c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], axis=1)
    return np.ascontiguousarray(flipped.astype(">u8")).view("S24").ravel()


@dataclass(frozen=True)
class Splitters:
    """Keys that part the order into ranges."""

    keys: np.ndarray

    @staticmethod
    def of(keys: list[tuple[int, int, int]]) -> Splitters:
        found = np.array(sorted(set(keys)), dtype=np.int64).reshape(-1, 3)
        return Splitters(_sortable([found[:, k] for k in range(3)]))

    def joined(self, other: Splitters) -> Splitters:
        return Splitters(np.unique(np.concatenate([self.keys, other.keys])))

    def range_of(self, *key: str) -> Column:
        """The number of splitters at or below a key."""
        splitters = self.keys

        @F.arrow_udf("int")
        def place(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for columns in batches:
                keys = _sortable([c.to_numpy(zero_copy_only=False) for c in columns])
                yield pa.array(np.searchsorted(splitters, keys, "right").astype(np.int32))

        return place(*key)


def _drawn(rows: DataFrame, work: Column, ranges: int, density: int) -> Splitters:
    """Splitters from keys drawn with a chance that grows with their work; the same ones in a rerun.

    About DRAWS * density keys are drawn for a range. A row of more work than one draw is
    drawn for certain and stands for all of them.
    """
    weight = work * float(DRAWS * density * ranges)
    chance = F.pmod(F.xxhash64(F.lit(density), *KEY), F.lit(1 << 53)) / float(1 << 53)
    found = rows.where(chance < weight).select(*KEY, F.greatest(weight, F.lit(1.0)).alias("weight")).collect()
    keys, at = [], 0.5 * DRAWS * density
    for *key, weight in sorted(map(tuple, found)):
        at += weight
        if at >= DRAWS * density:
            keys.append(tuple(key))
            at %= DRAWS * density
    return Splitters.of(keys)


def find_splitters(rows: DataFrame, ranges: int) -> Splitters:
    """Splitters of about equal work: half a row's share of all bytes, half its share of all rows.

    A row counts for no more than a range, since nothing can split it.
    """
    total = rows.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    work = F.least(F.col("size") / (2.0 * total["size"]) + F.lit(0.5 / total["n"]), F.lit(1.0 / ranges))
    density, splitters = 1, _drawn(rows, work, ranges, 1)
    while True:
        loads = rows.select(splitters.range_of(*KEY).alias("range"), work.alias("work")).groupBy("range")
        full = [r["range"] for r in loads.agg(F.sum("work").alias("work")).where(F.col("work") > OVERFULL / ranges).collect()]
        if not full:
            return splitters
        density *= 2
        inside = rows.withColumn("range", splitters.range_of(*KEY)).where(F.col("range").isin(full)).drop("range")
        splitters = splitters.joined(_drawn(inside, work, ranges, density))


def _emptiest_first(loads: list[int], items: list[tuple[int, bool, tuple]], limit: float) -> tuple[dict, list]:
    """The shard of each (size, divisible, name), largest first, each in the emptiest one, and the
    names of those that can be divided and would lift every shard above the limit."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    placed, left = {}, []
    for size, divisible, name in sorted(items, key=lambda i: (-i[0], i[2])):
        load, shard = heap[0]
        if divisible and load + size > limit:
            left.append(name)
            continue
        heapq.heapreplace(heap, (load + size, shard))
        placed[name], loads[shard] = shard, load + size
    return placed, left


def _filled(loads: list[int], rest: int) -> np.ndarray:
    """Where each shard's part of the rest ends, so that all shards reach one level."""
    order = sorted(loads)
    level = 0.0
    for k in range(1, len(order) + 1):
        level = (rest + sum(order[:k])) / k
        if k == len(order) or level <= order[k]:
            break
    return np.cumsum([max(0.0, level - load) for load in loads])


def narrow(docs: DataFrame) -> DataFrame:
    """What the shards are worked out from: row, doc_id, size, text_crc32, group and salt."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col("_row").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("salt"),
    )


def _placed(rows: DataFrame, shards: int, scratch: Scratch) -> tuple[DataFrame, list[int]]:
    """`rows` with `shard` (null where the order decides) and the key of their unit, and the bytes placed in each shard.

    A unit is a whole group, or a single row of a group that is divided.
    """
    spark = rows.sparkSession
    mean = rows.agg(F.sum("size")).first()[0] / shards
    grain = GRAIN * mean
    # Fewer than shards / GRAIN rows in each of these lists: together they are no larger than the whole.
    sums = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    large = {r["group"]: (r["size"], r["n"]) for r in sums.where(F.col("size") > grain).collect()}

    def giants(groups: list[int]) -> list[tuple[int, bool, tuple]]:
        table = F.broadcast(spark.createDataFrame([(g,) for g in groups], "group long"))
        found = rows.where(F.col("size") > grain).join(table, "group").select("size", *KEY).collect()
        return [(size, False, tuple(key)) for size, *key in found]

    loads = [0] * shards
    alone = [g for g, (size, n) in large.items() if n == 1 or size > mean]
    together = [(size, True, (g,)) for g, (size, n) in large.items() if n > 1 and size <= mean]
    placed, left = _emptiest_first(loads, [*giants(alone), *together], mean)
    rest = [g for (g,) in left]
    single, _ = _emptiest_first(loads, giants(rest), mean)
    single |= {name: s for name, s in placed.items() if len(name) == 3}
    groups = [(name[0], s, False) for name, s in placed.items() if len(name) == 1] + [(g, None, True) for g in (*alone, *rest)]
    table = spark.createDataFrame(groups, "group long, group_shard int, divided boolean")
    singles = spark.createDataFrame([(*key, s) for key, s in single.items()], "group long, salt long, row long, row_shard int")
    marked = rows.join(F.broadcast(table), "group", "left").join(F.broadcast(singles), list(KEY), "left")
    split = F.coalesce("divided", F.lit(False))
    marked = marked.select(
        *rows.columns,
        F.coalesce("row_shard", "group_shard").alias("shard"),
        F.when(split, F.col("salt")).otherwise(LOWEST).alias("unit_salt"),
        F.when(split, F.col("row")).otherwise(LOWEST).alias("unit_row"),
    )
    return scratch.keep(marked, "marked"), loads


def _boundaries(units: DataFrame, loads: list[int]) -> Splitters:
    """The first unit of each shard but the first: units whose middle lies past the shards before."""
    sums = {r["range"]: r["size"] for r in units.groupBy("range").agg(F.sum("size").alias("size")).collect()}
    ends = _filled(loads, sum(sums.values()))[:-1]
    before, at, last_range = [], 0, 0
    for k in sorted(sums):
        # The first unit past an end is in the range that the end falls in, or the first of the next.
        near = [float(e) for e in ends if last_range <= e < at + sums[k]]
        if near:
            before.append((k, at, near))
        at, last_range = at + sums[k], at
    spark = units.sparkSession
    wanted = spark.createDataFrame(before, "range int, before long, ends array<double>")
    along = Window.partitionBy("range").orderBy(*UNIT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("size").over(along) - F.col("size") / 2
    first = (
        units.join(F.broadcast(wanted), "range")
        .withColumn("middle", middle)
        .select(*UNIT, "middle", F.explode("ends").alias("end"))
        .where(F.col("middle") >= F.col("end"))
        .groupBy("end")
        .agg(F.min(F.struct(*UNIT)).alias("first"))
        .collect()
    )
    found = {r["end"]: tuple(r["first"]) for r in first}
    last = (1 << 63) - 1, (1 << 63) - 1, (1 << 63) - 1  # shards that the order gives nothing
    keys = np.array([found.get(float(e), last) for e in ends], dtype=np.int64).reshape(-1, 3)
    return Splitters(_sortable([keys[:, k] for k in range(3)]))


def place(rows: DataFrame, shards: int, scratch: Scratch) -> DataFrame:
    """(row, doc_id, size, text_crc32, range, shard, slot) of narrow rows, which must be written."""
    schema = "row long, doc_id long, size long, text_crc32 long, range int, shard int, slot long"
    spark = rows.sparkSession
    if rows.limit(1).count() == 0:
        return spark.createDataFrame([], schema)
    marked, loads = _placed(rows, shards, scratch)
    ranges = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    splitters = find_splitters(rows, ranges)
    units = marked.where("shard is null").groupBy(*UNIT).agg(F.sum("size").alias("size"))
    units = scratch.keep(units.withColumn("range", splitters.range_of(*UNIT)), "units")
    boundaries = _boundaries(units, loads)
    dealt = scratch.keep(
        marked.select(
            "row", "doc_id", "size", "text_crc32", "group", "salt",
            splitters.range_of(*KEY).alias("range"),
            F.coalesce("shard", boundaries.range_of(*UNIT)).alias("shard"),
        ),
        "dealt",
    )
    # At most one row for each range, each shard and each group or document placed by itself.
    counts = sorted((r["shard"], r["range"], r["n"]) for r in dealt.groupBy("shard", "range").agg(F.count("*").alias("n")).collect())
    before, at, held = [], 0, None
    for shard, k, n in counts:
        at = at if shard == held else 0
        before.append((shard, k, at))
        at, held = at + n, shard
    shifts = spark.createDataFrame(before, "shard int, range int, shift long")
    along = Window.partitionBy("shard", "range").orderBy("group", "salt", "row")
    slot = (F.row_number().over(along) - 1 + F.col("shift")).cast("long")
    return dealt.join(F.broadcast(shifts), ["shard", "range"]).select(
        "row", "doc_id", "size", "text_crc32", "range", "shard", slot.alias("slot")
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of `docs` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(narrow(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))), "rows")
    return place(rows, shards, scratch).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write `docs` as Parquet folders `shard=0`, `shard=1`, ... below `path`, each file in the order of its slots."""
    scratch = Scratch(docs.sparkSession)
    kept = scratch.keep(docs.drop("shard", "slot", "size").withColumn("_row", F.monotonically_increasing_id()), "docs")
    found = place(scratch.keep(narrow(kept), "rows"), shards, scratch)
    (
        kept.join(found.select(F.col("row").alias("_row"), F.col("range").alias("_range"), "size", "shard", "slot"), "_row")
        .repartition("shard", "_range")
        .sortWithinPartitions("shard", "slot")
        .drop("_row", "_range")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
