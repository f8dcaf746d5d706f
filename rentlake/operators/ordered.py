"""Orders over whole tables without a task that sees them whole: places, and lists in runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.workspace import Workspace

# A running row number holds the partition above these bits and the place within it below.
PLACE_BITS = 33
# Rows that tie in a running total are dealt to so many ranges at most; the tie moves with every row, so it is narrow.
TIES = 1 << 15


def ranked(df: DataFrame, by: Sequence[Column | str], alias: str = "place") -> DataFrame:
    """`df` with the place of each row in the order `by`, from 1 and without gaps.

    Rows that tie have different places, in no particular order: a hash of the row and of
    its task decides, so that a value which a third of all rows share spreads over ranges.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id()
    return places(df.withColumn("_tie", tie).orderBy(*by, "_tie").drop("_tie"), alias)


def places(ordered: DataFrame, alias: str = "place") -> DataFrame:
    """A DataFrame that is sorted as a whole, with the place of each row.

    A sort leaves one range to each partition. The rows are written with their number in
    the partition; the ranges are counted and each shifted by the rows before it. The
    driver sees one count a range, and no row moves after the sort.
    """
    spark, path = ordered.sparkSession, Workspace(ordered.sparkSession).path("places")
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_range", F.shiftright("_at", PLACE_BITS))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    before, total = [], 0
    for r in sorted(counts):
        before.append((r["_range"], total))
        total += r["n"]
    shifts = F.broadcast(spark.createDataFrame(before, "_range long, _shift long"))
    within = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.join(shifts, "_range").select(*ordered.columns, (F.col("_shift") + within + 1).alias(alias))


def ordered_runs(
    df: DataFrame, keys: Sequence[str], item: str, by: Sequence[str], separator: str, alias: str
) -> DataFrame:
    """Every group's list as sorted runs: keys, `part`, `first_item`, `first_char`, `n_items`, `alias`.

    Rows are range-partitioned on (keys, by), ties spread by a hash, so a group that holds a
    large share of all rows is sorted by many tasks. Each makes one run of what it has of a
    group; runs follow each other in `part` order, and `first_item` and `first_char` (both
    from 0) are where a run begins in the whole list and text, separators counted. NULL
    items are left out. The rows are written first: range-partitioning reads its input
    twice, and must not run what comes before it twice. The runs are written as well, as
    few rows, for offsets to be added up on them alone.
    """
    spark, work = df.sparkSession, Workspace(df.sparkSession)
    rows = df.where(F.col(item).isNotNull()).select(*dict.fromkeys([*keys, item, *by]))
    rows.write.parquet(work.path("list_rows"))
    placed = spark.read.schema(rows.schema).parquet(work.path("list_rows"))
    tie = F.xxhash64(item) + F.spark_partition_id()
    placed = placed.withColumn("_tie", tie).repartitionByRange(*keys, *by, "_tie").withColumn("part", F.spark_partition_id())
    runs = placed.groupBy(*keys, "part").agg(
        F.count(item).alias("n_items"), F.sum(F.length(item).cast("long")).alias("_chars"), listed(item, by, separator).alias(alias)
    )
    runs.write.parquet(work.path("list_runs"))
    runs = spark.read.schema(runs.schema).parquet(work.path("list_runs"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first_item = F.coalesce(F.sum("n_items").over(earlier), F.lit(0))
    first_char = F.coalesce(F.sum(F.col("_chars") + F.col("n_items") * len(separator)).over(earlier), F.lit(0))
    return runs.select(*keys, "part", first_item.alias("first_item"), first_char.alias("first_char"), "n_items", alias)


def assembled_concat(
    df: DataFrame, keys: Sequence[str], item: str, by: Sequence[str], separator: str, alias: str
) -> DataFrame:
    """The text of `functions.ordered_concat`, put together from sorted runs: keys, `alias`.

    The task that holds a group's text gets one row for each range the group spans and
    sorts nothing else. Groups of NULLs only have no row.
    """
    runs = ordered_runs(df, keys, item, by, separator, alias)
    return runs.groupBy(*keys).agg(listed(alias, ["part"], separator).alias(alias))


def running_totals(df: DataFrame, keys: Sequence[str], by: Sequence[str], value: str, alias: str) -> DataFrame:
    """`df` with the sum of `value` over the rows of its keys up to and with itself, in the order `by`.

    One sorted pass: rows are range-partitioned on (keys, by), ties spread by a hash, so that
    a key which holds a third of all rows is summed by many tasks, each over its range. Of
    what a range holds of a key, the total is carried to the ranges after it; that is one
    row for a key and range, and as a range has one first key that goes on from the one
    before, no more rows than ranges: they are broadcast. Rows that tie in `by` are summed
    in no particular order.
    """
    spark, work = df.sparkSession, Workspace(df.sparkSession)
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id()
    tie = F.pmod(mixed, F.lit(TIES)).cast("short")
    placed = df.withColumn("_tie", tie).repartitionByRange(*keys, *by, "_tie").withColumn("_part", F.spark_partition_id())
    placed.write.parquet(work.path("totals"))
    rows = spark.read.schema(placed.schema).parquet(work.path("totals"))
    sums = rows.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"_key_{k}").eqNullSafe(F.col(k)) for k in keys]
    carried = sums.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_range"), F.sum("_sum").over(earlier).alias("_carried"))
    carried = carried.where("_carried IS NOT NULL")
    along = Window.partitionBy("_part", *keys).orderBy(*by, "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn("_own", F.sum(value).over(along)).join(F.broadcast(carried), [F.col("_part") == F.col("_range"), *same], "left")
    return joined.select(*df.columns, (F.coalesce("_carried", F.lit(0)) + F.coalesce("_own", F.lit(0))).alias(alias))


def listed(item: str, by: Sequence[str], separator: str) -> Column:
    """The values of a group in the order `by`, as one text."""
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    order = ", ".join(f"`{c}`" for c in by)
    return F.expr(f"listagg(`{item}`, '{quoted}') within group (order by {order})")
