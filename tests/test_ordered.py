from statistics import median

from pyspark.sql import functions as F

from rentlake.functions import ordered_concat
from rentlake.operators import ordered
from rentlake.plans import marts
from tests.conftest import rows


def test_places_with_hot_ties_nulls_and_few_rows(spark, without_merging):
    values = [(i, 5 if i % 3 == 0 else i * 37 % 1009 if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(values, "id int, v int").repartition(6)
    got = ordered.ranked(df, [F.asc_nulls_first("v")]).collect()
    assert [r["place"] for r in sorted(got, key=lambda r: r["place"])] == list(range(1, 3001))
    in_order = [r["v"] for r in sorted(got, key=lambda r: r["place"])]
    assert in_order == sorted((v for _, v in values), key=lambda v: (v is not None, v))
    assert ordered.ranked(df.limit(0), ["v"]).collect() == []
    assert [tuple(r) for r in ordered.ranked(df.where("id = 1"), ["v"]).collect()] == [(1, 37, 1)]
    twins = spark.createDataFrame([(1,)] * 50, "v int").repartition(4)
    assert sorted(r["place"] for r in ordered.ranked(twins, [F.desc("v")]).collect()) == list(range(1, 51))


def test_a_value_of_a_third_of_all_rows_spreads_over_ranges(spark, without_merging):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v")).repartition(4)
    spread = df.orderBy("v", F.xxhash64("id", "v") + F.spark_partition_id()).select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in spread.groupBy("p").count().collect()]
    assert len(sizes) > 2 and max(sizes) <= 2 * median(sizes)
    assert ordered.ranked(df, ["v"]).where("v = -1").agg(F.max("place")).first()[0] == 20_000


def test_no_window_over_all_rows(spark):
    plan = ordered.ranked(spark.range(100).toDF("v"), ["v"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def hot_items(spark):
    """A third of all rows in one group, some NULL and repeated items, two tiny groups, one of NULLs only."""
    made = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400).cast("int").alias("k"),
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("n"), F.col("id") * 7919 % 5000)).alias("item"),
        "id",
    )
    few = spark.createDataFrame([(1000, "b", 1), (1000, "a", 2), (1001, None, 3)], "k int, item string, id long")
    return made.unionByName(few).repartition(5)


def test_assembled_lists_equal_lists_of_one_cell(spark, without_merging):
    df = hot_items(spark)
    whole = rows(ordered_concat(df, ["k"], "item", ["item", "id"], ", ", "items").where("items IS NOT NULL"))
    assert rows(ordered.assembled_concat(df, ["k"], "item", ["item", "id"], ", ", "items")) == whole


def test_runs_of_a_hot_group_are_even_and_know_their_offsets(spark, without_merging):
    runs = ordered.ordered_runs(hot_items(spark), ["k"], "item", ["item", "id"], ", ", "items").collect()
    per_range = {}
    for r in runs:
        per_range[r["part"]] = per_range.get(r["part"], 0) + r["n_items"]
    assert max(per_range.values()) <= 2 * median(per_range.values())
    hot = sorted((r for r in runs if r["k"] == 0), key=lambda r: r["part"])
    assert len(hot) > 1
    text = ", ".join(r["items"] for r in hot)
    items = text.split(", ")
    for r in hot:
        assert text[r["first_char"] :].startswith(r["items"])
        assert items[r["first_item"] : r["first_item"] + r["n_items"]] == r["items"].split(", ")


def test_views_with_assembled_lists(rental_shop):
    t = rental_shop
    films = [t[n] for n in ("film", "film_category", "category", "film_actor", "actor")]
    assert rows(marts.film_list(*films, assembled=True)) == rows(marts.film_list(*films))
    actors = [t[n] for n in ("actor", "film_actor", "film", "film_category", "category")]
    assert rows(marts.actor_info(*actors, assembled=True)) == rows(marts.actor_info(*actors))


def test_what_ranges_carry_is_broadcast_and_the_tie_is_narrow(spark, without_adaptive_execution):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).alias("at"), F.lit(1).alias("v"))
    totals = ordered.running_totals(df, ["k"], ["at"], "v", "total")
    assert totals.where("total <> at + 1").count() == 0 and totals.count() == 3000
    plan = str(totals._jdf.queryExecution().executedPlan())
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert ordered.TIES <= 1 << 15
