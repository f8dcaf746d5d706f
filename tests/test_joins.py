import random

import pytest
from pyspark.sql import functions as F

from rentlake.operators import joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    """Facts of which a third share a key, a tenth have none, and many are exact copies."""
    rng = random.Random(3)
    facts = []
    for _ in range(5000):
        draw = rng.random()
        key = 7 if draw < 0.33 else None if draw < 0.43 else rng.randrange(2000)
        facts.append((key, rng.randrange(3)))
    dims = [(k, f"d{k}") for k in range(0, 2000, 2)] + [(7, "seven"), (7, "seven again"), (None, "nothing")]
    return (
        spark.createDataFrame(facts, "k INT, v INT").repartition(6),
        spark.createDataFrame(dims, "k INT, label STRING"),
    )


@pytest.mark.parametrize("how", joins.SPLITTABLE)
def test_salted_join_equals_plain_join(sides, how):
    fact, dim = sides
    got = joins.salted_join(fact, dim, ["k"], how, joins.hot_keys(fact, "k"))
    want = fact.join(dim, "k", how)
    assert rows(got, *sorted(want.columns)) == rows(want, *sorted(want.columns))


def test_semi_join_keeps_the_order_of_columns(sides):
    fact, dim = sides
    turned = fact.select("v", "k")
    assert joins.lookup_join(turned, dim, "k", "left_semi").columns == ["v", "k"]


def test_join_is_salted_when_the_session_does_not_split_skew(without_adaptive_execution, sides):
    fact, dim = sides
    joined = joins.lookup_join(fact, dim, "k", "left")
    assert rows(joined) == rows(fact.join(dim, "k", "left"))
    spread = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1


def test_join_on_two_columns(spark):
    fact = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], "x INT, y STRING, v INT")
    dim = spark.createDataFrame([(1, "a", "A"), (2, "a", "B")], "x INT, y STRING, l STRING")
    got = joins.salted_join(fact, dim, ["x", "y"], "inner", joins.hot_keys(fact, ["x", "y"]))
    assert rows(got, "v", "l") == [(1, "A"), (3, "B")]


def test_hot_keys_hold_more_than_an_even_partition(spark, sides):
    fact, _ = sides
    parts = joins.partitions_of(spark)
    counts = {r["k"]: r["count"] for r in fact.dropna().groupBy("k").count().collect()}
    want = {k for k, n in counts.items() if n * parts > sum(counts.values())}
    assert {r["k"] for r in joins.hot_keys(fact, "k").collect()} == want == {7}


def test_many_hot_keys_are_all_spread(spark):
    """With 400 partitions, 300 keys of even size hold more than an even partition each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        fact = spark.range(30_000).selectExpr("id % 300 AS k", "id AS v").repartition(4)
        dim = spark.range(300).selectExpr("id AS k", "id AS label")
        hot = joins.hot_keys(fact, "k")
        assert hot.count() == 300
        joined = joins.salted_join(fact, dim.hint("merge"), ["k"], "inner", hot)
        assert joined.count() == 30_000
        salted = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in salted
        per_key = joined.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n"))
        assert per_key.where("n > 1").count() == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_joins_need_adaptive_streams(spark, folder):
    spark.range(10).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id LONG").parquet(f"{folder}/in")
    dim = spark.range(10).selectExpr("id", "id AS label")
    assert joins.lookup_join(stream, dim, "id").isStreaming
    spark.conf.set(joins.ADAPTIVE_STREAMS, "false")
    try:
        with pytest.raises(ValueError, match=joins.ADAPTIVE_STREAMS):
            joins.lookup_join(stream, dim, "id")
    finally:
        spark.conf.unset(joins.ADAPTIVE_STREAMS)


def test_other_join_kinds_are_refused(sides):
    fact, dim = sides
    with pytest.raises(ValueError):
        joins.lookup_join(fact, dim, "k", "full")
    with pytest.raises(ValueError):
        joins.salted_join(fact, dim, ["k"], "full", joins.hot_keys(fact, "k"))


def test_hot_keys_are_counted_in_the_stored_table(without_adaptive_execution, sides):
    fact, dim = sides
    first = joins.lookup_join(fact, dim.withColumnRenamed("label", "one"), "k")
    second = joins.lookup_join(first, dim.withColumnRenamed("label", "two"), "k", keys_in=fact)
    plan = second._jdf.queryExecution().optimizedPlan().toString()
    # Two salted joins, each with its two flags: the first join is there once.
    assert plan.count("_spread") > 0 and plan.count("Join Inner") == 2
    want = fact.join(dim.withColumnRenamed("label", "one"), "k").join(dim.withColumnRenamed("label", "two"), "k")
    assert rows(second) == rows(want)
