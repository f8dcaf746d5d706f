import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlake.operators import filters, integrity, ordered
from rentlake.plans import routines
from tests.conftest import rows


def keys_of(spark, n, step=1):
    return spark.range(0, n * step, step).toDF("k")


def test_a_filter_has_all_keys_and_few_others(spark):
    keys = keys_of(spark, 20_000)
    found = filters.key_filter(keys, "k")
    assert found.words == 5000 and found.table.count() <= 5000
    may, without = found.split(spark.range(40_000).toDF("k"), "k")
    kept = {r["k"] for r in may.collect()}
    assert set(range(20_000)) <= kept
    assert len(kept) < 20_000 * 1.03
    assert rows(without) == [(k,) for k in range(40_000) if k not in kept] or {r["k"] for r in without.collect()} == set(range(40_000)) - kept


@pytest.mark.parametrize("most", [filters.WORDS_MOST, 1])
def test_hot_and_null_references(spark, monkeypatch, most):
    """A third of all rows refer to one key; beyond the bound of the filter the plain join answers."""
    monkeypatch.setattr(filters, "WORDS_MOST", most)
    child = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).alias("fk"))
    parent = spark.range(0, 3000, 2).select(F.col("id").alias("pk"))
    assert rows(filters.filtered_orphans(child, "fk", parent, "pk")) == rows(integrity.orphans(child, "fk", parent, "pk"))
    twice = parent.where("pk < 900").unionByName(parent.where("pk < 900")).unionByName(spark.sql("SELECT 7L AS pk"))
    want = [(r["id"], None if r["fk"] == 7 or (r["fk"] is not None and r["fk"] < 900 and r["fk"] % 2 == 0) else r["fk"]) for r in child.collect()]
    for made in (filters.filtered_set_null, integrity.set_null_on_delete):
        assert rows(made(child, "fk", twice, "pk")) == sorted(want, key=repr)
    assert filters.filtered_orphans(child, "fk", parent.limit(0), "pk").count() == child.where("fk IS NOT NULL").count()
    assert rows(filters.filtered_set_null(child, "fk", twice.limit(0), "pk")) == rows(child)


def test_only_candidates_are_shuffled(spark):
    child = spark.range(10_000).toDF("fk")
    may, _ = filters.key_filter(keys_of(spark, 50), "k").split(child, "fk")
    assert may.count() < 200


def test_running_totals_with_a_hot_key(spark, without_merging):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 300).alias("k"),
        F.xxhash64("id").alias("at"),
        F.when(F.col("id") % 13 != 0, F.col("id")).cast("decimal(12,2)").alias("v"),
        "id",
    ).repartition(6)
    got = ordered.running_totals(df, ["k"], ["at"], "v", "total")
    sums, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["at"]):
        sums[r["k"]] = sums.get(r["k"], 0) + (r["v"] or 0)
        want[r["id"]] = sums[r["k"]]
    assert {r["id"]: r["total"] for r in got.collect()} == want
    assert got.columns == [*df.columns, "total"]
    assert ordered.running_totals(df.limit(0), ["k"], ["at"], "v", "total").collect() == []


def test_balances_equal_one_call_per_date(spark, rental_shop):
    t = rental_shop
    moments = [dt.datetime(2024, m, d, 23, 59, s) for m in (1, 2, 3) for d in (1, 10, 29) for s in (0, 59)]
    moments.append(dt.datetime(2024, 2, 1))  # the very moment of a payment
    questions = t["customer"].select("customer_id").crossJoin(spark.createDataFrame([(m,) for m in moments], "as_of timestamp_ntz"))
    unknown = spark.createDataFrame([(99, moments[0])] * 2, "customer_id int, as_of timestamp_ntz")
    got = routines.customer_balances(questions.unionByName(unknown), t["rental"], t["inventory"], t["film"], t["payment"])
    want = []
    for m in moments:
        one = routines.customer_balance(t["customer"], t["rental"], t["inventory"], t["film"], t["payment"], m)
        want += [(r["customer_id"], m, r["balance"]) for r in one.collect()]
    want += [(99, moments[0], 0)] * 2
    assert sorted((r["customer_id"], r["as_of"], r["balance"]) for r in got.collect()) == sorted(want)
