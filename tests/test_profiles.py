from statistics import median

import pytest
from pyspark.sql import functions as F

from rentlake.operators import profiles, reports
from rentlake.sources import splits
from tests.conftest import rows


def days(spark):
    """A third of all rows on one day; numbers, texts, dates, NULLs and a column of NULLs only."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "d0").otherwise(F.concat(F.lit("d"), F.col("id") % 40)).alias("day"),
        F.col("id").alias("k"),
        (F.col("id") % 997).cast("decimal(9,2)").alias("price"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("name "), F.col("id") % 12_000)).alias("name"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int")).alias("on"),
        F.lit(None).cast("double").alias("nothing"),
    )


def test_profile_of_all_days_is_the_merge_of_stored_days(spark, folder):
    df = days(spark)
    fields = [f for f in df.schema if f.name != "day"]
    for part in ("day <= 'd2'", "day > 'd2'"):
        profiles.profile_state(df.where(part), "day").write.mode("append").partitionBy("day").parquet(f"{folder}/states")
    state = spark.read.parquet(f"{folder}/states")
    assert state.count() == 40
    got = {r["column_name"]: r for r in profiles.merged_profile(state, fields).collect()}
    exact = {r["column_name"]: r for r in reports.table_profile(df.drop("day"), exact=True).collect()}
    assert list(got) == [f.name for f in fields]
    for name, want in exact.items():
        r = got[name]
        assert all(r[c] == want[c] for c in ("data_type", "n_rows", "n_nulls", "min_value", "max_value")), name
        assert abs(r["n_distinct"] - want["n_distinct"]) <= 0.05 * want["n_distinct"], name
    for name, top in (("k", 30_000), ("price", 997)):
        for q, value in zip(profiles.QUANTILES, got[name]["quantiles"], strict=True):
            assert abs(value / top - q) <= profiles.RANK_ERROR + 0.002
    assert got["name"]["quantiles"] is None and got["nothing"]["quantiles"] is None


def test_some_days_and_none(spark):
    df = days(spark)
    fields = [f for f in df.schema if f.name != "day"]
    state = profiles.profile_state(df, "day")
    one = {r["column_name"]: r for r in profiles.merged_profile(state.where("day = 'd7'"), fields).collect()}
    assert one["k"]["n_rows"] == df.where("day = 'd7'").count()
    none = profiles.merged_profile(state.limit(0), fields).collect()
    assert {(r["n_rows"], r["n_nulls"], r["n_distinct"], r["min_value"]) for r in none} == {(0, 0, 0, None)}


@pytest.mark.parametrize("queries", [1, 2, 7, 16])
def test_every_row_meets_one_predicate(spark, queries):
    """A third of all rows under one key, the others crowded at low values, NULLs, and keys that came since."""
    id_ = F.col("id")
    df = spark.range(12_000).select(
        F.when(id_ % 3 == 0, 500).when(id_ % 31 == 0, None).otherwise((id_ * id_ % 1000) * (id_ % 97)).alias("k"), (id_ - 6000).alias("other")
    )
    for within in (None, "other"):
        predicates = splits.even_predicates(df, "k", queries, within)
        later = df.unionByName(spark.createDataFrame([(-5, 1), (10**9, 2), (501, 3)], "k long, other long"))
        met = later.select(sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0)).alias("n"))
        assert met.where("n <> 1").count() == 0
        sizes = [df.where(p).count() for p in predicates]
        if queries > 2 and within:
            assert len(predicates) >= queries - 1
            assert max(sizes) <= 2 * median(sizes)
        if queries > 2 and not within:
            assert sorted(sizes)[-2] <= 2 * median(sizes)


def test_no_keys_at_hand(spark):
    assert splits.even_predicates(spark.createDataFrame([], "k long"), "k", 4) == ["1 = 1"]
    assert rows(spark.range(3).where(splits.even_predicates(spark.range(3).toDF("id"), "id", 1)[0])) == [(0,), (1,), (2,)]
