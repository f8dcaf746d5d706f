import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from rentlake import schemas
from rentlake.operators import slices
from rentlake.plans import gold
from rentlake.sources import files
from rentlake.streaming import ingest, medallion
from rentlake.workspace import Workspace
from tests.conftest import rows, write
from tests.test_slices import left_behind, shuffle_files


def rental(key, customer=1, staff=1, copy=1, rented="2024-05-07T10:00:00", returned="2024-05-09T11:00:00"):
    return {
        "rental_key": key,
        "customer_key": customer,
        "staff_key": staff,
        "store_key": 1,
        "inventory_key": copy,
        "rental_date": rented,
        "return_date": returned,
        "modified_date": "2024-05-10T00:00:00",
    }


@pytest.fixture
def dims(spark):
    customers = [(1, "MARY", "SMITH", "m@x"), (2, "JOHN", "SMITH", None)]
    day = dt.date(2024, 5, 1)
    dates = [(day + dt.timedelta(n),) for n in range(31)]
    calendar = spark.createDataFrame(dates, "Date DATE").select(
        "Date",
        F.date_format("Date", "MMMM").alias("MonthName"),
        F.date_format("Date", "EEEE").alias("WeekDayName"),
        F.dayofmonth("Date").alias("Day"),
        F.year("Date").alias("Year"),
    )
    return {
        "customers": spark.createDataFrame(customers, schemas.DIM_CUSTOMERS),
        "staff": spark.createDataFrame([(1, "Ann", "Lee", "a@x", 4, 1)], schemas.DIM_STAFF),
        "inventory": spark.sql(
            "SELECT 1 AS inventory_key, 'ALPHA' AS title, 2001 AS release_year, 3 AS rental_duration, "
            "0.99BD AS rental_rate, 90 AS length, 9.99BD AS replacement_cost, 'G' AS rating"
        ),
        "dates": calendar,
    }


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.work = spark, folder, Workspace(spark)
        self.bronze_name, self.silver_name = self.work.table("bronze"), self.work.table("silver")

    def land(self, name, rentals):
        return write(f"{self.folder}/raw/{name}.json", json.dumps(rentals, indent=1))

    def bronze(self):
        medallion.run_bronze(
            self.spark,
            f"{self.folder}/raw",
            schemas.RAW_RENTALS,
            self.bronze_name,
            self.work.path("bronze_checkpoint"),
            self.work.path("bronze"),
        )
        return self.spark.table(self.bronze_name)

    def silver(self, dims, **options):
        medallion.run_silver(
            self.spark,
            self.bronze_name,
            dims,
            self.silver_name,
            self.work.path("silver_checkpoint"),
            self.work.path("silver"),
            **options,
        )
        return self.spark.table(self.silver_name)


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


def test_files_are_taken_once_by_path(lake):
    first = lake.land("a", [rental(1), rental(2)])
    assert lake.bronze().count() == 2
    assert lake.bronze().count() == 2
    lake.land("b", [rental(3)])
    assert lake.bronze().count() == 3
    shutil.copy(first, first.replace("a.json", "copy.json"))
    assert lake.bronze().count() == 5


def test_lineage(lake):
    lake.land("a", [rental(1), rental(2)])
    got = lake.bronze()
    assert got.columns[-2:] == ["receipt_time", "source_file"]
    assert got.select("receipt_time").distinct().count() == 1
    assert all(r["source_file"].endswith("/raw/a.json") for r in got.collect())


def test_silver(lake, dims):
    lake.land("a", [rental(1), rental(2, customer=2)])
    lake.bronze()
    silver = lake.silver(dims)
    assert silver.columns == medallion.SILVER_COLUMNS and len(silver.columns) == 29
    row = silver.where("rental_key = 1").first()
    assert (row.customer_last_name, row.staff_last_name, row.store_key, row.title) == ("SMITH", "Lee", 4, "ALPHA")
    assert (row.rental_month, row.rental_day_name, row.rental_day, row.rental_year) == ("May", "Tuesday", 7, 2024)
    assert (row.return_month, row.return_day_name, row.return_day, row.return_year) == ("May", "Thursday", 9, 2024)
    # A second run adds only what is new.
    lake.land("b", [rental(3)])
    lake.bronze()
    assert lake.silver(dims).count() == 3


def test_stream_equals_batch(lake, dims):
    for name in ("a", "b", "c"):
        lake.land(name, [rental(i, customer=1 + i % 3, returned=None if i % 5 == 0 else "2024-05-09T11:00:00") for i in range(20)])
    bronze = lake.bronze()
    assert rows(lake.silver(dims)) == rows(medallion.enrich_rentals(bronze, **dims))


def test_silver_and_unmatched_make_bronze(lake, dims):
    lake.land(
        "a",
        [
            rental(1),
            rental(2, customer=9),
            rental(3, staff=9, copy=9),
            rental(4, returned=None),
            rental(5, rented="2020-01-01T00:00:00"),
        ],
    )
    bronze = lake.bronze()
    silver = lake.silver(dims)
    lost = medallion.unmatched_rentals(bronze, **dims)
    assert rows(lost, "rental_key", "missing") == [
        (2, ["customer"]),
        (3, ["staff", "inventory"]),
        (4, ["return_date"]),
        (5, ["rental_date"]),
    ]
    assert silver.count() + lost.count() == bronze.count()


def test_open_rentals_can_stay(lake, dims):
    lake.land("a", [rental(1), rental(2, returned=None), rental(3, returned="2020-01-01T00:00:00")])
    lake.bronze()
    got = rows(lake.silver(dims, require_return=False), "rental_key", "return_month")
    assert got == [(1, "May"), (2, None)]


def test_late_dimension_rows_are_made_up_for(spark, lake, dims):
    # Rental 1 has two lines, of which only one is complete at first.
    lake.land("a", [rental(1), rental(1, staff=9), rental(2, customer=2), rental(3, returned=None)])
    bronze = lake.bronze()
    early = {**dims, "customers": dims["customers"].where("customer_key = 1")}
    schema = medallion.split_rentals(bronze, **dims).schema
    path = lake.work.path("split")
    medallion.run_silver_split(spark, lake.bronze_name, early, path, lake.work.path("split_checkpoint"))
    first, waiting = medallion.silver_of(spark, path, schema), medallion.quarantine_of(spark, path, schema)
    assert rows(first, "rental_key") == [(1,)] and waiting.columns == bronze.columns
    assert rows(waiting, "rental_key") == [(1,), (2,), (3,)]
    again = lake.work.path("replay_1")
    medallion.replay(waiting, dims, again)
    late = medallion.silver_of(spark, again, schema)
    assert rows(late, "rental_key") == [(2,)]
    last = lake.work.path("replay_2")
    medallion.replay(medallion.quarantine_of(spark, again, schema), dims, last)
    assert medallion.silver_of(spark, last, schema).count() == 0
    assert rows(first.unionByName(late)) == rows(medallion.enrich_rentals(bronze, **dims))
    assert medallion.quarantine_of(spark, last, schema).count() == 2


def test_gold_over_the_stream(lake, dims):
    lake.land("a", [rental(1), rental(2, customer=2), rental(3, returned=None)])
    lake.bronze()
    got = gold.customer_spend(lake.silver(dims), dims["customers"], dims["inventory"]).collect()
    assert [(r[0], r[1], float(r[2])) for r in got] == [("SMITH", 2, 1.98)]


def test_broken_json_is_kept_and_marks_its_file(spark, folder):
    write(f"{folder}/raw/good.json", json.dumps([rental(1)]))
    write(f"{folder}/raw/bad.json", '[{"rental_key": 2}, {"rental_key": "x"}]')
    stream = ingest.stream_files(spark, f"{folder}/raw", files.with_corrupt(schemas.RAW_RENTALS))
    table = Workspace(spark).table("corrupt")
    ingest.append_to_table(stream, table, f"{folder}/checkpoint", f"{folder}/out")
    got = rows(spark.table(table).selectExpr("rental_key", f"{files.CORRUPT} IS NOT NULL AS bad"))
    assert got == [(1, False), (2, True), (None, True)]


def test_continuous_trigger(spark, lake):
    lake.land("a", [rental(1)])
    stream = ingest.with_lineage(ingest.stream_files(spark, f"{lake.folder}/raw", schemas.RAW_RENTALS))
    query = ingest.append_to_table(
        stream, lake.bronze_name, lake.work.path("checkpoint"), lake.work.path("bronze"), continuous="1 second"
    )
    try:
        assert query.isActive
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table(lake.bronze_name).count() == 1


def test_a_split_row_is_written_for_one_reader(spark, lake, dims):
    lake.land("a", [rental(1), rental(2, staff=9), rental(3, customer=7)])
    bronze, path = lake.bronze(), lake.work.path("split")
    split = medallion.split_rentals(bronze, **dims)
    assert rows(split.where("rental_key = 1").select("rental.*")) == rows(bronze.where("rental_key = 1"))
    medallion.write_split(split, path)
    written = spark.read.schema(split.schema).parquet(path)
    assert written.where("complete AND rental IS NOT NULL").count() == 0
    assert written.where("NOT complete AND (rental_key IS NOT NULL OR title IS NOT NULL)").count() == 0
    assert rows(medallion.quarantine_of(spark, path, split.schema)) == rows(bronze.where("rental_key > 1"))


def local(path):
    return path.removeprefix("file://")


def land_many(lake):
    for name in ("a", "b"):
        lake.land(name, [rental(i, customer=1 + i % 3, copy=1 + i % 4 // 3, returned=None if i % 5 == 0 else "2024-05-09T11:00:00") for i in range(30)])
    return lake.bronze()


def copies(dims):
    return {**dims, "inventory": dims["inventory"].unionByName(dims["inventory"].withColumn("inventory_key", F.lit(2)))}


def test_a_large_batch_is_joined_in_slices(spark, lake, dims, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", 7)
    asked = []
    monkeypatch.setattr(medallion, "slices_for", lambda n: asked.append(n) or slices.slices_for(n))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bronze, dims = land_many(lake), copies(dims)
        before = shuffle_files(spark)
        silver = lake.silver(dims)
        assert asked == [60] and not left_behind(spark, before)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert silver.columns == medallion.SILVER_COLUMNS
    assert rows(silver) == rows(medallion.enrich_rentals(bronze, **dims))
    # A batch that is repeated replaces what it left.
    for name in ("0", ".0.crc"):
        os.remove(f"{local(lake.work.path('silver_checkpoint'))}/commits/{name}")
    assert rows(lake.silver(dims)) == rows(medallion.enrich_rentals(bronze, **dims)) and asked == [60, 60]
    lake.land("c", [rental(100)])
    lake.bronze()
    assert lake.silver(dims).where("rental_key = 100").count() == 1
    # Silver is a stream's source in its turn.
    ingest.append_to_table(ingest.stream_table(spark, lake.silver_name), lake.work.table("next"), lake.work.path("next_checkpoint"), lake.work.path("next"))
    assert rows(spark.table(lake.work.table("next"))) == rows(spark.table(lake.silver_name))


def test_a_split_and_its_replay_in_slices(spark, lake, dims, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", 7)
    bronze, dims = land_many(lake), copies(dims)
    early = {**dims, "customers": dims["customers"].where("customer_key = 1")}
    path, schema = lake.work.path("split"), medallion.split_rentals(bronze, **dims).schema
    medallion.run_silver_split(spark, lake.bronze_name, early, path, lake.work.path("split_checkpoint"))
    again = lake.work.path("replay")
    for _ in range(2):  # the second one replaces the first
        assert medallion.replay(medallion.quarantine_of(spark, path, schema), dims, again) == schema
    whole = medallion.silver_of(spark, path, schema).unionByName(medallion.silver_of(spark, again, schema))
    assert rows(whole) == rows(medallion.enrich_rentals(bronze, **dims))
    assert whole.count() + medallion.quarantine_of(spark, again, schema).count() == bronze.count()


def test_tables_of_the_file_sink_go_on_as_they_were(spark, lake, dims):
    lake.land("a", [rental(1)])
    lake.bronze()
    first = medallion.enrich_rentals(ingest.stream_table(spark, lake.bronze_name), **dims)
    ingest.append_to_table(first, lake.silver_name, lake.work.path("silver_checkpoint"), lake.work.path("silver"))
    lake.land("b", [rental(2)])
    lake.bronze()
    assert rows(lake.silver(dims), "rental_key") == [(1,), (2,)]


def test_silver_without_a_location_and_with_partitions(spark, lake, dims):
    lake.land("a", [rental(1), rental(2, rented="2024-05-01T10:00:00")])
    bronze = lake.bronze()
    whole = rows(medallion.enrich_rentals(bronze, **dims))
    for name, by in (("managed", []), ("parted", ["rental_day"])):
        table = lake.work.table(name)
        medallion.run_silver(spark, lake.bronze_name, dims, table, lake.work.path(f"{name}_checkpoint"), partition_by=by)
        assert rows(spark.table(table).select(*medallion.SILVER_COLUMNS)) == whole
        parts = [r["col_name"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
        assert ("# Partition Information" in parts) == bool(by)
