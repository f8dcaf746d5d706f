import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentlake import schemas
from rentlake.operators import reports
from rentlake.plans import adapters
from rentlake.plans.adapters import write_json_arrays
from rentlake.sources import dimensions, documents, files, jdbc, tables
from rentlake.workspace import SETTING, Workspace, shared_root
from tests.conftest import rows, write

STAFF = [
    {"staff_key": 1, "first_name": "Ann", "last_name": "Lee", "email": "a@x", "store_key": 1, "active": 1},
    {"staff_key": 2, "first_name": "Bob", "last_name": "Ray", "email": "b@x", "store_key": 2, "active": 0},
]


@pytest.fixture
def staff_files(folder):
    lines = [",".join(STAFF[0])] + [",".join(str(v) for v in row.values()) for row in STAFF]
    write(f"{folder}/staff.csv", "\n".join(lines) + "\n")
    write(f"{folder}/staff.json", json.dumps(STAFF, indent=2))
    return folder


def test_csv_is_inferred(spark, staff_files):
    df = files.read_csv(spark, f"{staff_files}/staff.csv")
    assert [t for _, t in df.dtypes] == ["int", "string", "string", "string", "int", "int"]


def test_csv_and_json_of_one_dimension_agree(spark, staff_files):
    csv = files.read_csv(spark, f"{staff_files}/staff.csv", schemas.DIM_STAFF)
    arrays = files.read_json_arrays(spark, f"{staff_files}/staff.json", schemas.DIM_STAFF)
    assert csv.schema == arrays.schema
    assert rows(csv) == rows(arrays) and csv.count() == 2


def test_json_columns_are_inferred_alphabetically(spark, staff_files):
    inferred = files.read_json_arrays(spark, f"{staff_files}/staff.json")
    assert inferred.columns == sorted(inferred.columns)


def test_broken_json_is_kept_on_request(spark, folder):
    write(f"{folder}/x.json", '[{"staff_key": 1}, {"staff_key": "one"}]')
    got = files.read_json_arrays(spark, f"{folder}/x.json", "staff_key INT", keep_corrupt=True)
    assert rows(got.selectExpr("staff_key", f"{files.CORRUPT} IS NOT NULL")) == [(1, True), (None, True)]


def test_json_arrays_round_trip_in_bounded_files(spark, folder):
    df = spark.range(1000).withColumn("x", F.when(F.col("id") % 3 == 0, F.lit("a")))
    write_json_arrays(df.repartition(3), f"{folder}/out", bytes_per_file=2000)
    assert rows(files.read_json_arrays(spark, f"{folder}/out", df.schema)) == rows(df)
    sizes = [len(r["value"]) for r in spark.read.option("wholetext", True).text(f"{folder}/out").collect() if r["value"]]
    assert max(sizes) <= 2200 and len(sizes) >= 9


def test_json_arrays_are_written_as_rows_come(spark, folder):
    taken = []

    def batches():
        for k in range(20):
            taken.append(k)
            yield pa.record_batch({"doc": pa.array([b'{"id":%d}' % (10 * k + i) for i in range(10)] + [None])})

    arrays = adapters._arrays(100)(batches())
    first = json.loads(next(arrays).column(0)[0].as_py())
    assert first == [{"id": i} for i in range(len(first))] and len(taken) < 4  # one array is held, not the task's
    assert [r["id"] for a in arrays for r in json.loads(a.column(0)[0].as_py())] == list(range(len(first), 200))
    one = list(adapters._arrays(5)(iter([pa.record_batch({"doc": pa.array([b'"long text"', b"1"])})])))
    assert [a.column(0)[0].as_py() for a in one] == ['["long text"]', "[1]"]


def test_json_arrays_can_be_compressed(spark, folder):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit("ä,]")).alias("x"))
    write_json_arrays(df.repartition(3), f"{folder}/out", bytes_per_file=2000, compression="gzip")
    assert rows(files.read_json_arrays(spark, f"{folder}/out", df.schema)) == rows(df)
    names = [r["name"] for r in files.file_inventory(spark, f"{folder}/out", "part-*").collect()]
    assert len(names) >= 9 and all(n.endswith(".gz") for n in names)


def test_file_inventory(spark, staff_files):
    got = files.file_inventory(spark, staff_files, "*.json")
    row = got.first()
    assert row["name"] == "staff.json" and row["size"] > 0 and row["modified"] is not None and got.count() == 1


def test_dimension_from_either_file(spark, staff_files):
    work = Workspace(spark)
    for source, name in (("csv", "staff.csv"), ("json", "staff.json")):
        table = work.table(f"dim_staff_{source}")
        loaded = dimensions.load_dimension(
            spark, table, source, f"{staff_files}/{name}", schemas.DIM_STAFF, location=work.path(f"dim_{source}")
        )
        assert rows(loaded) == rows(dimensions.read_dimension(spark, "table", table)) and loaded.count() == 2


class FakeReader:
    """Records what a JDBC read is asked for; no database is at hand."""

    def __init__(self, spark):
        self.read, self.calls, self.spark = self, [], spark

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.spark.range(1)


def test_jdbc_table_and_query(spark):
    fake = FakeReader(spark)
    properties = {"user": "u", "password": "p"}
    jdbc.read_jdbc_table(fake, "jdbc:x", "dim_customers", properties)
    jdbc.read_jdbc_query(fake, "jdbc:x", "select * from t where a > 1; ", properties, jdbc.Split("a", 1, 100, 8))
    jdbc.read_jdbc_table(fake, "jdbc:x", "t", properties, predicates=["a < 5", "a >= 5"])
    assert fake.calls == [
        ("jdbc:x", "dim_customers", {"properties": properties}),
        (
            "jdbc:x",
            "(select * from t where a > 1) rentlake_query",
            {"column": "a", "lowerBound": 1, "upperBound": 100, "numPartitions": 8, "properties": properties},
        ),
        ("jdbc:x", "t", {"predicates": ["a < 5", "a >= 5"], "properties": properties}),
    ]
    with pytest.raises(ValueError):
        jdbc.read_jdbc_table(fake, "jdbc:x", "t", split=jdbc.Split("a", 1, 2, 2), predicates=["a = 1"])


def test_jdbc_view(spark):
    jdbc.jdbc_view(FakeReader(spark), "view_customers", "jdbc:x", "dim_customers")
    assert spark.table("view_customers").count() == 1


@pytest.fixture
def films(spark):
    data = [(1, "A", 2001, "G"), (2, "B", 2003, None), (3, "C", 2005, "PG"), (4, "D", 2007, "G")]
    return spark.createDataFrame(data, "id INT, title STRING, year INT, rating STRING")


@pytest.mark.parametrize(
    "conditions, ids",
    [
        ({"rating": "G"}, [1, 4]),
        ({"rating": None}, [2]),
        ({"rating": {"$ne": "G"}}, [2, 3]),
        ({"year": {"$gt": 2001, "$lte": 2005}}, [2, 3]),
        ({"year": {"$in": [2001, 2007]}, "rating": "G"}, [1, 4]),
        ({"rating": {"$nin": ["G"]}}, [2, 3]),
        ({"rating": {"$exists": True}}, [1, 3, 4]),
        ({"rating": {"$exists": False}}, [2]),
        ({"$or": [{"id": 1}, {"year": {"$gte": 2007}}]}, [1, 4]),
        ({"$and": [{"rating": "G"}, {"year": {"$lt": 2005}}]}, [1]),
        ({}, [1, 2, 3, 4]),
    ],
)
def test_find_conditions(films, conditions, ids):
    assert [r[0] for r in rows(documents.document_find(films, conditions), "id")] == ids


def test_find_takes_a_spark_predicate(films):
    assert rows(documents.document_find(films, F.col("id") > 2), "id") == [(3,), (4,)]


def test_find_arguments_work_alone(films):
    assert documents.document_find(films).collect() == films.collect()
    assert documents.document_find(films, projection={"rating": 0, "year": 0}).columns == ["id", "title"]
    assert documents.document_find(films, projection={"title": 1}).columns == ["title"]
    assert documents.document_find(films, projection=["id"]).columns == ["id"]
    assert [r["id"] for r in documents.document_find(films, sort=[("rating", -1), ("id", 1)]).collect()] == [3, 1, 4, 2]
    # The sort field need not be in the projection.
    got = documents.document_find(films, {"rating": "G"}, ["title"], [("year", -1)])
    assert [r["title"] for r in got.collect()] == ["D", "A"]


def test_replace_collections_is_idempotent(spark, staff_files):
    args = (spark, {"staff": f"{staff_files}/staff.json"}, f"{staff_files}/db", {"staff": schemas.DIM_STAFF})
    assert documents.replace_collections(*args) == documents.replace_collections(*args) == {"staff": 2}
    assert documents.read_documents(spark, f"{staff_files}/db/staff", fmt="parquet").count() == 2


def test_create_if_absent_keeps_the_first(spark, films):
    work = Workspace(spark)
    name = work.table("films")
    tables.create_table_if_absent(films.limit(0), name, work.path("films"), "the films' table")
    assert tables.create_table_if_absent(films, name).count() == 0
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Comment"] == "the films' table"


def test_replace_table_with_buckets_spares_a_shuffle(spark, films):
    work = Workspace(spark)
    name = work.table("bucketed")
    tables.replace_table(films, name, work.path("bucketed"), bucket_by=(4, ["id"]))
    plan = spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_database(spark, films):
    work = Workspace(spark)
    name = work.table("db")
    tables.create_database(spark, name, "it's a test", work.path("db"), {"purpose": "test"})
    tables.create_database(spark, name)
    described = str(spark.sql(f"DESCRIBE DATABASE EXTENDED {name}").collect())
    assert "it's a test" in described and "purpose" in described
    tables.replace_table(films, f"{name}.films")
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY"):
        tables.drop_database(spark, name)
    tables.drop_database(spark, name, with_contents=True)
    assert not spark.catalog.databaseExists(name)


def test_profiles_agree(films):
    exact = {r["column_name"]: r.asDict() for r in reports.table_profile(films, exact=True).collect()}
    quick = {r["column_name"]: r.asDict() for r in reports.table_profile(films).collect()}
    assert exact == quick
    assert exact["rating"] == {
        "column_name": "rating",
        "data_type": "string",
        "n_rows": 4,
        "n_nulls": 1,
        "n_distinct": 2,
        "min_value": "G",
        "max_value": "PG",
    }


def test_profile_of_nothing(films):
    got = {r["column_name"]: (r["n_rows"], r["n_nulls"], r["n_distinct"]) for r in reports.table_profile(films.limit(0), exact=True).collect()}
    assert got["id"] == (0, 0, 0)


def test_describe_and_preview(films):
    assert rows(reports.describe_columns(films))[0] == (1, "id", "int", True)
    assert reports.preview(films, 2).count() == 2
    assert [r["id"] for r in reports.preview(films, 2, [F.desc("year")]).collect()] == [4, 3]


def test_pivot(films):
    got = reports.pivot_sum(films, ["rating"], "title", ["A", "D", "Z"], F.col("year"))
    assert rows(got.where("rating = 'G'")) == [("G", 2001, 2007, None)]


class NamelessConf:
    """A session's settings without a shared folder."""

    def get(self, key, default=None):
        return default


def session_on(master):
    context = type("Context", (), {"master": master, "applicationId": f"app on {master}"})()
    return type("Session", (), {"conf": NamelessConf(), "sparkContext": context})()


def test_shared_root_comes_from_the_session(spark):
    named = spark.conf.get(SETTING, None)
    assert shared_root(spark) == (named or shared_root(spark)).rstrip("/")
    assert Workspace(spark).root != Workspace(spark).root


def test_local_session_without_a_folder_gets_one():
    session = session_on("local[2]")
    assert shared_root(session) == shared_root(session) != shared_root(session_on("local[3]"))


def test_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="shared"):
        shared_root(session_on("spark://host:7077"))
