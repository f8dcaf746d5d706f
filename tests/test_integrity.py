import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlake import schemas
from rentlake.operators import integrity
from rentlake.plans.catalogue import QUERIES
from tests.conftest import rows


def test_duplicate_keys_ignore_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a INT, b INT")
    assert rows(integrity.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_null_violations_name_the_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a INT, b INT")
    got = rows(integrity.null_violations(df, ["a", "b"]), "a", "null_columns")
    assert got == [(1, ["b"]), (None, ["a", "b"])]


def test_defaults(spark):
    layout = "rental_duration SMALLINT, rental_rate DECIMAL(4,2), replacement_cost DECIMAL(5,2), rating STRING"
    df = spark.createDataFrame([(None, None, None, None)], layout)
    filled = integrity.apply_defaults(df, schemas.DEFAULTS["film"])
    assert filled.dtypes == df.dtypes
    assert [str(v) for v in filled.first()] == ["3", "4.99", "19.99", "G"]


def test_orphans_keep_null_references_legal(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, 30)], "id INT, ref INT")
    parent = spark.createDataFrame([(10,), (20,)], "pk INT")
    assert rows(integrity.orphans(child, "ref", parent, "pk"), "id") == [(3,), (4,)]


@pytest.fixture
def family(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, 30)], "id INT, ref INT")
    return child, spark.createDataFrame([(10,), (20,), (20,)], "pk INT")


def test_restrict(family):
    child, deletes = family
    assert rows(integrity.restricted_deletes(deletes, "pk", child, "ref")) == [(10,)]
    assert rows(integrity.allowed_deletes(deletes, "pk", child, "ref")) == [(20,), (20,)]


def test_set_null_does_not_multiply_rows(spark, family):
    child, _ = family
    gone = spark.createDataFrame([(30,), (30,)], "pk INT")
    got = integrity.set_null_on_delete(child, "ref", gone, "pk")
    assert got.schema == child.schema
    assert rows(got) == [(1, 10), (2, None), (3, None), (4, None)]


def test_cascade(spark, family):
    child, _ = family
    moved = spark.createDataFrame([(30, 31), (99, 98)], "old INT, new INT")
    got = integrity.cascade_key_update(child, "ref", moved, "old", "new")
    assert got.columns == child.columns
    assert rows(got) == [(1, 10), (2, None), (3, 31), (4, 31)]


def broken(spark, values, ddl, rule):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}")
    return [r["v"] for r in integrity.violations(df, rule).collect()]


def test_row_rules(spark):
    allowed = schemas.DOMAINS["film"]["rating"]
    assert broken(spark, ["G", "X", None], "STRING", integrity.is_outside_domain("v", allowed)) == ["X"]
    members = schemas.SET_DOMAINS["film"]["special_features"]
    features = ["Trailers", "Trailers,Deleted Scenes", "Trailers,Bloopers", "", None]
    assert broken(spark, features, "STRING", integrity.is_outside_set("v", members)) == ["Trailers,Bloopers"]
    assert broken(spark, [-1, 0, 255, 256, None], "INT", integrity.is_outside_range("v", *schemas.TINY)) == [-1, 256]
    assert broken(spark, ["abc", "abcd", None], "STRING", integrity.is_too_long("v", 3)) == ["abcd"]
    numbers = [999.99, 999.995, 1000.0, -999.99, -1000.0, 1.234, None]
    assert broken(spark, numbers, "DOUBLE", integrity.is_not_decimal("v", 5, 2)) == [999.995, 1000.0, -1000.0, 1.234]


def test_number_just_below_the_limit_fits(spark):
    df = spark.sql("SELECT cast('999.90' AS decimal(12,2)) AS v")
    assert integrity.violations(df, integrity.is_not_decimal("v", 5, 2)).count() == 0


def test_report_covers_every_declared_rule(rental_shop):
    report = integrity.integrity_report(rental_shop)
    found = {(r["table_name"], r["rule"], r["columns"]): r["n_violations"] for r in report.collect()}
    references = [k for k in found if k[1] == "FOREIGN KEY"]
    assert len(references) == len(schemas.FOREIGN_KEYS) == 22
    # What the shop does not have is named, not left out.
    assert found[("film", "FOREIGN KEY", "language_id->language.language_id")] is None
    assert found[("language", "PRIMARY KEY", "language_id")] is None and found[("language", "NOT NULL", "name")] is None
    assert found[("rental", "ONE OPEN RENTAL", "inventory_id")] == 1
    assert found[("film", "SET", "special_features")] == 0
    assert found[("customer", "NOT NULL", "create_date")] is None
    assert {k: n for k, n in found.items() if n} == {("rental", "ONE OPEN RENTAL", "inventory_id"): 1}


def test_report_finds_faults(spark, rental_shop):
    film = rental_shop["film"].withColumn("rating", F.lit("X")).withColumn("title", F.repeat(F.lit("t"), 129))
    payment = rental_shop["payment"].unionByName(rental_shop["payment"]).withColumn("customer_id", F.lit(77))
    shop = {**rental_shop, "film": film, "payment": payment}
    found = {(r["table_name"], r["rule"], r["columns"]): r["n_violations"] for r in integrity.integrity_report(shop).collect()}
    assert found[("film", "DOMAIN", "rating")] == 4
    assert found[("film", "LENGTH", "title")] == 4
    assert found[("payment", "PRIMARY KEY", "payment_id")] == 6
    assert found[("payment", "FOREIGN KEY", "customer_id->customer.customer_id")] == 12


def test_schemas_are_consistent():
    for table in schemas.SOURCE_TABLES:
        columns = set(schemas.source_schema(table).names)
        assert set(schemas.PRIMARY_KEYS[table]) <= columns
        for rules in (schemas.DEFAULTS, schemas.DOMAINS, schemas.SET_DOMAINS, schemas.LENGTHS, schemas.RANGES, schemas.DECIMALS):
            assert set(rules.get(table, {})) <= columns
    for child, fk, parent, pk, action in schemas.FOREIGN_KEYS:
        assert fk in schemas.source_schema(child).names and schemas.PRIMARY_KEYS[parent] == [pk]
        assert action in ("RESTRICT", "SET NULL")
    assert len(schemas.FOREIGN_KEYS) == 22 and len(schemas.SOURCE_TABLES) == 16


def test_allowed_deletes_look_at_every_payment_of_the_customers(spark, folder):
    tables = {
        "customer": ("c_custkey long, c_acctbal double", [(1, -1.0), (2, -1.0), (3, -1.0), (4, 5.0)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
            [(1, 1, dt.datetime(1995, 5, 1)), (2, 1, dt.datetime(1997, 5, 1)), (3, 2, dt.datetime(1996, 1, 1)), (4, 3, dt.datetime(1994, 1, 1))],
        ),
        # The order of customer 3 has no line, so no payment.
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz",
            [(k, 1, 1, 1, 9.0, dt.datetime(1997, 6, 1)) for k in (1, 2, 3)],
        ),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    assert rows(QUERIES["fk_allowed_deletes"](spark, folder)) == [(2,), (3,)]
