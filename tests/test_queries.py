"""Every registered query against its SQL text, over whole sample tables."""

import os

import pytest

import __spark_entry__ as entry
from rentlake.sources import files
from tests.conftest import SAMPLES
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck():
    con = connect(SAMPLES)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, SAMPLES), duck, entry.oracle_sql()[name]) is None


def test_every_sql_text_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_file_inventory_lists_the_folder(spark):
    listed = {r["name"]: r["size"] for r in files.file_inventory(spark, SAMPLES, "*.parquet", recursive=True).collect()}
    assert listed == {n: os.path.getsize(f"{SAMPLES}/{n}") for n in os.listdir(SAMPLES)}


def test_entry(spark):
    assert entry.entry(spark).count() == 150
