from decimal import Decimal

import pytest

from rentlake.plans import gold, marts
from tests.conftest import rows

FILM = ["film", "film_category", "category", "film_actor", "actor"]
PLACES = ["address", "city", "country"]


def of(shop, names):
    return [shop[n] for n in names]


def test_customer_list(rental_shop):
    got = rows(marts.customer_list(*of(rental_shop, ["customer", *PLACES])), "ID", "name", "city", "country", "notes", "zip code")
    assert got == [
        (1, "MARY ANN SMITH", "Oz", "Avalon", "active", "111"),
        (2, "JOHN SMITH", "Brill", "Borduria", "", "333"),
        (3, "EVE NG", "Brill", "Borduria", "active", None),
        (4, "NO BODY", "Brill", "Borduria", "active", None),
    ]


def test_staff_list(rental_shop):
    got = rows(marts.staff_list(*of(rental_shop, ["staff", *PLACES])), "ID", "name", "address", "city", "SID")
    assert got == [(1, "Ann Lee", "1 Elm", "Oz", 1), (2, "Bob Ray", "2 Oak", "Brill", 2)]


def test_film_list_has_a_row_per_film_and_category_name(rental_shop):
    got = rows(marts.film_list(*of(rental_shop, FILM)), "FID", "category", "actors")
    # Film 3 is filed under two categories of one name, so its actor is listed twice.
    assert got == [
        (1, "Action", "ADA KAY, UMA LEE WONG"),
        (2, "Action", "UMA LEE WONG"),
        (2, "Drama", "UMA LEE WONG"),
        (3, "Drama", "ADA KAY, ADA KAY"),
    ]


def test_film_list_in_parts_holds_the_same_names(rental_shop):
    parts = marts.film_list(*of(rental_shop, FILM), in_parts=True).orderBy("part").collect()
    whole = {}
    for row in parts:
        whole.setdefault((row["FID"], row["category"]), []).append(row["actors"])
    lists = {(r["FID"], r["category"]): r["actors"] for r in marts.film_list(*of(rental_shop, FILM)).collect()}
    assert {key: ", ".join(texts) for key, texts in whole.items()} == lists


def test_film_list_capitalised_keeps_later_words_small(rental_shop):
    got = rows(marts.film_list_capitalised(*of(rental_shop, FILM)), "FID", "category", "actors")
    assert got[0] == (1, "Action", "Ada Kay, Uma Lee wong")


def test_actor_info(rental_shop):
    got = rows(
        marts.actor_info(*of(rental_shop, ["actor", "film_actor", "film", "film_category", "category"])),
        "actor_id",
        "film_info",
    )
    assert got == [
        (1, "Action: ALPHA, BETA; Drama: BETA"),
        # Two categories of one name give one text twice; equal texts are listed once.
        (2, "Action: ALPHA; Drama: GAMMA"),
        (3, None),
        (4, None),
    ]


def test_results_do_not_depend_on_adaptive_execution(without_adaptive_execution, rental_shop):
    names = ["actor", "film_actor", "film", "film_category", "category"]
    assert rows(marts.actor_info(*of(rental_shop, names)), "actor_id", "film_info") == [
        (1, "Action: ALPHA, BETA; Drama: BETA"),
        (2, "Action: ALPHA; Drama: GAMMA"),
        (3, None),
        (4, None),
    ]
    assert rows(marts.film_list(*of(rental_shop, FILM)), "FID", "category", "actors")[2:] == [
        (2, "Drama", "UMA LEE WONG"),
        (3, "Drama", "ADA KAY, ADA KAY"),
    ]


def test_sales_by_store_leaves_out_payments_without_rental(rental_shop):
    got = marts.sales_by_store(
        *of(rental_shop, ["payment", "rental", "inventory", "store", "staff", *PLACES])
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Oz,Avalon", "Ann Lee", Decimal("3.98")),
        ("Brill,Borduria", "Bob Ray", Decimal("11.00")),
    ]


def test_sales_by_category_counts_a_film_in_each_of_its_categories(rental_shop):
    got = marts.sales_by_film_category(
        *of(rental_shop, ["payment", "rental", "inventory", "film", "film_category", "category"])
    ).collect()
    # Drama: film 2 once (5.00) and film 3 twice (5.00 and 1.00, by two categories of that name).
    assert [tuple(r) for r in got] == [("Drama", Decimal("17.00")), ("Action", Decimal("8.98"))]


def test_views_answer_sql(spark, rental_shop):
    made = marts.register_views(rental_shop)
    assert len(made) == 7
    got = spark.sql("SELECT name FROM staff_list WHERE country = 'Borduria'").collect()
    assert [r["name"] for r in got] == ["Bob Ray"]
    assert spark.sql("SELECT count(*) AS n FROM actor_info WHERE film_info IS NULL").first()["n"] == 2


@pytest.fixture
def lakehouse(rental_shop):
    customers = rental_shop["customer"].withColumnRenamed("customer_id", "customer_key")
    copies = rental_shop["inventory"].join(rental_shop["film"], "film_id").withColumnRenamed("inventory_id", "inventory_key")
    facts = rental_shop["rental"].withColumnsRenamed({"customer_id": "customer_key", "inventory_id": "inventory_key"})
    return facts, customers, copies


def test_gold_merges_namesakes_and_orders_by_total(lakehouse):
    got = [tuple(r) for r in gold.customer_spend(*lakehouse).collect()]
    assert got == [("SMITH", 4, Decimal("9.96")), ("NG", 1, Decimal("4.99"))]


def test_gold_by_key_keeps_namesakes_apart(lakehouse):
    facts, _, copies = lakehouse
    assert rows(gold.customer_spend_by_key(facts, copies)) == [
        (1, 2, Decimal("1.98")),
        (2, 2, Decimal("7.98")),
        (3, 1, Decimal("4.99")),
    ]
