import datetime as dt
from decimal import Decimal

import pytest

from rentlake.functions import month_before
from rentlake.plans import routines
from tests.conftest import rows


def rewarded(shop, purchases, amount, as_of="2024-03-15"):
    return [r[0] for r in rows(routines.rewards_report(shop["payment"], shop["customer"], purchases, amount, as_of), "customer_id")]


def test_rewards_take_the_whole_month_before(rental_shop):
    # Customer 2 paid on the first and in the last second of February.
    assert rewarded(rental_shop, 1, "9.99") == [2]


def test_rewards_thresholds_are_strict(rental_shop):
    assert rewarded(rental_shop, 1, "10.00") == []
    assert rewarded(rental_shop, 2, "9.99") == []


def test_rewards_return_all_customer_columns(rental_shop):
    report = routines.rewards_report(rental_shop["payment"], rental_shop["customer"], 1, 5, "2024-03-31")
    assert report.columns == rental_shop["customer"].columns
    count = routines.rewardee_count(rental_shop["payment"], rental_shop["customer"], 1, 5, "2024-03-31")
    assert count.first()["count_rewardees"] == report.count() == 1


@pytest.mark.parametrize("purchases, amount", [(0, 5), (1, 0), (1, "0.00")])
def test_rewards_refuse_zero(rental_shop, purchases, amount):
    with pytest.raises(ValueError):
        rewarded(rental_shop, purchases, amount)


@pytest.mark.parametrize(
    "as_of, start, end",
    [
        ("2024-03-31", "2024-02-01", "2024-03-01"),
        ("2024-01-01", "2023-12-01", "2024-01-01"),
        ("2023-03-30", "2023-02-01", "2023-03-01"),
    ],
)
def test_month_before(spark, as_of, start, end):
    got = spark.range(1).select(*month_before(as_of)).first()
    assert [str(v) for v in got] == [start, end]


def test_rewards_without_a_day_mean_today(spark, rental_shop):
    today = dt.date.today()
    last_month = dt.datetime.combine(today.replace(day=1) - dt.timedelta(days=1), dt.time(23, 59, 59))
    payments = spark.createDataFrame(
        [(1, Decimal("9.00"), last_month), (1, Decimal("9.00"), last_month), (2, Decimal("99.00"), last_month)],
        "customer_id INT, amount DECIMAL(5,2), payment_date TIMESTAMP_NTZ",
    )
    got = routines.rewards_report(payments, rental_shop["customer"], 1, 5)
    assert rows(got, "customer_id") == [(1,)]


def balances(shop, as_of):
    names = ["customer", "rental", "inventory", "film", "payment"]
    return dict(rows(routines.customer_balance(*[shop[n] for n in names], as_of)))


def test_balance(rental_shop):
    # Customer 1: two copies of film 1 (0.99 each), one kept 5 days instead of 3, paid 3.98.
    # Customer 2: film 2 (2.99), returned in time, paid 10.00; the rental of March is not due yet.
    # Customer 3: film 3 (4.99), still out, so no late fee; paid 50.00. Customer 4: nothing.
    assert balances(rental_shop, "2024-02-29 23:59:59") == {
        1: Decimal("0.00"),
        2: Decimal("-7.01"),
        3: Decimal("-45.01"),
        4: Decimal("0.00"),
    }


def test_balance_counts_later_returns_but_not_later_rentals(rental_shop):
    # The return date is not cut: the copy rented in January is late by two days already.
    early = balances(rental_shop, "2024-01-30 23:59:00")
    assert early[1] == Decimal("2.99") and early[2] == Decimal("0.00")


def test_stock(rental_shop):
    inventory, rental = rental_shop["inventory"], rental_shop["rental"]
    shelf = rows(routines.film_in_stock(inventory, rental))
    out = rows(routines.film_not_in_stock(inventory, rental))
    assert (shelf, out) == ([(1,), (3,), (5,)], [(2,), (4,)])
    assert rows(routines.film_in_stock(inventory, rental, film_id=1, store_id=1)) == [(1,)]
    assert rows(routines.film_not_in_stock(inventory, rental, film_id=1, store_id=1)) == [(2,)]
    assert rows(routines.film_in_stock(inventory, rental, film_id=1, store_id=2)) == []
    flags = dict(rows(routines.inventory_in_stock(inventory, rental)))
    assert {k for k, v in flags.items() if v} == {k for k, in shelf}
    assert rows(routines.stock_counts(inventory, rental)) == [(1, 1, 1, 1), (2, 2, 1, 0), (3, 2, 0, 1), (4, 1, 1, 0)]


def test_holder(rental_shop):
    got = rows(routines.inventory_held_by_customer(rental_shop["inventory"], rental_shop["rental"]))
    assert got == [(1, None, 0), (2, 1, 1), (3, None, 0), (4, 2, 2), (5, None, 0)]


def test_unknown_ids(spark, rental_shop):
    # Any list of ids may be asked about: an unknown copy is in stock, an unknown customer owes nothing.
    ids = spark.createDataFrame([(99,)], "inventory_id INT")
    assert rows(routines.inventory_in_stock(ids, rental_shop["rental"])) == [(99, True)]
    assert rows(routines.inventory_held_by_customer(ids, rental_shop["rental"])) == [(99, None, 0)]
    people = spark.createDataFrame([(99,)], "customer_id INT")
    shop = {**rental_shop, "customer": people}
    assert balances(shop, "2024-02-29 23:59:59") == {99: Decimal("0.00")}
