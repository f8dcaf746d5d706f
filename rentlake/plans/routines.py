"""Business rules of the rental desk, answered for all customers or copies at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.functions import days_between, month_before
from rentlake.operators.joins import lookup_join
from rentlake.operators.ordered import running_totals


def rewards_report(
    payment: DataFrame,
    customer: DataFrame,
    min_purchases: int,
    min_amount: float | str,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Customers who paid more than `min_amount` in more than `min_purchases` payments
    during the calendar month before `as_of` (today if not given)."""
    if min_purchases == 0:
        raise ValueError("the minimum number of monthly purchases must be above 0")
    if float(min_amount) == 0:
        raise ValueError("the minimum monthly amount must be above 0.00")
    start, end = month_before(as_of)
    best = (
        payment.where((F.col("payment_date") >= start) & (F.col("payment_date") < end))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("spent"), F.count(F.lit(1)).alias("purchases"))
        .where((F.col("spent") > F.lit(str(min_amount)).cast("decimal(10,2)")) & (F.col("purchases") > min_purchases))
    )
    return customer.join(best.select("customer_id"), "customer_id", "left_semi").select(*customer.columns)


def rewardee_count(
    payment: DataFrame,
    customer: DataFrame,
    min_purchases: int,
    min_amount: float | str,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """How many customers the rewards report lists, as one row."""
    report = rewards_report(payment, customer, min_purchases, min_amount, as_of)
    return report.agg(F.count(F.lit(1)).alias("count_rewardees"))


def customer_balance(
    customer: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    payment: DataFrame,
    as_of: dt.datetime | str,
) -> DataFrame:
    """What every customer owes at a moment: rental fees, plus one per day kept beyond
    the film's rental time, minus payments. Customers without either owe 0, and so do
    unknown ids, since `customer` may be any list of customer ids.

    Charges and payments are one stream of signed amounts, so there is one
    aggregation and one join instead of one per kind.
    """
    moment = F.lit(str(as_of)).cast("timestamp_ntz")
    rented, paid = rental.where(F.col("rental_date") <= moment), payment.where(F.col("payment_date") <= moment)
    owed = _amounts(rented, inventory, film, paid, keys_in=rental).groupBy("customer_id").agg(F.sum("amount").alias("balance"))
    return (
        customer.select("customer_id")
        .join(owed, "customer_id", "left")
        .select("customer_id", F.coalesce("balance", F.lit(0)).alias("balance"))
    )


def _amounts(rental: DataFrame, inventory: DataFrame, film: DataFrame, payment: DataFrame, keys_in: DataFrame) -> DataFrame:
    """(customer_id, at, amount): fees of rentals with the time of the rental, payments below zero with theirs."""
    copies = lookup_join(
        inventory.select("inventory_id", "film_id"),
        film.select("film_id", "rental_duration", "rental_rate"),
        "film_id",
    ).select("inventory_id", "rental_duration", "rental_rate")
    rented = rental.select("customer_id", "inventory_id", "rental_date", "return_date")
    kept = days_between(F.col("return_date"), F.col("rental_date"))
    late = F.when(kept > F.col("rental_duration"), kept - F.col("rental_duration")).otherwise(0)
    charges = lookup_join(rented, copies, "inventory_id", keys_in=keys_in).select(
        "customer_id", F.col("rental_date").alias("at"), (F.col("rental_rate") + late).alias("amount")
    )
    payments = payment.select("customer_id", F.col("payment_date").alias("at"), (-F.col("amount")).alias("amount"))
    return charges.unionByName(payments)


def customer_balances(
    questions: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame, payment: DataFrame
) -> DataFrame:
    """What a customer owed at each of many moments: `questions` (customer_id, as_of) with `balance`.

    The answers are those of `customer_balance` at each moment, in one sorted pass over all
    amounts and questions: a question is a row without an amount, after all rows of its
    moment, and its running total is the answer. The work follows amounts and questions,
    not their product. A question asked twice is answered twice.
    """
    each = _amounts(rental, inventory, film, payment, keys_in=rental)
    # One row for all amounts of a customer at a moment; the lines of an order have both in common.
    amounts = each.groupBy("customer_id", "at").agg(F.sum("amount").alias("amount"))
    none = F.lit(None).cast(amounts.schema["amount"].dataType)
    asked = questions.select("customer_id", F.col("as_of").cast("timestamp_ntz").alias("at"), none.alias("amount"), F.lit(1).alias("asked"))
    rows = amounts.withColumn("asked", F.lit(0)).unionByName(asked)
    totals = running_totals(rows, ["customer_id"], ["at", "asked"], "amount", "balance")
    balance = F.col("balance").cast(amounts.schema["amount"].dataType)
    return totals.where("asked = 1").select("customer_id", F.col("at").alias("as_of"), balance.alias("balance"))


def open_rentals(rental: DataFrame) -> DataFrame:
    """One row per copy that is out: how often, and to whom (the smallest customer id).

    Combined before the shuffle, so a copy named by very many rows is one row in
    every join that follows.
    """
    return (
        rental.where(F.col("return_date").isNull())
        .groupBy("inventory_id")
        .agg(F.count(F.lit(1)).alias("n_open"), F.min("customer_id").alias("customer_id"))
    )


def inventory_in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every copy with TRUE if no rental of it is open.

    `inventory` may be any list of copy ids; a copy nobody knows is in stock.
    """
    out = _copies_out(rental).withColumn("out", F.lit(True))
    return (
        inventory.select("inventory_id")
        .join(out, "inventory_id", "left")
        .select("inventory_id", F.col("out").isNull().alias("in_stock"))
    )


def film_in_stock(
    inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None
) -> DataFrame:
    """Copies on the shelf, of one film and store if these are given."""
    return _wanted(inventory, film_id, store_id).join(_copies_out(rental), "inventory_id", "left_anti")


def film_not_in_stock(
    inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None
) -> DataFrame:
    """Copies that are out, of one film and store if these are given."""
    return _wanted(inventory, film_id, store_id).join(_copies_out(rental), "inventory_id", "left_semi")


def stock_counts(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Copies on the shelf and copies out for every film and store."""
    copies = inventory.select("film_id", "store_id", "inventory_id")
    flagged = copies.join(_copies_out(rental).withColumn("out", F.lit(True)), "inventory_id", "left")
    return flagged.groupBy("film_id", "store_id").agg(
        F.count_if(F.col("out").isNull()).alias("n_in_stock"), F.count_if(F.col("out")).alias("n_out")
    )


def inventory_held_by_customer(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every copy with the customer who has it (NULL if none) and its open rentals."""
    return (
        inventory.select("inventory_id")
        .join(open_rentals(rental), "inventory_id", "left")
        .select("inventory_id", "customer_id", F.coalesce("n_open", F.lit(0)).alias("n_open"))
    )


def _copies_out(rental: DataFrame) -> DataFrame:
    return rental.where(F.col("return_date").isNull()).select("inventory_id").distinct()


def _wanted(inventory: DataFrame, film_id: int | None, store_id: int | None) -> DataFrame:
    wanted: Column = F.lit(True)
    if film_id is not None:
        wanted = wanted & (F.col("film_id") == film_id)
    if store_id is not None:
        wanted = wanted & (F.col("store_id") == store_id)
    return inventory.where(wanted).select("inventory_id")
