"""Gold: what customers rented and spent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlake.operators.joins import lookup_join


def customer_spend(fact: DataFrame, customers: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rentals and money per customer last name, highest total first.

    Customers with one last name are one row. Totals are built per customer key
    before the customer dimension is joined, so that join meets one row per key.
    """
    per_key = customer_spend_by_key(fact, inventory)
    named = per_key.join(customers.select("customer_key", "last_name"), "customer_key")
    return (
        named.groupBy(F.col("last_name").alias("customer_name"))
        .agg(
            F.sum("total_rental_quantity").alias("total_rental_quantity"),
            F.sum("total_rental_price").alias("total_rental_price"),
        )
        .orderBy(F.desc("total_rental_price"), "customer_name")
    )


def customer_spend_by_key(fact: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rentals and money per customer key; namesakes stay apart."""
    rented = lookup_join(
        fact.select("customer_key", "inventory_key"),
        inventory.select("inventory_key", "rental_rate"),
        "inventory_key",
    )
    return rented.groupBy("customer_key").agg(
        F.count("inventory_key").alias("total_rental_quantity"),
        F.sum("rental_rate").alias("total_rental_price"),
    )
