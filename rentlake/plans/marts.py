"""The reporting views of the rental business as DataFrames.

Money is summed by key as early as possible, so that joins to inventory, film,
store and labels meet one row per key. Those are plain joins; where many rows may
share a key, `lookup_join` spreads them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.functions import capitalise, full_name, ordered_concat, ordered_parts
from rentlake.operators.joins import hot_keys, lookup_join, salted_join
from rentlake.operators.ordered import assembled_concat


def _places(address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Addresses with the names of their city and country."""
    cities = lookup_join(city.select("city_id", "city", "country_id"), country.select("country_id", "country"), "country_id")
    return lookup_join(address.select("address_id", "address", "postal_code", "phone", "city_id"), cities, "city_id")


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Customers with address, place and an 'active' note."""
    people = customer.select(
        F.col("customer_id").alias("ID"),
        full_name("first_name", "last_name").alias("name"),
        F.when(F.col("active"), "active").otherwise("").alias("notes"),
        F.col("store_id").alias("SID"),
        "address_id",
    )
    located = lookup_join(people, _places(address, city, country), "address_id")
    return located.select(
        "ID", "name", "address", F.col("postal_code").alias("zip code"), "phone", "city", "country", "notes", "SID"
    )


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Staff with address and place."""
    people = staff.select(
        F.col("staff_id").alias("ID"),
        full_name("first_name", "last_name").alias("name"),
        F.col("store_id").alias("SID"),
        "address_id",
    )
    located = lookup_join(people, _places(address, city, country), "address_id")
    return located.select(
        "ID", "name", "address", F.col("postal_code").alias("zip code"), "phone", "city", "country", "SID"
    )


def film_list(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    name: Callable[[], Column] | None = None,
    in_parts: bool = False,
    assembled: bool = False,
) -> DataFrame:
    """One row per film and category name with the film's actors, in name order.

    Films without a category or without actors are left out. The group keeps only
    keys and names while it is built; the film's own columns are joined at the end.
    `in_parts` gives a long list as several rows, numbered by `part`, none of which
    outgrows a shuffle partition; `assembled` sorts long lists in many tasks and gives
    the same texts as without it.
    """
    actor_name = name() if name else full_name("first_name", "last_name")
    build = ordered_parts if in_parts else assembled_concat if assembled else ordered_concat
    labelled = lookup_join(
        film_category.select("film_id", "category_id"),
        category.select("category_id", F.col("name").alias("category")),
        "category_id",
    ).select("film_id", "category")
    cast_members = lookup_join(
        film_actor.select("film_id", "actor_id"), actor.select("actor_id", actor_name.alias("actors")), "actor_id"
    )
    rows = lookup_join(cast_members, labelled, "film_id", keys_in=film_actor)
    lists = build(rows, ["film_id", "category"], "actors", ["actors", "actor_id"], ", ", "actors")
    films = film.select(
        "film_id", "title", "description", F.col("rental_rate").alias("price"), "length", "rating"
    )
    columns = ["title", "description", "category", "price", "length", "rating", *(["part"] if in_parts else []), "actors"]
    return lists.join(films, "film_id").select(F.col("film_id").alias("FID"), *columns)


def film_list_capitalised(
    film: DataFrame, film_category: DataFrame, category: DataFrame, film_actor: DataFrame, actor: DataFrame
) -> DataFrame:
    """The film list with actor names written `First Last`."""
    return film_list(
        film,
        film_category,
        category,
        film_actor,
        actor,
        lambda: full_name(capitalise("first_name"), capitalise("last_name")),
    )


def sales_by_store(
    payment: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    store: DataFrame,
    staff: DataFrame,
    address: DataFrame,
    city: DataFrame,
    country: DataFrame,
) -> DataFrame:
    """Money taken per store with the store's place and manager, by country and city."""
    by_store = (
        _paid_by_copy(payment, rental)
        .join(inventory.select("inventory_id", "store_id"), "inventory_id")
        .groupBy("store_id")
        .agg(F.sum("paid").alias("total_sales"))
    )
    managers = staff.select(
        F.col("staff_id").alias("manager_staff_id"), full_name("first_name", "last_name").alias("manager")
    )
    stores = lookup_join(store.select("store_id", "manager_staff_id", "address_id"), managers, "manager_staff_id")
    stores = lookup_join(stores, _places(address, city, country), "address_id")
    return (
        by_store.join(stores, "store_id")
        .orderBy("country", "city", "store_id")
        .select(F.concat("city", F.lit(","), "country").alias("store"), "manager", "total_sales")
    )


def sales_by_film_category(
    payment: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
) -> DataFrame:
    """Money taken per category, largest first; a film counts in each of its categories."""
    by_film = (
        _paid_by_copy(payment, rental)
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("paid").alias("paid"))
    )
    known = by_film.join(film.select("film_id"), "film_id")
    labelled = known.join(film_category.select("film_id", "category_id"), "film_id")
    by_category = labelled.groupBy("category_id").agg(F.sum("paid").alias("paid"))
    names = category.select("category_id", F.col("name").alias("category"))
    return (
        by_category.join(names, "category_id")
        .groupBy("category")
        .agg(F.sum("paid").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "category")
    )


def _paid_by_copy(payment: DataFrame, rental: DataFrame) -> DataFrame:
    """Money per copy; payments that name no rental are left out."""
    paid = payment.where(F.col("rental_id").isNotNull()).select("rental_id", "amount")
    rented = lookup_join(paid, rental.select("rental_id", "inventory_id"), "rental_id")
    return rented.groupBy("inventory_id").agg(F.sum("amount").alias("paid"))


def _filed_appearances(film_actor: DataFrame, film: DataFrame, film_category: DataFrame) -> DataFrame:
    """Actor, category and title of every appearance.

    Two shuffle joins in a row on one key leave no shuffle that adaptive execution could
    split, so films with very many actors are salted, at any size.
    """
    appearances = film_actor.select("actor_id", "film_id")
    films = lookup_join(film_category.select("film_id", "category_id"), film.select("film_id", "title"), "film_id")
    return salted_join(appearances, films, ["film_id"], "inner", hot_keys(appearances, "film_id"))


def actor_info(
    actor: DataFrame,
    film_actor: DataFrame,
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    assembled: bool = False,
) -> DataFrame:
    """Actors with `Category: title, title; Category: title`; NULL where there is no film.

    `assembled` sorts long lists of titles in many tasks; an actor's sections are no more
    than there are categories, and need no such care.
    """
    filed = _filed_appearances(film_actor, film, film_category)
    build = assembled_concat if assembled else ordered_concat
    titles = build(filed, ["actor_id", "category_id"], "title", ["title", "film_id"], ", ", "titles")
    sections = (
        lookup_join(titles, category.select("category_id", "name"), "category_id", keys_in=film_category)
        .select("actor_id", "name", F.concat("name", F.lit(": "), "titles").alias("film_info"))
        .distinct()
    )
    infos = ordered_concat(sections, ["actor_id"], "film_info", ["name", "film_info"], "; ", "film_info")
    return actor.select("actor_id", "first_name", "last_name").join(infos, "actor_id", "left")


def actor_info_parts(
    actor: DataFrame, film_actor: DataFrame, film: DataFrame, film_category: DataFrame, category: DataFrame
) -> DataFrame:
    """The titles of each actor and category as numbered pieces, none larger than a partition."""
    filed = _filed_appearances(film_actor, film, film_category)
    named = lookup_join(filed, category.select("category_id", "name"), "category_id", keys_in=film_category)
    parts = ordered_parts(named, ["actor_id", "category_id", "name"], "title", ["title", "film_id"], ", ", "titles")
    people = actor.select("actor_id", "first_name", "last_name")
    return lookup_join(parts, people, "actor_id").select(
        "actor_id", "first_name", "last_name", "category_id", "name", "part", "titles"
    )


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Register every view whose source tables are given; returns the view names."""
    views = {
        "customer_list": (customer_list, ["customer", "address", "city", "country"]),
        "staff_list": (staff_list, ["staff", "address", "city", "country"]),
        "film_list": (film_list, ["film", "film_category", "category", "film_actor", "actor"]),
        "nicer_but_slower_film_list": (
            film_list_capitalised,
            ["film", "film_category", "category", "film_actor", "actor"],
        ),
        "sales_by_store": (
            sales_by_store,
            ["payment", "rental", "inventory", "store", "staff", "address", "city", "country"],
        ),
        "sales_by_film_category": (
            sales_by_film_category,
            ["payment", "rental", "inventory", "film", "film_category", "category"],
        ),
        "actor_info": (actor_info, ["actor", "film_actor", "film", "film_category", "category"]),
    }
    made = []
    for view, (build, needs) in views.items():
        if all(t in tables for t in needs):
            build(*[tables[t] for t in needs]).createOrReplaceTempView(view)
            made.append(view)
    return made
