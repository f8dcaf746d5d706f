"""Every operator run over the sample tables, with the SQL that must give the same rows.

Queries run over whole tables. Those that stage files, stream or write tables work in
a fresh folder below the one the session names in spark.checkpoint.dir.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlake.functions import calendar, capitalise
from rentlake.operators import changes, filters, integrity, ordered, profiles, reports, slices
from rentlake.operators.joins import lookup_join
from rentlake.plans import gold, marts, routines
from rentlake.plans.adapters import RentalData, write_arrays_of, write_json_arrays
from rentlake.plans.oracles import ORACLES
from rentlake.sources import dimensions, documents, files, salvage, splits, tables
from rentlake.sources.versions import BucketedTable
from rentlake.streaming import changes as change_stream
from rentlake.streaming import content, ingest, medallion, quarantine
from rentlake.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MONEY_SUM = "decimal(28,2)"
REWARDS = {"min_purchases": 1, "min_amount": 200000, "as_of": "1996-04-15"}
FILM_TEXT = ["title", "description"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(MONEY_SUM) for c in columns})


# ---- gold ----------------------------------------------------------------------


@query
def gold_customer_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return _money(gold.customer_spend(d.facts, d.dim_customers, d.dim_inventory), "total_rental_price")


@query
def gold_customer_spend_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return _money(gold.customer_spend_by_key(d.facts, d.dim_inventory), "total_rental_price")


# ---- reporting views -----------------------------------------------------------


@query
def customer_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.customer_list(d.customer, d.address, d.city, d.country)


@query
def staff_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.staff_list(d.staff, d.address, d.city, d.country)


@query
def film_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.film_list(d.film, d.film_category, d.category, d.film_actor, d.actor)


@query
def film_list_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film list, put together from the parts of its lists in their order."""
    d = RentalData(spark, sf_dir)
    parts = marts.film_list(d.film, d.film_category, d.category, d.film_actor, d.actor, in_parts=True)
    others = [c for c in parts.columns if c not in ("part", "actors")]
    return parts.groupBy(*others).agg(ordered.listed("actors", ["part"], ", ").alias("actors"))


@query
def film_list_capitalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.film_list_capitalised(d.film, d.film_category, d.category, d.film_actor, d.actor)


@query
def film_list_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film list, its long lists sorted in runs by many tasks."""
    d = RentalData(spark, sf_dir)
    return marts.film_list(d.film, d.film_category, d.category, d.film_actor, d.actor, assembled=True)


@query
def film_list_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every actor of the film list with its place there, read back from the runs and their offsets."""
    d = RentalData(spark, sf_dir)
    cast_members = lookup_join(d.film_actor, d.actor.select("actor_id", F.concat_ws(" ", "first_name", "last_name").alias("name")), "actor_id")
    runs = ordered.ordered_runs(cast_members, ["film_id"], "name", ["name", "actor_id"], ", ", "names")
    each = runs.select("film_id", "first_item", F.posexplode(F.split("names", ", ")).alias("at", "name"))
    return each.select("film_id", "name", (F.col("first_item") + F.col("at") + 1).alias("place"))


@query
def actor_info_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.actor_info(d.actor, d.film_actor, d.film, d.film_category, d.category, assembled=True)


@query
def actor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return marts.actor_info(d.actor, d.film_actor, d.film, d.film_category, d.category)


@query
def sales_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    sales = marts.sales_by_store(
        d.paid_lines, d.rental_lines, d.inventory, d.store, d.staff, d.address, d.city, d.country
    )
    return _money(sales, "total_sales")


@query
def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    sales = marts.sales_by_film_category(
        d.paid_lines, d.rental_lines, d.inventory, d.film, d.film_category, d.category
    )
    return _money(sales, "total_sales")


@query
def sales_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money by store and money paid for rentals, each summed up: they must agree."""
    d = RentalData(spark, sf_dir)
    sales = marts.sales_by_store(
        d.paid_lines, d.rental_lines, d.inventory, d.store, d.staff, d.address, d.city, d.country
    ).agg(F.sum("total_sales").alias("by_store"), F.lit(1).alias("one"))
    paid = d.payment.where("rental_id IS NOT NULL").agg(F.sum("amount").alias("paid"), F.lit(1).alias("one"))
    return _money(sales.join(paid, "one").drop("one"), "by_store", "paid")


@query
def actor_info_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles of every actor and category, put together from their parts in their order."""
    d = RentalData(spark, sf_dir)
    parts = marts.actor_info_parts(d.actor, d.film_actor, d.film, d.film_category, d.category)
    return parts.groupBy("actor_id", "name").agg(ordered.listed("titles", ["part"], ", ").alias("titles"))


def _views(spark: SparkSession, sf_dir: str) -> None:
    marts.register_views({**RentalData(spark, sf_dir).source_tables, "rental": RentalData(spark, sf_dir).rental_lines})


VIEW_QUERIES = {
    "views_in_sql": "SELECT country, notes, count(*) AS n_customers FROM customer_list GROUP BY country, notes",
    "view_staff_list": "SELECT * FROM staff_list",
    "view_film_list": "SELECT * FROM film_list",
    "view_film_list_capitalised": "SELECT * FROM nicer_but_slower_film_list",
    "view_sales_by_store": "SELECT store, manager, cast(total_sales AS decimal(28,2)) AS total_sales FROM sales_by_store",
    "view_sales_by_category": """SELECT category, cast(total_sales AS decimal(28,2)) AS total_sales
        FROM sales_by_film_category WHERE total_sales > 0""",
    "view_actor_info": "SELECT * FROM actor_info",
}


def _view_query(name: str) -> Query:
    def ask(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A registered view, asked in SQL."""
        _views(spark, sf_dir)
        return spark.sql(VIEW_QUERIES[name])

    ask.__name__ = name
    return ask


for _name in VIEW_QUERIES:
    query(_view_query(_name))


@query
def gold_customer_spend_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.places(gold_customer_spend(spark, sf_dir)).select("customer_name", "place")


@query
def sales_by_store_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.places(sales_by_store(spark, sf_dir)).select("store", "place")


@query
def sales_by_category_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.places(sales_by_category(spark, sf_dir)).select("category", "place")


@query
def document_find_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.places(document_find(spark, sf_dir)).select("event_id", "place")


@query
def orders_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by date, dearest first, each with its place."""
    orders = RentalData(spark, sf_dir).raw("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ordered.ranked(orders, ["o_orderdate", F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "place")


# ---- business rules ------------------------------------------------------------


@query
def rewards_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.rewards_report(d.payment, d.customer, **REWARDS)


@query
def rewards_report_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the month before today, over payments moved by whole months to lie there."""
    d = RentalData(spark, sf_dir)
    months = F.months_between(F.trunc(F.current_date(), "MM"), F.lit("1996-04-01").cast("date")).cast("int")
    day = F.add_months(F.to_date("payment_date"), months)
    moved = d.payment.withColumn("payment_date", day.cast("timestamp_ntz"))
    limits = {k: v for k, v in REWARDS.items() if k != "as_of"}
    return routines.rewards_report(moved, d.customer, **limits).select("customer_id", "store_id")


@query
def rewardee_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.rewardee_count(d.payment, d.customer, **REWARDS)


@query
def customer_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    owed = routines.customer_balance(d.customer, d.rental, d.inventory, d.film, d.payment, "1998-01-01 00:00:00")
    return _money(owed, "balance")


@query
def customer_balance_at_month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every customer owed at the end of every month in which something was ordered."""
    d = RentalData(spark, sf_dir).store_order_lines(Workspace(spark).path("order_lines"))
    last_day = F.last_day("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    ends = d.raw("orders").select(last_day.alias("as_of")).distinct().agg(F.collect_set("as_of").alias("ends"))  # one a month
    questions = d.customer.select("customer_id").join(F.broadcast(ends)).select("customer_id", F.explode("ends").alias("as_of"))
    return _money(routines.customer_balances(questions, d.rental, d.inventory, d.film, d.payment), "balance")


@query
def film_in_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.film_in_stock(d.inventory, d.rental_lines)


@query
def film_in_stock_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies of one film on the shelf of the first store that has any."""
    d = RentalData(spark, sf_dir)
    first = d.inventory.where("film_id = 7").agg(F.min("store_id").alias("store_id"))
    return routines.film_in_stock(lookup_join(d.inventory, first, "store_id", "left_semi"), d.rental_lines, film_id=7)


@query
def film_not_in_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.film_not_in_stock(d.inventory, d.rental_lines)


@query
def stock_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.stock_counts(d.inventory, d.rental_lines)


@query
def inventory_stock_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.inventory_in_stock(d.inventory, d.rental_lines)


@query
def inventory_holder(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return routines.inventory_held_by_customer(d.inventory, d.rental)


# ---- streams -------------------------------------------------------------------


def _bronze_events(spark: SparkSession, sf_dir: str, work: Workspace) -> str:
    d = RentalData(spark, sf_dir)
    source = ingest.stream_files(spark, d.stream_path("events"), d.raw("events").schema, fmt="parquet")
    table = work.table("bronze_events")
    ingest.append_to_table(ingest.with_lineage(source), table, work.path("checkpoint"), work.path("bronze"))
    return table


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = spark.table(_bronze_events(spark, sf_dir, Workspace(spark)))
    return bronze.drop("receipt_time", "source_file")


@query
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest run twice on one checkpoint: rows, and rows with lineage, per event type."""
    work = Workspace(spark)
    table = _bronze_events(spark, sf_dir, work)
    d = RentalData(spark, sf_dir)
    source = ingest.stream_files(spark, d.stream_path("events"), d.raw("events").schema, fmt="parquet")
    ingest.append_to_table(ingest.with_lineage(source), table, work.path("checkpoint"), work.path("bronze"))
    return (
        spark.table(table)
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("source_file").contains("events.parquet")).alias("n_with_file"),
            F.count("receipt_time").alias("n_with_time"),
        )
    )


@query
def bronze_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as JSON array files and streamed into a bronze table."""
    work = Workspace(spark)
    customers = RentalData(spark, sf_dir).raw("customer")
    write_json_arrays(customers, work.path("landing"))
    table = work.table("bronze_customers")
    medallion.run_bronze(
        spark, work.path("landing"), customers.schema, table, work.path("checkpoint"), work.path("bronze")
    )
    return spark.table(table).drop("receipt_time", "source_file")


def _bronze_rentals(d: RentalData, work: Workspace) -> str:
    """Rentals landed as raw files once, then streamed into bronze."""
    rentals = d.facts
    with slices.shuffles_released(d.spark):
        rentals.write.option("compression", "zstd").parquet(work.path("landing"))
    source = ingest.stream_files(d.spark, work.path("landing"), rentals.schema, fmt="parquet")
    table = work.table("bronze_rentals")
    ingest.append_to_table(ingest.with_lineage(source), table, work.path("bronze_checkpoint"), work.path("bronze"))
    return table


def _dims(d: RentalData, work: Workspace, *more: str) -> dict[str, DataFrame]:
    """The dimensions; the calendar is written once, not found again in every batch, and so are `more`."""
    dims = d.dims
    stored = {k: tables.replace_table(dims[k], work.table(f"dim_{k}"), work.path(f"dim_{k}")) for k in ("dates", *more)}
    return {**dims, **stored}


def _silver_rentals(d: RentalData, require_return: bool = True) -> DataFrame:
    work = Workspace(d.spark)
    bronze = _bronze_rentals(d, work)
    table = work.table("silver_rentals")
    medallion.run_silver(
        d.spark, bronze, _dims(d, work), table, work.path("silver_checkpoint"), work.path("silver"), require_return
    )
    return d.spark.table(table)


@query
def silver_stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_rentals(RentalData(spark, sf_dir)).drop("receipt_time", "source_file")


@query
def silver_with_open_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver that keeps rentals still out, as counts per staff member and return month."""
    silver = _silver_rentals(RentalData(spark, sf_dir), require_return=False)
    return silver.groupBy("staff_key", "return_month").agg(F.count(F.lit(1)).alias("n_rentals"))


@query
def silver_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows that silver loses and why."""
    work = Workspace(spark)
    d = RentalData(spark, sf_dir)
    bronze = spark.table(_bronze_rentals(d, work))
    lost = medallion.unmatched_rentals(bronze, **_dims(d, work))
    return lost.select(
        "rental_key", "inventory_key", "staff_key", "customer_key", F.array_join("missing", ",").alias("missing")
    )


def _silver_with_replay(d: RentalData, late: str, unknown: Column) -> DataFrame:
    """Silver built while some rows of a dimension were unknown, replayed twice once they came."""
    spark, work = d.spark, Workspace(d.spark)
    dims = _dims(d, work, "inventory")
    early = {**dims, late: dims[late].where(~unknown)}
    bronze = _bronze_rentals(d, work)
    medallion.run_silver_split(spark, bronze, early, work.path("silver"), work.path("silver_checkpoint"))
    schema = medallion.split_rentals(spark.table(bronze), **dims).schema
    whole, waiting = medallion.silver_of(spark, work.path("silver"), schema), work.path("silver")
    for number in (1, 2):
        path = work.path(f"replay_{number}")
        medallion.replay(medallion.quarantine_of(spark, waiting, schema), dims, path)
        whole, waiting = whole.unionByName(medallion.silver_of(spark, path, schema)), path
    return whole


@query
def silver_late_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built while furniture customers were unknown, then completed, per segment."""
    whole = _silver_with_replay(RentalData(spark, sf_dir), "customers", F.col("email").endswith("@furniture"))
    return whole.groupBy(F.split_part("customer_email", F.lit("@"), F.lit(2)).alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rentals"), F.sum("rental_rate").cast(MONEY_SUM).alias("total_rate")
    )


@query
def silver_late_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built while staff of odd keys were unknown, then completed, row by row."""
    whole = _silver_with_replay(RentalData(spark, sf_dir), "staff", F.col("staff_key") % 2 == 1)
    return whole.drop("receipt_time", "source_file")


@query
def silver_selective_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built without furniture customers and odd staff, completed as they arrive: customers in two parts, then staff."""
    d, work = RentalData(spark, sf_dir), Workspace(spark)
    dims = _dims(d, work, "inventory")
    odd, furniture = F.col("staff_key") % 2 == 1, F.col("email").endswith("@furniture")
    first = F.col("customer_key") % 3 == 0
    known = {**dims, "customers": dims["customers"].where(~furniture), "staff": dims["staff"].where(~odd)}
    bronze = _bronze_rentals(d, work)
    medallion.run_silver_split(spark, bronze, known, work.path("silver"), work.path("silver_checkpoint"))
    schema = medallion.split_rentals(spark.table(bronze), **dims).schema
    whole = medallion.silver_of(spark, work.path("silver"), schema)
    table = quarantine.filed(spark, work.path("waiting"), schema["rental"].dataType, 64)
    waiting = medallion.waiting_of(spark, work.path("silver"), schema)
    table.create(waiting, slices.slices_for(waiting.count()))
    version = 0
    for name, rows in (
        ("customers", dims["customers"].where(furniture & first)),
        ("customers", dims["customers"].where(furniture & ~first)),
        ("staff", dims["staff"].where(odd)),
    ):
        known[name] = known[name].unionByName(rows)
        path = work.path(f"replay_{version}")
        version = quarantine.replay_arrived(table, version, {name: rows}, known, path)
        whole = whole.unionByName(quarantine.completed(spark, path, schema))
    return whole.drop("receipt_time", "source_file")


@query
def lakehouse_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to dimension tables, raw files to bronze and silver over those tables, and gold as a table."""
    d, work = RentalData(spark, sf_dir), Workspace(spark)
    dims = {}
    for name, rows in d.dims.items():
        landing = work.path(f"landing_{name}")
        if name == "dates":
            kind = "csv"
            rows.write.option("header", True).csv(landing)
        else:
            kind = "json"
            write_json_arrays(rows, landing, compression="gzip")
        dims[name] = dimensions.load_dimension(
            spark, work.table(f"dim_{name}"), kind, landing, rows.schema, location=work.path(f"dim_{name}")
        )
    bronze, silver = _bronze_rentals(d, work), work.table("silver_rentals")
    medallion.run_silver(spark, bronze, dims, silver, work.path("silver_checkpoint"), work.path("silver"))
    spend = gold.customer_spend(spark.table(silver), dims["customers"], dims["inventory"])
    return tables.replace_table(_money(spend, "total_rental_price"), work.table("gold"), work.path("gold"))


@query
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as many small files in folders by type, then compacted."""
    work = Workspace(spark)
    events = RentalData(spark, sf_dir).raw("events")
    name = work.table("events")
    events.repartition(32).write.partitionBy("event_type").option("path", work.path("small")).saveAsTable(name)
    whole = tables.compact_table(spark, name, work.table("events_whole"), work.path("whole"), ["event_type"])
    return whole.select(*events.columns)


@query
def stream_corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as JSON arrays, and one file that is cut off: rows kept by whether they are broken."""
    work = Workspace(spark)
    customers = RentalData(spark, sf_dir).raw("customer")
    write_json_arrays(customers, work.path("landing"))
    cut = customers.agg(F.concat(F.lit('[{"c_custkey": '), F.max("c_custkey").cast("string")).alias("value"))
    cut.write.mode("append").text(work.path("landing"))
    stream = ingest.stream_files(spark, work.path("landing"), files.with_corrupt(customers.schema))
    table = work.table("corrupt")
    ingest.append_to_table(stream, table, work.path("checkpoint"), work.path("table"))
    broken = F.col(files.CORRUPT).isNotNull().alias("broken")
    return spark.table(table).groupBy(broken).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def stream_same_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as JSON arrays, then the same files again under other names, then a restart."""
    work = Workspace(spark)
    customers = RentalData(spark, sf_dir).raw("customer")
    write_json_arrays(customers, work.path("landing/first"), 64 << 10)
    table = work.table("contents")

    def take() -> None:
        content.ingest_contents(
            spark, work.path("landing/*"), customers.schema, table, work.path("checkpoint"), work.path("contents")
        )

    take()
    copies = spark.read.text(work.path("landing/first"))
    copies.write.option("maxRecordsPerFile", 1).text(work.path("landing/copies"))
    take()
    take()
    return salvage.good_rows(spark.table(table)).select(*customers.columns)


@query
def stream_salvaged_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as JSON arrays, some with a word for a balance, some without their end: what is kept, and why not."""
    work = Workspace(spark)
    customers = RentalData(spark, sf_dir).raw("customer")
    doc, key = F.to_json(F.struct(*customers.columns), {"ignoreNullFields": "false"}), F.col("c_custkey")
    faulty = (
        F.when(key % 50 == 7, F.regexp_replace(doc, '"c_acctbal":[^,]*', '"c_acctbal":"unknown"'))
        .when(key % 50 == 11, F.substring(doc, F.lit(1), F.length(doc) - 5))
        .otherwise(doc)
    )
    write_arrays_of(customers.select(faulty.alias("doc")), work.path("landing"), 64 << 10)
    table = work.table("salvaged")
    content.ingest_contents(
        spark, work.path("landing"), customers.schema, table, work.path("checkpoint"), work.path("salvaged")
    )
    found = spark.table(table)
    named = F.regexp_extract("element", r'"c_custkey":(\d+)', 1).cast("bigint")
    return found.select(
        F.coalesce("row.c_custkey", named).alias("c_custkey"), F.col("row.c_acctbal").alias("c_acctbal"), "reason"
    )


@query
def gold_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to bronze, silver and gold."""
    d = RentalData(spark, sf_dir)
    silver = _silver_rentals(d)
    return _money(gold.customer_spend(silver, d.dim_customers, d.dim_inventory), "total_rental_price")


# ---- sources and sinks ---------------------------------------------------------


@query
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).path("customers_csv")
    RentalData(spark, sf_dir).raw("customer").write.option("header", True).csv(path)
    # Inference picks the narrowest type that holds the values, which depends on the data.
    return dimensions.read_dimension(spark, "csv", path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query
def scan_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = RentalData(spark, sf_dir).raw("part")
    path = write_json_arrays(part, Workspace(spark).path("parts"))
    return dimensions.read_dimension(spark, "json", path, part.schema)


@query
def document_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dear purchases and clicks among the events, stored as documents."""
    events = RentalData(spark, sf_dir).raw("events")
    path = Workspace(spark).path("events")
    events.write.json(path)
    return documents.document_find(
        documents.read_documents(spark, path, events.schema),
        conditions={"event_type": {"$in": ["purchase", "click"]}, "value": {"$gte": 20.0}},
        projection=["event_id", "event_type", "user_id", "value"],
        sort=[("value", -1), ("event_id", 1)],
    )


@query
def replace_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections loaded twice from JSON files: documents per collection and key sum."""
    work = Workspace(spark)
    d = RentalData(spark, sf_dir)
    sources = {"inventory": d.raw("part"), "customers": d.raw("customer")}
    landed = {name: write_json_arrays(df, work.path(f"landing_{name}")) for name, df in sources.items()}
    schemas = {name: df.schema for name, df in sources.items()}
    for _ in range(2):
        documents.replace_collections(spark, landed, work.path("collections"), schemas)
    kept = {n: documents.read_documents(spark, work.path(f"collections/{n}"), fmt="parquet") for n in sources}
    return (
        kept["inventory"]
        .select(F.lit("inventory").alias("collection"), F.col("p_partkey").alias("key"))
        .unionByName(kept["customers"].select(F.lit("customers").alias("collection"), F.col("c_custkey").alias("key")))
        .groupBy("collection")
        .agg(F.count(F.lit(1)).alias("n_documents"), F.sum("key").alias("key_sum"))
    )


@query
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension table written twice holds its rows once."""
    work = Workspace(spark)
    d = RentalData(spark, sf_dir)
    name = work.table("dim_customers")
    for _ in range(2):
        tables.replace_table(d.dim_customers, name, work.path("dim_customers"))
    return spark.table(name)


@query
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second create must not change the table of the first."""
    work = Workspace(spark)
    supplier = RentalData(spark, sf_dir).raw("supplier")
    database = work.table("warehouse")
    tables.create_database(spark, database, "rental dimensions", work.path("db"), {"contains_pii": "true"})
    name = f"{database}.dim_staff"
    tables.create_table_if_absent(supplier, name, work.path("db/dim_staff"), "staff dimension")
    tables.create_table_if_absent(supplier.where("s_acctbal < 0"), name, comment="not written")
    return spark.table(name)


@query
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_profile(RentalData(spark, sf_dir).raw("orders"), exact=True)


@query
def table_profile_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass profile, without its estimated column."""
    return reports.table_profile(RentalData(spark, sf_dir).raw("orders")).drop("n_distinct")


@query
def profile_of_stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all orders from states stored month by month, and whether its estimates keep their bounds."""
    work = Workspace(spark)
    orders = RentalData(spark, sf_dir).raw("orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    for late in (False, True):  # an early load, and a later one that adds its months
        rows = orders.where((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) == F.lit(late))
        profiles.profile_state(rows, "month").write.mode("append").partitionBy("month").parquet(work.path("states"))
    fields = [f for f in orders.schema if f.name != "month"]
    found = profiles.merged_profile(spark.read.parquet(work.path("states")), fields)
    exact = reports.table_profile(orders.drop("month"), exact=True).select("column_name", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return found.join(exact, "column_name").select(
        "column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value", F.col("exact").alias("n_distinct"),
        near.alias("estimate_is_near"), F.coalesce(F.array_sort("quantiles") == F.col("quantiles"), F.lit(True)).alias("quantiles_in_order"),
    )


@query
def read_in_even_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines read by the predicates that a parallel scan would send, a hot part split by its orders."""
    lines = RentalData(spark, sf_dir).raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    skewed = lines.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")))
    parts = [
        skewed.where(p) for p in splits.even_predicates(skewed, "l_partkey", 12, "l_orderkey")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def preview_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = RentalData(spark, sf_dir).raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return reports.preview(orders, 5, [F.desc("o_totalprice"), "o_orderkey"])


# ---- functions -----------------------------------------------------------------


@query
def calendar_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(RentalData(spark, sf_dir).raw("orders"), "o_orderdate")


@query
def capitalised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = RentalData(spark, sf_dir).raw("part")
    return part.select("p_partkey", capitalise(F.upper("p_name")).alias("title"))


# ---- changes -------------------------------------------------------------------


@query
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return changes.apply_changes(d.film_text, d.film_changes, "film_id", FILM_TEXT)


@query
def apply_changes_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return changes.apply_changes(d.film_text, d.film_changes, "film_id", FILM_TEXT, null_safe=True)


@query
def apply_changes_absent_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change set over a table that lacks the films of one type: their updates do nothing."""
    d = RentalData(spark, sf_dir)
    economy = d.raw("part").where("p_type IN ('ECONOMY', 'PROMO')").selectExpr("p_partkey AS film_id")
    base = lookup_join(d.film_text, economy, "film_id", "left_anti")
    return changes.apply_changes(base, d.film_changes, "film_id", FILM_TEXT)


@query
def apply_changes_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change set over a bucketed table, in two versions: early changes, then late ones."""
    work = Workspace(spark)
    d = RentalData(spark, sf_dir)
    table = BucketedTable(spark, work.path("film_text"), d.film_text.schema, ["film_id"], 64)
    table.create(d.film_text)
    version = 0
    for part in ("seq % 3 = 0", "seq % 3 <> 0"):
        version = changes.apply_changes_by_bucket(table, version, d.film_changes.where(part), FILM_TEXT)
    return table.read(version)


@query
def apply_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change set landed as files and followed in several batches."""
    work = Workspace(spark)
    d = RentalData(spark, sf_dir)
    landed = d.film_changes
    landed.repartitionByRange(4, "seq").write.parquet(work.path("changes"))
    stream = ingest.stream_files(spark, work.path("changes"), landed.schema, fmt="parquet", maxFilesPerTrigger=2)
    change_stream.follow_changes(stream, work.path("events"), work.path("checkpoint"), "film_id", FILM_TEXT)
    return change_stream.current_table(spark, d.film_text, work.path("events"), "film_id", FILM_TEXT)


# ---- integrity -----------------------------------------------------------------


@query
def check_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.duplicate_keys(RentalData(spark, sf_dir).raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_pk_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return days as if they were a primary key: repeated ones, and none at all."""
    lines = RentalData(spark, sf_dir).rental_lines
    return integrity.primary_key_violations(lines.select(F.to_date("return_date").alias("return_day")), ["return_day"])


@query
def check_set_domain_of_pattern_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule with a separator that means something else in a pattern."""
    part = RentalData(spark, sf_dir).raw("part").withColumn("p_name", F.translate("p_name", " ", "|"))
    allowed = ["red", "blue", "small", "large", "bolt", "gear", "ring", "rod", "plate"]
    return integrity.violations(part, integrity.is_outside_set("p_name", allowed, "|")).select("p_partkey", "p_name")


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals sharing date, copy and customer."""
    return integrity.duplicate_keys(RentalData(spark, sf_dir).rental, ["rental_date", "inventory_id", "customer_id"])


@query
def check_fk_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir)
    return integrity.orphans(d.payment, "customer_id", d.customer, "customer_id").select("payment_id")


@query
def check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is not in the building segment."""
    d = RentalData(spark, sf_dir)
    building = d.raw("customer").where("c_mktsegment = 'BUILDING'")
    return integrity.orphans(d.raw("orders"), "o_custkey", building, "c_custkey").select("o_orderkey", "o_custkey")


@query
def check_fk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders, most of them told by a filter of the parent's keys."""
    d = RentalData(spark, sf_dir)
    building = d.raw("customer").where("c_mktsegment = 'BUILDING'")
    return filters.filtered_orphans(d.raw("orders"), "o_custkey", building, "c_custkey").select("o_orderkey", "o_custkey")


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open rentals, as rows that miss a return date."""
    missing = integrity.null_violations(RentalData(spark, sf_dir).rental_lines, ["return_date", "inventory_id"])
    return missing.select("rental_id", "inventory_id", F.array_join("null_columns", ",").alias("null_columns"))


@query
def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown descriptions replaced by a default."""
    return integrity.apply_defaults(RentalData(spark, sf_dir).film_text, {"description": "no description"})


@query
def check_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = RentalData(spark, sf_dir).raw("part")
    broken = integrity.is_outside_domain("p_type", ["ECONOMY", "MEDIUM", "STANDARD"])
    return integrity.violations(part, broken).select("p_partkey", "p_type")


@query
def check_set_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = RentalData(spark, sf_dir).raw("part")
    allowed = ["red", "blue", "small", "large", "bolt", "gear", "ring", "rod", "plate"]
    return integrity.violations(part, integrity.is_outside_set("p_name", allowed, " ")).select("p_partkey", "p_name")


@query
def check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = RentalData(spark, sf_dir).raw("customer")
    broken = integrity.is_outside_range("c_acctbal", 0, 5000) | integrity.is_not_decimal("c_acctbal", 6, 1)
    return integrity.violations(customer, broken).select("c_custkey", "c_acctbal")


@query
def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = RentalData(spark, sf_dir).raw("part")
    return integrity.violations(part, integrity.is_too_long("p_name", 10)).select("p_partkey", "p_name")


@query
def check_open_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.several_open_rentals(RentalData(spark, sf_dir).rental_lines)


@query
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = RentalData(spark, sf_dir).store_order_lines(Workspace(spark).path("order_lines"))
    return integrity.integrity_report(d.source_tables)


@query
def fk_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt that cannot be deleted because they have payments."""
    d = RentalData(spark, sf_dir)
    return integrity.restricted_deletes(_in_debt(d), "customer_id", d.payment, "customer_id")


@query
def fk_allowed_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt that can be deleted, since no payment from before 1996 refers to them."""
    d = RentalData(spark, sf_dir)
    holding = d.payment.where("payment_date < timestamp_ntz'1996-01-01 00:00:00'")
    return integrity.allowed_deletes(_in_debt(d), "customer_id", holding, "customer_id")


@query
def fk_allowed_staff_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff that can be deleted as far as stores tell, since they manage none."""
    d = RentalData(spark, sf_dir)
    return integrity.allowed_deletes(d.staff.select("staff_id"), "staff_id", d.store, "manager_staff_id")


def _in_debt(d: RentalData) -> DataFrame:
    return d.raw("customer").where("c_acctbal < 0").selectExpr("c_custkey AS customer_id")


@query
def fk_set_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments after the rentals of pending orders were deleted."""
    d = RentalData(spark, sf_dir)
    pending = d.raw("orders").where("o_orderstatus = 'P'").selectExpr("o_orderkey AS order_id")
    deleted = lookup_join(d.rental_lines.select("rental_id", "order_id"), pending, "order_id", "left_semi")
    left = integrity.set_null_on_delete(d.payment, "rental_id", deleted, "rental_id")
    return left.select("payment_id", "rental_id")


@query
def fk_set_null_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines after the pending orders were deleted; lines of other orders are not moved."""
    d = RentalData(spark, sf_dir)
    pending = d.raw("orders").where("o_orderstatus = 'P'").select("o_orderkey")
    lines = d.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return filters.filtered_set_null(lines, "l_orderkey", pending, "o_orderkey")


@query
def fk_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments after the customers of one segment got new keys."""
    d = RentalData(spark, sf_dir)
    moved = d.raw("customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey", "-c_custkey - 1 AS new_key")
    kept = integrity.cascade_key_update(d.payment, "customer_id", moved, "c_custkey", "new_key")
    return kept.select("payment_id", "customer_id")


# ---- pivot ---------------------------------------------------------------------


@query
def pivot_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = RentalData(spark, sf_dir).raw("orders")
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "other", "5-LOW": "low"}
    sums = reports.pivot_sum(
        orders, ["o_orderstatus"], "o_orderpriority", list(names), F.col("o_totalprice").cast("decimal(12,2)")
    )
    return _money(sums.withColumnsRenamed(names), *names.values())
