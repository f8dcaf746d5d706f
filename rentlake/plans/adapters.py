"""The sample star schema seen as rental tables.

customer = customer, film = part, staff = actor = supplier, store = nation,
city = nation, country = language = region, rental = payment = order line. A copy is a
part of one supplier, kept in the supplier's nation, so a film has many copies in many
stores. A rental is known by its line, and paid with the price of that line. A film is
filed under its type and its brand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlake.functions import calendar
from rentlake.operators.joins import lookup_join
from rentlake.operators.slices import shuffles_released

MONEY = "decimal(12,2)"
# Lines of kind N/O shipped after this moment count as not yet returned.
STILL_OUT_AFTER = "2001-06-01 00:00:00"


class RentalData:
    """The tables of one sample folder; every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        """A table as stored; its footer is read once however often it is used."""
        if table not in self._read:
            self._read[table] = self.spark.read.parquet(self.file(table))
        return self._read[table]

    def file(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def stream_path(self, table: str) -> str:
        """A glob that names the table, be it one file or a folder of files."""
        return f"{self.folder}/{table}.parque[t]"

    @property
    def country(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"))

    @property
    def city(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
        )

    @property
    def address(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.alias("address_id"),
            F.concat(F.lit("1 "), F.col("n_name")).alias("address"),
            F.lit(None).cast("string").alias("address2"),
            F.col("n_name").alias("district"),
            key.alias("city_id"),
            key.cast("string").alias("postal_code"),
            F.concat(F.lit("+"), key.cast("string")).alias("phone"),
        )

    @property
    def store(self) -> DataFrame:
        managers = self.raw("supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_staff_id"))
        return managers.select(
            F.col("s_nationkey").alias("store_id"), "manager_staff_id", F.col("s_nationkey").alias("address_id")
        )

    @property
    def customer(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("store_id"),
            _word(F.col("c_name"), 1).alias("first_name"),
            _word(F.col("c_name"), 2).alias("last_name"),
            F.concat(F.col("c_name"), F.lit("@"), F.lower("c_mktsegment")).alias("email"),
            F.col("c_nationkey").alias("address_id"),
            (F.col("c_acctbal") > 0).alias("active"),
        )

    @property
    def customer_table(self) -> DataFrame:
        """Customers with the day of their first order, where they have one."""
        first = self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").alias("create_date"))
        return self.customer.join(first, "customer_id", "left")

    @property
    def source_tables(self) -> dict[str, DataFrame]:
        """All tables with declared rules."""
        names = (
            "actor address category city country film film_actor film_category film_text inventory language "
            "payment rental staff store"
        )
        return {**{name: getattr(self, name) for name in names.split()}, "customer": self.customer_table}

    @property
    def staff(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            _word(F.col("s_name"), 1).alias("first_name"),
            _word(F.col("s_name"), 2).alias("last_name"),
            F.col("s_nationkey").alias("address_id"),
            F.col("s_name").alias("email"),
            F.col("s_nationkey").alias("store_id"),
            (F.col("s_acctbal") > 0).alias("active"),
        )

    @property
    def actor(self) -> DataFrame:
        return self.staff.select(F.col("staff_id").alias("actor_id"), F.upper("first_name").alias("first_name"), "last_name")

    @property
    def language(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("language_id"), F.col("r_name").alias("name"))

    @property
    def film(self) -> DataFrame:
        price, size = F.col("p_retailprice").cast(MONEY), F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.concat("p_brand", F.lit(" "), "p_type").alias("description"),
            (size + 1970).alias("release_year"),
            (size % 5).alias("language_id"),
            F.when(size % 3 == 0, size % 7).alias("original_language_id"),
            size.alias("rental_duration"),
            price.alias("rental_rate"),
            size.alias("length"),
            price.alias("replacement_cost"),
            F.col("p_brand").alias("rating"),
            F.when(size % 2 == 0, "Trailers,Commentaries").when(size % 3 == 0, "Trailers,Bloopers").alias("special_features"),
        )

    @property
    def category(self) -> DataFrame:
        return self.film_category.select("category_id", F.col("category_id").alias("name")).distinct()

    @property
    def film_category(self) -> DataFrame:
        labels = F.explode(F.array("p_type", "p_brand")).alias("category_id")
        return self.raw("part").select(F.col("p_partkey").alias("film_id"), labels)

    @property
    def film_actor(self) -> DataFrame:
        pairs = self.raw("lineitem").select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id"))
        return pairs.distinct()

    @property
    def inventory(self) -> DataFrame:
        """One copy per part and supplier, in the store of the supplier's nation."""
        copies = self.raw("lineitem").select("l_partkey", "l_suppkey").distinct()
        homes = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id"))
        return lookup_join(copies, homes, "l_suppkey").select(
            _copy_id().alias("inventory_id"), F.col("l_partkey").alias("film_id"), "store_id"
        )

    @property
    def order_lines(self) -> DataFrame:
        """Order lines with customer and date of their order; what is derived from a line is left for later, as it is wider."""
        return self._order_lines(_out().alias("out"))

    def _order_lines(self, *more: Column) -> DataFrame:
        """Order lines as they are stored, or else with `more` columns of the line."""
        if "order_lines" in self._read:
            return self._read["order_lines"]
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            *more,
            "l_shipdate",
        )
        return lookup_join(lines, self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")

    def store_order_lines(self, path: str) -> RentalData:
        """Write the order lines once, for jobs that would join them again for each use of `rental` and `payment`."""
        lines = self.order_lines
        lines.write.option("compression", "zstd").parquet(path)
        self._read["order_lines"] = self.spark.read.schema(lines.schema).parquet(path)
        return self

    @property
    def payment(self) -> DataFrame:
        """One payment per rental: the price of its line, on the day of its order."""
        return self._order_lines().select(
            _rental_id("o_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("staff_id"),
            _rental_id("o_orderkey").alias("rental_id"),
            "amount",
            F.col("o_orderdate").alias("payment_date"),
        )

    @property
    def paid_lines(self) -> DataFrame:
        """Payments as far as order lines alone tell: no customer, no date. Every line has an order."""
        return self.raw("lineitem").select(
            _rental_id().alias("rental_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
        )

    @property
    def rental_lines(self) -> DataFrame:
        """Rentals as far as order lines alone tell: no customer, no rental date."""
        return self.raw("lineitem").select(
            _rental_id().alias("rental_id"),
            F.col("l_orderkey").alias("order_id"),
            _copy_id().alias("inventory_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.when(~_out(), F.col("l_shipdate")).alias("return_date"),
            F.col("l_shipdate").alias("modified_date"),
        )

    @property
    def rental(self) -> DataFrame:
        """Rental lines with the customer and date of their order."""
        return self.order_lines.select(
            _rental_id("o_orderkey").alias("rental_id"),
            _copy_id().alias("inventory_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.when(~F.col("out"), F.col("l_shipdate")).alias("return_date"),
            F.col("l_shipdate").alias("modified_date"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"),
        )

    @property
    def dates(self) -> DataFrame:
        """The calendar of all rental and return days."""
        rented = self.raw("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
        returned = self.raw("lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
        return calendar(rented.union(returned), "day")

    @property
    def dim_customers(self) -> DataFrame:
        return self.customer.select(F.col("customer_id").alias("customer_key"), "first_name", "last_name", "email")

    @property
    def dim_staff(self) -> DataFrame:
        return self.staff.select(
            F.col("staff_id").alias("staff_key"),
            "first_name",
            "last_name",
            "email",
            F.col("store_id").alias("store_key"),
            "active",
        )

    @property
    def dim_inventory(self) -> DataFrame:
        films = self.film.select(
            "film_id", "title", "release_year", "rental_duration", "rental_rate", "length", "replacement_cost", "rating"
        )
        copies = self.inventory.select(F.col("inventory_id").alias("inventory_key"), "film_id")
        return lookup_join(copies, films, "film_id").drop("film_id")

    @property
    def dims(self) -> dict[str, DataFrame]:
        """The dimensions of the silver join."""
        return {
            "customers": self.dim_customers,
            "staff": self.dim_staff,
            "inventory": self.dim_inventory,
            "dates": self.dates,
        }

    @property
    def facts(self) -> DataFrame:
        """Rentals in the layout of the raw files."""
        stores = self.staff.select("staff_id", "store_id")
        return lookup_join(self.rental, stores, "staff_id").select(
            F.col("rental_id").alias("rental_key"),
            F.col("customer_id").alias("customer_key"),
            F.col("staff_id").alias("staff_key"),
            F.col("store_id").alias("store_key"),
            F.col("inventory_id").alias("inventory_key"),
            "rental_date",
            "return_date",
            "modified_date",
        )

    @property
    def film_text(self) -> DataFrame:
        """Film titles with a description that is unknown for one brand."""
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.when(F.col("p_brand") != "Brand#2", F.col("p_type")).alias("description"),
        )

    @property
    def film_changes(self) -> DataFrame:
        """A change set over `film_text`, derived from what each film is.

        Economy films get a new description, small ones a new title and larger small
        ones a second one, promoted films move to a new key, large ones gain a copy
        under a new key, and finally every film of one brand is deleted.
        """
        part = self.raw("part")
        key, title = F.col("p_partkey"), F.col("p_name")
        text = F.when(F.col("p_brand") != "Brand#2", F.col("p_type"))
        moved = -key - 1
        kind = F.col("p_type")
        v1, v2 = F.concat(title, F.lit(" v1")), F.concat(title, F.lit(" v2"))
        gone = F.struct(F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(None).cast("string"))
        now = F.struct(key, title, text)
        last = F.when(kind == "PROMO", moved).otherwise(key)
        steps = F.array(
            F.when(kind == "ECONOMY", _change("update", 0, now, F.struct(key, title, F.lit("ECONOMY v2")))),
            F.when(kind == "SMALL", _change("update", 0, now, F.struct(key, v1, text))),
            F.when(
                (kind == "SMALL") & (F.col("p_size") > 25),
                _change("update", 1, F.struct(key, v1, text), F.struct(key, v2, text)),
            ),
            F.when(kind == "PROMO", _change("update", 0, now, F.struct(moved, title, text))),
            F.when(kind == "LARGE", _change("insert", 0, gone, F.struct(moved, title, text))),
            F.when(F.col("p_brand") == "Brand#1", _change("delete", 2, F.struct(last, title, text), gone)),
        )
        change = F.col("change")
        return part.select("p_partkey", F.explode(F.array_compact(steps)).alias("change")).select(
            change["op"].alias("op"),
            (F.col("p_partkey") * 3 + change["step"]).alias("seq"),
            *[
                change[side][c].alias(f"{side}_{c}")
                for side in ("old", "new")
                for c in ("film_id", "title", "description")
            ],
        )


def write_json_arrays(df: DataFrame, path: str, bytes_per_file: int = 32 << 20, compression: str = "none") -> str:
    """Write rows as JSON files of one array each, of about `bytes_per_file` at most before compression.

    Texts are added up within their task, so that no array outgrows its bound however the
    rows are distributed and however wide they are; one larger row is an array of its own.
    """
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return write_arrays_of(df.select(whole.alias("doc")), path, bytes_per_file, compression)


def write_arrays_of(docs: DataFrame, path: str, bytes_per_file: int = 32 << 20, compression: str = "none") -> str:
    """Write texts (a column `doc`), sound JSON or not, as the elements of such files.

    Texts stay in their task, which holds one array at a time.
    """
    lines = docs.select(F.col("doc").cast("binary")).mapInArrow(_arrays(bytes_per_file), "value string")
    with shuffles_released(docs.sparkSession):
        lines.write.option("maxRecordsPerFile", 1).option("compression", compression).text(path)
    return path


def _arrays(bytes_per_file: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def array_of(docs: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch({"value": pa.array([b"[" + b",".join(docs) + b"]"]).cast(pa.string())})

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc in batch.column(0).drop_null().to_pylist():
                if held and size + len(doc) > bytes_per_file:
                    yield array_of(held)
                    held, size = [], 0
                held.append(doc)
                size += len(doc) + 1
        if held:
            yield array_of(held)

    return arrays


def _copy_id() -> Column:
    """Part and supplier as one number, 32 bits for the supplier."""
    return F.shiftleft(F.col("l_partkey").cast("long"), 32).bitwiseOR(F.col("l_suppkey").cast("long"))


def _out() -> Column:
    """Is an order line still out?"""
    return (
        (F.col("l_returnflag") == "N")
        & (F.col("l_linestatus") == "O")
        & (F.col("l_shipdate") > F.lit(STILL_OUT_AFTER).cast("timestamp_ntz"))
    )


def _rental_id(order: str = "l_orderkey") -> Column:
    """What tells an order line from all others."""
    day = F.date_format("l_shipdate", "yyyyMMdd")
    return F.concat_ws("-", order, "l_linenumber", "l_partkey", "l_suppkey", day)


def _word(text: Column, number: int) -> Column:
    return F.split_part(text, F.lit("#"), F.lit(number))


def _change(op: str, step: int, old: Column, new: Column) -> Column:
    layout = "struct<film_id:bigint,title:string,description:string>"
    return F.struct(
        F.lit(op).alias("op"), F.lit(step).alias("step"), old.cast(layout).alias("old"), new.cast(layout).alias("new")
    )
