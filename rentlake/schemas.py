"""Table layouts and the rules the source system declares over them."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and nullability of the rental source tables.
# Unsigned integers use the next wider signed type.
SOURCE_TABLES = {
    "actor": "actor_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, last_update TIMESTAMP",
    "address": "address_id INT NOT NULL, address STRING NOT NULL, address2 STRING, district STRING NOT NULL, "
    "city_id INT NOT NULL, postal_code STRING, phone STRING NOT NULL, last_update TIMESTAMP",
    "category": "category_id SMALLINT NOT NULL, name STRING NOT NULL, last_update TIMESTAMP",
    "city": "city_id INT NOT NULL, city STRING NOT NULL, country_id INT NOT NULL, last_update TIMESTAMP",
    "country": "country_id INT NOT NULL, country STRING NOT NULL, last_update TIMESTAMP",
    "customer": "customer_id INT NOT NULL, store_id SMALLINT NOT NULL, first_name STRING NOT NULL, "
    "last_name STRING NOT NULL, email STRING, address_id INT NOT NULL, active BOOLEAN NOT NULL, "
    "create_date TIMESTAMP_NTZ NOT NULL, last_update TIMESTAMP",
    "film": "film_id INT NOT NULL, title STRING NOT NULL, description STRING, release_year INT, "
    "language_id SMALLINT NOT NULL, original_language_id SMALLINT, rental_duration SMALLINT NOT NULL, "
    "rental_rate DECIMAL(4,2) NOT NULL, length INT, replacement_cost DECIMAL(5,2) NOT NULL, rating STRING, "
    "special_features STRING, last_update TIMESTAMP",
    "film_actor": "actor_id INT NOT NULL, film_id INT NOT NULL, last_update TIMESTAMP",
    "film_category": "film_id INT NOT NULL, category_id SMALLINT NOT NULL, last_update TIMESTAMP",
    "film_text": "film_id INT NOT NULL, title STRING NOT NULL, description STRING",
    "inventory": "inventory_id INT NOT NULL, film_id INT NOT NULL, store_id SMALLINT NOT NULL, last_update TIMESTAMP",
    "language": "language_id SMALLINT NOT NULL, name STRING NOT NULL, last_update TIMESTAMP",
    "payment": "payment_id INT NOT NULL, customer_id INT NOT NULL, staff_id SMALLINT NOT NULL, rental_id INT, "
    "amount DECIMAL(5,2) NOT NULL, payment_date TIMESTAMP_NTZ NOT NULL, last_update TIMESTAMP",
    "rental": "rental_id INT NOT NULL, rental_date TIMESTAMP_NTZ NOT NULL, inventory_id INT NOT NULL, "
    "customer_id INT NOT NULL, return_date TIMESTAMP_NTZ, staff_id SMALLINT NOT NULL, last_update TIMESTAMP",
    "staff": "staff_id SMALLINT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
    "address_id INT NOT NULL, email STRING, store_id SMALLINT NOT NULL, active BOOLEAN NOT NULL, last_update TIMESTAMP",
    "store": "store_id SMALLINT NOT NULL, manager_staff_id SMALLINT NOT NULL, address_id INT NOT NULL, "
    "last_update TIMESTAMP",
}

# Column names and types of the lakehouse files and tables.
RAW_RENTALS = (
    "rental_key INT, customer_key INT, staff_key INT, store_key INT, inventory_key INT, "
    "rental_date TIMESTAMP, return_date TIMESTAMP, modified_date TIMESTAMP"
)
DIM_CUSTOMERS = "customer_key INT, first_name STRING, last_name STRING, email STRING"
DIM_STAFF = "staff_key INT, first_name STRING, last_name STRING, email STRING, store_key INT, active INT"
DIM_INVENTORY = (
    "inventory_key INT, title STRING, release_year INT, rental_duration INT, rental_rate DECIMAL(4,2), "
    "length INT, replacement_cost DECIMAL(5,2), rating STRING"
)
DIM_DATE = "Date DATE, MonthName STRING, WeekDayName STRING, Day INT, Year INT"

# Primary keys.
PRIMARY_KEYS = {
    "actor": ["actor_id"],
    "address": ["address_id"],
    "category": ["category_id"],
    "city": ["city_id"],
    "country": ["country_id"],
    "customer": ["customer_id"],
    "film": ["film_id"],
    "film_actor": ["actor_id", "film_id"],
    "film_category": ["film_id", "category_id"],
    "film_text": ["film_id"],
    "inventory": ["inventory_id"],
    "language": ["language_id"],
    "payment": ["payment_id"],
    "rental": ["rental_id"],
    "staff": ["staff_id"],
    "store": ["store_id"],
}

# Further unique keys.
UNIQUE_KEYS = {
    "rental": [["rental_date", "inventory_id", "customer_id"]],
    "store": [["manager_staff_id"]],
}

# Child table, child column, parent table, parent column, delete action.
FOREIGN_KEYS = [
    ("address", "city_id", "city", "city_id", "RESTRICT"),
    ("city", "country_id", "country", "country_id", "RESTRICT"),
    ("customer", "address_id", "address", "address_id", "RESTRICT"),
    ("customer", "store_id", "store", "store_id", "RESTRICT"),
    ("film", "language_id", "language", "language_id", "RESTRICT"),
    ("film", "original_language_id", "language", "language_id", "RESTRICT"),
    ("film_actor", "actor_id", "actor", "actor_id", "RESTRICT"),
    ("film_actor", "film_id", "film", "film_id", "RESTRICT"),
    ("film_category", "film_id", "film", "film_id", "RESTRICT"),
    ("film_category", "category_id", "category", "category_id", "RESTRICT"),
    ("inventory", "store_id", "store", "store_id", "RESTRICT"),
    ("inventory", "film_id", "film", "film_id", "RESTRICT"),
    ("payment", "rental_id", "rental", "rental_id", "SET NULL"),
    ("payment", "customer_id", "customer", "customer_id", "RESTRICT"),
    ("payment", "staff_id", "staff", "staff_id", "RESTRICT"),
    ("rental", "staff_id", "staff", "staff_id", "RESTRICT"),
    ("rental", "inventory_id", "inventory", "inventory_id", "RESTRICT"),
    ("rental", "customer_id", "customer", "customer_id", "RESTRICT"),
    ("staff", "store_id", "store", "store_id", "RESTRICT"),
    ("staff", "address_id", "address", "address_id", "RESTRICT"),
    ("store", "manager_staff_id", "staff", "staff_id", "RESTRICT"),
    ("store", "address_id", "address", "address_id", "RESTRICT"),
]

# Column defaults.
DEFAULTS = {
    "customer": {"active": True},
    "film": {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99", "rating": "G"},
    "staff": {"active": True},
}

# Allowed single values and allowed members of comma-separated sets.
DOMAINS = {"film": {"rating": ["G", "PG", "PG-13", "R", "NC-17"]}}
SET_DOMAINS = {
    "film": {"special_features": ["Trailers", "Commentaries", "Deleted Scenes", "Behind the Scenes"]}
}

# Longest text allowed per column.
LENGTHS = {
    "actor": {"first_name": 45, "last_name": 45},
    "address": {"address": 50, "address2": 50, "district": 20, "postal_code": 10, "phone": 20},
    "category": {"name": 25},
    "city": {"city": 50},
    "country": {"country": 50},
    "customer": {"first_name": 45, "last_name": 45, "email": 50},
    "film": {"title": 128},
    "film_text": {"title": 255},
    "language": {"name": 20},
    "staff": {"first_name": 45, "last_name": 45, "email": 50},
}

# Inclusive integer ranges (unsigned one, two and three byte columns).
TINY = (0, 255)
SMALL = (0, 65535)
MEDIUM = (0, 16777215)
RANGES = {
    "actor": {"actor_id": SMALL},
    "address": {"address_id": SMALL, "city_id": SMALL},
    "category": {"category_id": TINY},
    "city": {"city_id": SMALL, "country_id": SMALL},
    "country": {"country_id": SMALL},
    "customer": {"customer_id": SMALL, "store_id": TINY, "address_id": SMALL},
    "film": {
        "film_id": SMALL,
        "language_id": TINY,
        "original_language_id": TINY,
        "rental_duration": TINY,
        "length": SMALL,
    },
    "film_actor": {"actor_id": SMALL, "film_id": SMALL},
    "film_category": {"film_id": SMALL, "category_id": TINY},
    "inventory": {"inventory_id": MEDIUM, "film_id": SMALL, "store_id": TINY},
    "language": {"language_id": TINY},
    "payment": {"payment_id": SMALL, "customer_id": SMALL, "staff_id": TINY},
    "rental": {"inventory_id": MEDIUM, "customer_id": SMALL, "staff_id": TINY},
    "staff": {"staff_id": TINY, "address_id": SMALL, "store_id": TINY},
    "store": {"store_id": TINY, "manager_staff_id": TINY, "address_id": SMALL},
}

# Precision and scale of money columns.
DECIMALS = {
    "film": {"rental_rate": (4, 2), "replacement_cost": (5, 2)},
    "payment": {"amount": (5, 2)},
}


def source_schema(table: str) -> T.StructType:
    """The declared layout of a source table."""
    return T.StructType.fromDDL(SOURCE_TABLES[table])


def required_columns(table: str) -> list[str]:
    """Columns of a source table that may not be NULL."""
    return [field.split()[0] for field in SOURCE_TABLES[table].split(", ") if field.endswith("NOT NULL")]
