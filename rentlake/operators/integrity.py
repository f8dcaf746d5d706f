"""Rules over tables: each check returns the rows, or keys, that break it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake import schemas
from rentlake.operators.filters import cleared
from rentlake.operators.joins import lookup_join


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count.

    Rows with a NULL in the key are not compared, as for any unique key.
    """
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are not unique or have a NULL part, with their row count.

    A primary key, other than a unique one, allows no NULL: such a value counts even if
    it stands once.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | _any([F.col(k).isNull() for k in keys]))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column, and the names of those columns."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.where(_any([F.col(c).isNull() for c in columns])).withColumn("null_columns", missing)


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULLs replaced by the column's default."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(types[c])) for c, value in defaults.items()}
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference is set but names no parent row."""
    keys = parent.select(F.col(pk).alias(fk))
    return lookup_join(child.where(F.col(fk).isNotNull()), keys, fk, "left_anti")


def restricted_deletes(deletes: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """Parent rows that may not be deleted because child rows still refer to them."""
    return lookup_join(deletes, _referenced(child, fk, pk), pk, "left_semi")


def allowed_deletes(deletes: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """Parent rows to which no child row refers."""
    return lookup_join(deletes, _referenced(child, fk, pk), pk, "left_anti")


def _referenced(child: DataFrame, fk: str, pk: str) -> DataFrame:
    return child.where(F.col(fk).isNotNull()).select(F.col(fk).alias(pk)).distinct()


def set_null_on_delete(child: DataFrame, fk: str, deleted: DataFrame, pk: str) -> DataFrame:
    """Child rows after a parent delete: references to deleted parents become NULL.

    One join for both kinds of rows. It does not multiply rows if a parent is named twice,
    and leaves adaptive execution free to split a hot reference.
    """
    return cleared(child, fk, deleted.select(F.col(pk).alias(fk)).distinct())


def cascade_key_update(child: DataFrame, fk: str, key_map: DataFrame, old: str, new: str) -> DataFrame:
    """Child rows after a parent key update: references follow the (old, new) key map.

    An old key appears once in the map, as one parent row has one new key.
    """
    moves = key_map.select(F.col(old).alias(fk), F.col(new).alias("_new"))
    moved = F.coalesce(F.col("_new"), F.col(fk)).alias(fk)
    return lookup_join(child, moves, fk, "left").select(*[moved if c == fk else c for c in child.columns])


def is_outside_domain(column: str, allowed: Sequence) -> Column:
    """True where a value is set and not one of `allowed`."""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(False))


def is_outside_set(column: str, allowed: Sequence[str], separator: str = ",") -> Column:
    """True where a separated list has a member that is not one of `allowed`."""
    # The separator is a text, not a pattern.
    members = F.split(F.col(column), re.escape(separator), -1)
    unknown = F.array_except(members, F.array(*[F.lit(a) for a in allowed]))
    return F.coalesce((F.size(unknown) > 0) & (F.col(column) != ""), F.lit(False))


def is_outside_range(column: str, low, high) -> Column:
    """True where a value is set that is no number from `low` to `high`."""
    number = F.col(column).try_cast("decimal(38,6)")
    return F.col(column).isNotNull() & F.coalesce(~number.between(low, high), F.lit(True))


def is_too_long(column: str, limit: int) -> Column:
    """True where a text has more than `limit` characters."""
    return F.coalesce(F.length(column) > limit, F.lit(False))


def is_not_decimal(column: str, precision: int, scale: int) -> Column:
    """True where a number does not fit DECIMAL(precision, scale) exactly."""
    value = F.col(column)
    too_big = F.abs(value) >= F.lit(10 ** (precision - scale))
    return F.coalesce(too_big | (F.round(value, scale) != value), F.lit(False))


def violations(df: DataFrame, broken: Column) -> DataFrame:
    """The rows for which a rule is broken."""
    return df.where(broken)


def several_open_rentals(rental: DataFrame) -> DataFrame:
    """Copies that are out with more than one open rental at once."""
    open_now = rental.where(F.col("return_date").isNull()).groupBy("inventory_id")
    return open_now.agg(F.count(F.lit(1)).alias("n_open")).where(F.col("n_open") > 1)


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule with its violation count; NULL where a table or column is not given.

    Rules on single rows are counted in one pass per table; key rules take one
    combined count, references one anti join each.
    """
    found = []
    for name in schemas.SOURCE_TABLES:
        df = tables.get(name)
        found.append(_row_rules(name, df))
        keys = [("PRIMARY KEY", schemas.PRIMARY_KEYS[name])]
        keys += [("UNIQUE", key) for key in schemas.UNIQUE_KEYS.get(name, [])]
        for kind, key in keys:
            check = primary_key_violations if kind == "PRIMARY KEY" else duplicate_keys
            given = df is not None and set(key) <= set(df.columns)
            found.append(_counted(check(df, key) if given else None, name, kind, ",".join(key)))
    for child, fk, parent, pk, _ in schemas.FOREIGN_KEYS:
        given = child in tables and parent in tables and fk in tables[child].columns and pk in tables[parent].columns
        broken = orphans(tables[child].select(fk), fk, tables[parent], pk) if given else None
        found.append(_counted(broken, child, "FOREIGN KEY", f"{fk}->{parent}.{pk}"))
    rental = tables.get("rental")
    open_twice = None if rental is None else several_open_rentals(rental)
    found.append(_counted(open_twice, "rental", "ONE OPEN RENTAL", "inventory_id"))
    spark = next(iter(tables.values())).sparkSession
    unchecked = [row for row in found if isinstance(row, list)]
    report = [row for row in found if isinstance(row, DataFrame)]
    schema = "table_name STRING, rule STRING, columns STRING, n_violations BIGINT"
    if unchecked:
        report.append(spark.createDataFrame([(*rule, None) for rules in unchecked for rule in rules], schema))
    return reduce(DataFrame.unionByName, report)


def _counted(broken: DataFrame | None, table: str, kind: str, columns: str) -> DataFrame | list[tuple]:
    if broken is None:
        return [(table, kind, columns)]
    return broken.agg(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("rule"),
        F.lit(columns).alias("columns"),
        F.count(F.lit(1)).alias("n_violations"),
    )


def declared_row_rules(table: str) -> list[tuple[str, str, Column]]:
    """Kind, column and violation of every declared rule on single rows of a table."""
    rules = [("NOT NULL", c, F.col(c).isNull()) for c in schemas.required_columns(table)]
    rules += [("DOMAIN", c, is_outside_domain(c, v)) for c, v in schemas.DOMAINS.get(table, {}).items()]
    rules += [("SET", c, is_outside_set(c, v)) for c, v in schemas.SET_DOMAINS.get(table, {}).items()]
    rules += [("LENGTH", c, is_too_long(c, n)) for c, n in schemas.LENGTHS.get(table, {}).items()]
    rules += [("RANGE", c, is_outside_range(c, *r)) for c, r in schemas.RANGES.get(table, {}).items()]
    rules += [("DECIMAL", c, is_not_decimal(c, *d)) for c, d in schemas.DECIMALS.get(table, {}).items()]
    return rules


def _row_rules(table: str, df: DataFrame | None) -> DataFrame | list[tuple]:
    rules = declared_row_rules(table)
    columns = set() if df is None else set(df.columns)
    checked = [rule for rule in rules if rule[1] in columns]
    if not checked:
        return [(table, kind, column) for kind, column, _ in rules]
    totals = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(checked)])
    number = {rule[:2]: F.col(f"r{i}") for i, rule in enumerate(checked)}
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(kind).alias("rule"),
            F.lit(column).alias("columns"),
            number.get((kind, column), F.lit(None).cast("bigint")).alias("n_violations"),
        )
        for kind, column, _ in rules
    ]
    return totals.select(F.inline(F.array(*rows)))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
