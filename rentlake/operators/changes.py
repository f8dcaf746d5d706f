"""A derived table kept in step with the inserts, updates and deletes of its source.

A change row carries `op` ('insert', 'update' or 'delete'), `seq` (its place in
the order of changes) and, for every column of the derived table, the value
before (`old_<column>`) and after (`new_<column>`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.sources.versions import BucketedTable


def differs(columns: Sequence[str], null_safe: bool = False) -> Column:
    """Has any column changed?

    The plain test compares with `!=`, so a change from or to NULL alone is not
    seen; the null-safe one sees it.
    """
    changed = F.lit(False)
    for c in columns:
        old, new = F.col(f"old_{c}"), F.col(f"new_{c}")
        changed = changed | (~old.eqNullSafe(new) if null_safe else old != new)
    return F.coalesce(changed, F.lit(False))


def key_events(changes: DataFrame, key: str, values: Sequence[str], null_safe: bool = False) -> DataFrame:
    """What each change means for each key it touches: key, seq, kind, source, values.

    `kind` is 'put' where a key gains a row, 'gone' where it loses it, and 'set' where the
    row it has gets new values. A key change is two events: the old key loses its row, the
    new key gains one, whose `source` is the old key. Updates that change nothing the rule
    can see give no event.
    """
    old_key, new_key = F.col(f"old_{key}"), F.col(f"new_{key}")
    none = F.lit(None).cast(changes.schema[f"old_{key}"].dataType)
    blanks = [F.lit(None).cast(changes.schema[f"new_{v}"].dataType).alias(v) for v in values]

    def event(kind: str, at: Column, source: Column, *rest: Column) -> Column:
        return F.struct(at.alias(key), F.lit(kind).alias("kind"), source.alias("source"), *rest)

    after = [F.col(f"new_{v}").alias(v) for v in values]
    gone = event("gone", old_key, none, *blanks)
    op = F.col("op")
    seen = (op != "update") | differs([key, *values], null_safe)
    events = (
        F.when(op == "insert", F.array(event("put", new_key, none, *after)))
        .when(op == "delete", F.array(gone))
        .when(old_key == new_key, F.array(event("set", new_key, none, *after)))
        .otherwise(F.array(gone, event("put", new_key, old_key, *after)))
    )
    return changes.where(seen).select("seq", F.inline(events)).select(key, "seq", "kind", "source", *values)


def confirm_moves(events: DataFrame, key: str) -> DataFrame:
    """`events` without the source of key changes whose old key got its row from an earlier event.

    What is left with a source must find it in the base table.
    """
    given = events.where("kind = 'put'").groupBy(F.col(key).alias("source")).agg(F.min("seq").alias("_given"))
    moves = events.where("source IS NOT NULL").join(given, "source", "left")
    source = F.when(~F.coalesce(F.col("_given") < F.col("seq"), F.lit(False)), F.col("source"))
    confirmed = moves.withColumn("source", source).select(*events.columns)
    return events.where("source IS NULL").unionByName(confirmed)


def latest_events(events: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Per key its last event, its last one that gives or takes the row, and the first that
    gives one, which key changes in other batches may need: at most three rows.

    They are combined before the shuffle rather than ranked after it, and the result can be
    reduced again together with later events.
    """
    events = confirm_moves(events, key)
    whole = F.struct("seq", "kind", "source", *values)
    last = F.max_by(whole, F.col("seq"))
    decided = F.max_by(F.when(F.col("kind") != "set", whole), F.when(F.col("kind") != "set", F.col("seq")))
    given = F.min_by(F.when(F.col("kind") == "put", whole), F.when(F.col("kind") == "put", F.col("seq")))
    kept = F.array_distinct(F.array_compact(F.array(given, decided, last)))
    return events.groupBy(key).agg(kept.alias("kept")).select(key, F.inline("kept"))


def apply_events(base: DataFrame, events: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The table after `events`: a full join of two unique keys.

    A row that is updated must be there: an update of an absent key, and a key change from
    one that neither the base has nor an earlier event gave a row, do nothing.
    """
    put = F.col("kind") != "set"
    whole = F.struct("seq", "kind", "source", *values)
    per_key = confirm_moves(events, key).groupBy(key).agg(
        F.max_by(F.when(put, whole), F.when(put, F.col("seq"))).alias("_decided"),
        F.max_by(whole, F.col("seq")).alias("_last"),
    )
    known = base.select(F.col(key).alias("_source"), F.lit(True).alias("_known"))
    moved = per_key.withColumn("_source", F.col("_decided.source")).join(known, "_source", "left")
    void = F.col("_decided.source").isNotNull() & F.col("_known").isNull()
    last = moved.select(
        key,
        F.when(~void, F.col("_decided.kind")).alias("_kind"),
        F.when(~void | (F.col("_last.kind") == "set"), F.col("_last")).alias("_last"),
    )
    joined = base.select(key, *values, F.lit(True).alias("_in_base")).join(last, key, "full")
    there = F.coalesce(F.col("_kind") == "put", F.col("_in_base"), F.lit(False))
    return joined.where(there).select(
        key,
        *[F.when(F.col("_last").isNotNull(), F.col("_last")[v]).otherwise(F.col(v)).alias(v) for v in values],
    )


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str, values: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """The derived table after a whole set of changes; the latest change per key wins."""
    return apply_events(base, key_events(changes, key, values, null_safe), key, values)


def apply_changes_by_bucket(
    table: BucketedTable, version: int, changes: DataFrame, values: Sequence[str], null_safe: bool = False
) -> int:
    """`apply_changes` on a bucketed table of one key: a new version, of which only the buckets
    of keys with an event are read and written. Returns its number.

    A key change has an event for either key, so what it needs of the base is at hand.
    """
    (key,) = table.keys
    events = key_events(changes, key, values, null_safe)
    touched = table.touched(events)
    return table.replace(version, touched, apply_events(table.read(version, touched), events, key, values))
