import random

import pytest

from rentlake.operators.changes import apply_changes
from rentlake.streaming import changes as stream_changes
from rentlake.streaming import ingest
from tests.conftest import rows

LAYOUT = (
    "op STRING, seq BIGINT, old_id INT, old_title STRING, old_description STRING, "
    "new_id INT, new_title STRING, new_description STRING"
)
BASE = "id INT, title STRING, description STRING"
NONE = (None, None, None)


def one_by_one(base, changes, null_safe=False):
    """The changes applied in order, one row at a time."""
    table = {row[0]: row for row in base}
    for change in sorted(changes, key=lambda c: c[1]):
        op, old, new = change[0], change[2:5], change[5:8]
        if op == "insert":
            table[new[0]] = new
        elif op == "delete":
            table.pop(old[0], None)
        else:
            seen = [a is not None and b is not None and a != b for a, b in zip(old, new)]
            if null_safe:
                seen = [a != b for a, b in zip(old, new)]
            if any(seen) and table.pop(old[0], None) is not None:
                table[new[0]] = new
    return sorted(table.values(), key=repr)


def random_history(seed, length=400, keys=40):
    """A base table and a history over it, a third of which concerns one key."""
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "x", "y", "z"])
    base = [(k, f"t{k}", text()) for k in range(keys)]
    now = {row[0]: row for row in base}
    changes = []
    for seq in range(length):
        key = 0 if rng.random() < 0.33 else rng.randrange(keys * 2)
        old = now.get(key)
        if old is None:
            new = (key, f"t{seq}", text())
            changes.append(("insert", seq, *NONE, *new))
            now[key] = new
        elif rng.random() < 0.2:
            changes.append(("delete", seq, *old, *NONE))
            del now[key]
        else:
            free = [k for k in range(keys * 2) if k not in now]
            target = rng.choice(free) if free and rng.random() < 0.2 else key
            new = (target, old[1] if rng.random() < 0.5 else f"t{seq}", text())
            changes.append(("update", seq, *old, *new))
            del now[key]
            now[target] = new
    rng.shuffle(changes)
    return base, changes


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_set_based_equals_one_by_one(spark, seed, null_safe):
    base, changes = random_history(seed)
    got = apply_changes(
        spark.createDataFrame(base, BASE), spark.createDataFrame(changes, LAYOUT), "id", ["title", "description"], null_safe
    )
    assert rows(got) == one_by_one(base, changes, null_safe)


def test_change_from_null_alone_is_missed_unless_null_safe(spark):
    base = spark.createDataFrame([(1, "a", None)], BASE)
    change = spark.createDataFrame([("update", 1, 1, "a", None, 1, "a", "new")], LAYOUT)
    assert rows(apply_changes(base, change, "id", ["title", "description"])) == [(1, "a", None)]
    assert rows(apply_changes(base, change, "id", ["title", "description"], null_safe=True)) == [(1, "a", "new")]


@pytest.mark.parametrize("null_safe", [False, True])
def test_updates_of_absent_keys_do_nothing(spark, null_safe):
    base = [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")]
    changes = [
        ("update", 1, 9, "q", "x", 9, "r", "x"),
        ("update", 2, 8, "q", "x", 7, "q", "x"),
        ("delete", 3, 2, "b", "x", *NONE),
        ("update", 4, 2, "b", "x", 2, "z", "x"),
        ("insert", 5, *NONE, 5, "n", "x"),
        ("update", 6, 5, "n", "x", 5, "m", "x"),
        ("update", 7, 5, "m", "x", 6, "m", "x"),
        ("update", 8, 6, "m", "x", 6, "l", "x"),
        ("update", 9, 3, "c", "x", 3, "d", "x"),
    ]
    got = apply_changes(
        spark.createDataFrame(base, BASE), spark.createDataFrame(changes, LAYOUT), "id", ["title", "description"], null_safe
    )
    assert rows(got) == one_by_one(base, changes, null_safe) == [(1, "a", "x"), (3, "d", "x"), (6, "l", "x")]


def test_stream_of_changes_in_batches(spark, folder):
    base, changes = random_history(11)
    base_df = spark.createDataFrame(base, BASE)

    def follow():
        stream = ingest.stream_files(spark, f"{folder}/in", LAYOUT, fmt="parquet", maxFilesPerTrigger=1)
        stream_changes.follow_changes(stream, f"{folder}/events", f"{folder}/checkpoint", "id", ["title", "description"])
        return stream_changes.current_table(spark, base_df, f"{folder}/events", "id", ["title", "description"])

    changes.sort(key=lambda c: c[1])
    for start in (0, 150):
        end = start + 150
        spark.createDataFrame(changes[start:end], LAYOUT).repartition(2).write.mode("append").parquet(f"{folder}/in")
        assert rows(follow()) == one_by_one(base, changes[:end])
    # Nothing new: nothing changes.
    assert rows(follow()) == one_by_one(base, changes[:300])
    fields = ["title", "description"]
    stream_changes.compact_events(spark, base_df, f"{folder}/events", f"{folder}/compacted", "id", fields)
    table = stream_changes.current_table(spark, base_df, f"{folder}/compacted", "id", fields)
    assert rows(table) == one_by_one(base, changes[:300])


def test_versions_do_not_overwrite(spark, folder):
    table = spark.createDataFrame([(1, "a", None)], BASE)
    target = stream_changes.release_version(table, folder, 1)
    assert rows(spark.read.parquet(target)) == rows(table)
    with pytest.raises(Exception, match="already exists"):
        stream_changes.release_version(table, folder, 1)
