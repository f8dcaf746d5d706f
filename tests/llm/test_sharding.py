import zlib
from collections import Counter, defaultdict

import pytest

from rentlake.llm import sharding
from tests.conftest import SAMPLES


def check(rows, texts, shards=24):
    """Sizes and hashes are right, slots are gapless; gives the bytes of each shard."""
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, loads = defaultdict(list), [0] * shards
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def near(loads, largest=0):
    mean = sum(loads) / len(loads)
    slack = max(2 * sharding.GRAIN * mean, largest)
    assert max(loads) - min(loads) <= slack, (min(loads), mean, max(loads))


def split_groups(rows):
    shards = defaultdict(set)
    for r in rows:
        shards[r["text_crc32"], r["size"]].add(r["shard"])
    return [k for k, s in shards.items() if len(s) > 1]


def test_whole_samples_are_near_equal_and_keep_groups(spark):
    for folder in (SAMPLES, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        rows = sharding.assign(docs).collect()
        near(check(rows, texts), max(r["size"] for r in rows))
        assert not split_groups(rows)


def test_a_third_of_all_rows_alike_and_longer_than_others(spark, without_merging):
    rows = [(i, "same text again and again " * 20) for i in range(2000)] + [(10_000 + i, f"text {i} " * 12) for i in range(4000)]
    rows += [(None, ""), (None, None), (None, ""), (5, "same text again and again " * 20)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, slot int").repartition(7)
    got = sharding.assign(docs).collect()
    loads = check(got, rows)
    near(loads)
    assert {k for k, _ in split_groups(got)} == {zlib.crc32(b"same text again and again " * 20)}
    again = sharding.assign(docs.repartition(3, "text")).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(tuple(r)[:5] for r in again)


def test_a_third_of_all_rows_are_tiny(spark, without_merging):
    rows = [(i, None) for i in range(3000)] + [(10_000 + i, f"text {i} " * 100) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sharding.assign(docs).collect()
    near(check(got, rows))
    assert not split_groups(got)


def test_documents_larger_than_a_shard(spark):
    rows = [(0, "a" * 500_000), (1, "b" * 300_000), (2, "b" * 300_000), *((i, f"{i} " * 30) for i in range(3, 3000))]
    loads = check(sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    # The three fill a shard each; the others share the rest.
    assert sorted(loads)[-3:] == [300_008, 300_008, 500_008]
    near(sorted(loads)[:-3])


def test_one_text_only_few_rows_and_none(spark):
    rows = [(i, "x" * 50) for i in range(2400)]
    near(check(sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows), 58)
    few = [(1, "a"), (1, "a"), (2, "longer text"), (None, None)]
    docs = spark.createDataFrame(few, "doc_id long, text string")
    loads = check(sharding.assign(docs).collect(), few)
    assert max(loads) == 19
    assert sharding.assign(docs.limit(0)).collect() == []
    assert sum(check(sharding.assign(docs, 1).collect(), few, 1)) == 4 * 8 + 13


def test_overfull_ranges_are_subdivided(spark, folder):
    rows = spark.range(20_000).selectExpr("id as _row", "id as doc_id", "if(id % 3 = 0, 'copy', cast(id as string)) as text")
    rows = sharding.narrow(rows).cache()
    splitters = sharding.find_splitters(rows, 50)
    loads = [r["n"] for r in rows.groupBy(splitters.range_of(*sharding.KEY).alias("range")).agg({"*": "count"}).toDF("range", "n").collect()]
    assert max(loads) <= 3 * 20_000 / 50 + 1 and len(loads) >= 40


def test_written_shards_hold_all_rows_in_order(spark, folder):
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    sharding.write_shards(docs, f"{folder}/shards")
    back = spark.read.parquet(f"{folder}/shards")
    assert {tuple(r) for r in back.select(docs.columns).collect()} == {tuple(r) for r in docs.collect()}
    got = {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()}
    assert got == {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.assign(docs).collect()}


@pytest.mark.parametrize("rest", [0, 5, 100])
def test_levels(rest):
    loads = [3, 0, 8, 1]
    parts = [b - a for a, b in zip([0, *sharding._filled(loads, rest)], sharding._filled(loads, rest))]
    assert sum(parts) == pytest.approx(rest)
    filled = sorted(x + p for x, p in zip(loads, parts) if p > 0)
    assert not filled or filled[-1] == pytest.approx(filled[0])
