import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rentlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Shares given out again and again until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        share = left / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * share > 3 * sizes[s]}
        for s in over or free:
            out[s] = 3.0 * sizes[s] if over else weights[s] * share
        if not over:
            break
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return out


def corpus(n, sources):
    rows = []
    for i in range(n):
        source = sources[(i * i) % len(sources)] if i % 3 else sources[0]
        rows.append((i, " ".join(["w"] * (i * 37 % 211)) if i % 50 else None, source))
    return rows


@pytest.mark.parametrize("n,sources", [(3000, ["big", "a", "b", None, "ß", "tiny"]), (40, ["x", "y"]), (1, ["x"])])
def test_targets_and_taken_words(spark, n, sources):
    rows = corpus(n, sources)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(docs).collect()
    sizes, biggest = defaultdict(int), defaultdict(int)
    size_of = {}
    for i, text, source in rows:
        size_of[i] = len(WORD.findall(text or ""))
        sizes[source] += size_of[i]
        biggest[source] = max(biggest[source], size_of[i])
    want = targets(sizes)
    taken = defaultdict(int)
    assert sorted(r["doc_id"] for r in got) == list(range(n))
    for r in got:
        assert r["size"] == size_of[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - want[source]) <= biggest[source] + 1e-6


def test_words_are_nearer_to_the_target_than_a_median_document(spark):
    """One document may hold a fifth of its source's words: what its draw leaves falls to the smaller ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sums = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.median("size").alias("median"), F.max("size").alias("largest")
    ).collect()
    assert len(sums) == 20 and max(r["largest"] for r in sums) > 10_000
    for r in sums:
        assert abs(r["taken"] - r["target"]) <= r["median"], r


def test_many_sources(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 700}") for i in range(9000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(
        F.max("source_size").alias("size"), F.max("target").alias("target")
    ).collect()
    sizes = {r["source"]: r["size"] for r in got}
    want = targets(sizes)
    assert all(r["target"] == pytest.approx(want[r["source"]]) for r in got) and len(got) == 700


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.createDataFrame(corpus(700, ["a", "b", "c"]), "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.mix(docs.repartition(1)).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(7, "source")).collect()))


def test_expected_copies_are_kept(spark):
    """Over many draws (ids) the share of documents taken once more is the fractional part."""
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).where("source = 'a'").selectExpr("avg(copies)", "max(target / source_size)").first()
    assert got[0] == pytest.approx(got[1], abs=0.001)


def test_documents_as_often_as_taken(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "d e f", "s"), (None, "x y", None), (None, "x y", None), (5, None, "t"), (6, "q " * 9, "t")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, copies string")
    got = mixing.mixed_documents(docs)
    assert got.schema == docs.schema
    want = {(r["doc_id"], r["source"]): r["n"] for r in mixing.mix(docs).groupBy("doc_id", "source").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "n").collect()}
    have = defaultdict(int)
    for r in got.collect():
        have[r["doc_id"], r["source"]] += 1
    assert dict(have) == {k: n for k, n in want.items() if n}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).collect() == []
    assert mixing.mixed_documents(docs).collect() == []
