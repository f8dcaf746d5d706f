import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rentlake.llm import fingerprints
from tests.conftest import SAMPLES


def paragraphs(text):
    found = re.findall(fingerprints.PARAGRAPH, text)
    plain = (p.strip(fingerprints.SPACES) for p in found)
    return {p for p in plain if p}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    ranked = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    out = []
    for k, (named, i, text) in enumerate(ranked):
        follow = ranked[(k + 1) % len(ranked)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        out.append((i if named else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, follow)))
    return sorted(out, key=repr)


def result(spark, rows, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = fingerprints.fingerprint(docs).collect()
    assert all(not r["fingerprint"] != r["edited_fingerprint"] or r["edited_sha256"] for r in got)
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got), key=repr), got


def corpus(n, spread=1):
    rng = random.Random(n)
    lines = [" ".join(rng.choice("ab cd éf gh. ij kl").strip() + str(rng.randrange(99)) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    rows = [(-5, None), (-4, ""), (-3, "\n \n"), (-2, "one line"), (-1, "one line")]
    for i in range(n):
        rows.append((i * spread, "\n".join(rng.choice(lines) + ("" if rng.random() < 0.5 else str(rng.random())) for _ in range(rng.choice((1, 2, 5, 30, 120))))))
    return rows


@pytest.mark.parametrize("n,spread", [(60, 1), (25, 10**15)])
def test_equals_brute_force(spark, n, spread):
    rows = corpus(n, spread)
    got, full = result(spark, rows)
    want = brute(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3:] for g in got] == [pytest.approx(w[3:]) for w in want]
    prints = {}
    for r in full:
        prints.setdefault(r["fingerprint"], set()).add(r["doc_id"])
    assert len(prints) >= len({t for _, t in rows if t and t.strip()})


def test_whole_sample(spark):
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fingerprints.fingerprint(docs.repartition(3)).collect()
    have = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got), key=repr)
    assert [h[:3] for h in have] == [w[:3] for w in brute(rows)]
    assert [h[3:] for h in have] == [pytest.approx(w[3:]) for w in brute(rows)]


def test_single_repeated_and_null_rows(spark):
    for rows in ([(7, "only text")], [(1, "b x"), (1, "b x"), (1, "a y"), (None, "q"), (None, None), (2, "z")]):
        got, _ = result(spark, rows)
        assert [g[:3] for g in got] == [w[:3] for w in brute(rows)]
    empty = spark.createDataFrame([], "doc_id long, text string, next_text string, own int")
    assert fingerprints.fingerprint(empty).collect() == []


def test_peeling_recovers_the_differing_digests(spark):
    rng = random.Random(0)
    shared = [rng.getrandbits(63) for _ in range(50)]
    cases = [(shared + [rng.getrandbits(63) for _ in range(a)], shared + [rng.getrandbits(63) for _ in range(b)]) for a, b in ((0, 0), (1, 0), (3, 4), (40, 90))]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(cases)], "k int, a array<bigint>, b array<bigint>")
    rows = rows.withColumn("sa", fingerprints.sketch(F.col("a"))).withColumn("sb", fingerprints.sketch(F.col("b")))
    rows = rows.withColumn("first", fingerprints.peel(fingerprints.minus(F.col("sa"), F.col("sb"))))
    rows = fingerprints.with_difference(rows, "a", "b", "sa", "sb", "d")
    for r in rows.collect():
        a, b = map(set, cases[r["k"]])
        assert (set(r["d"]["mine"]), set(r["d"]["others"])) == (a - b, b - a)
        assert r["first"]["whole"] or r["k"] == 3
