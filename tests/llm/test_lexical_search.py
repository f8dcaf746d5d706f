import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from rentlake.llm import lexical_search as search
from tests.conftest import SAMPLES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """The k best (item_id, rank, doc_id, score), every document scored for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(sum(c.values()) for _, c in counts)
    n_docs, df = len(counts), Counter(t for _, c in counts for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def ranked(spark, docs, items, k=10):
    d = spark.createDataFrame([(*r, "z", 0) for r in docs], "doc_id long, text string, item_id string, score int").repartition(5)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in search.rank(d, i, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_terms_of_bytes():
    for text in ("", "A-b c9", "Éa ÄÖ\x7fZz", "日本 語 x", "a" * 9 + "\n" + "B", "\x00\x01", "x😀y Z"):
        assert search.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def test_terms_of_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(search, "SEGMENT", 16)
    text = "one two threefourfivesixseveneightnineten É two " * 9
    assert search.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def test_bounds_never_fall_below_scores():
    rng = np.random.default_rng(3)
    counts = [Counter({b"t%d" % t: int(rng.integers(1, 600)) for t in rng.choice(400, rng.integers(1, 200), replace=False)}) for _ in range(50)]
    flat, begins = search.sketches(counts)
    for c, a, b in zip(counts, begins[:-1], begins[1:], strict=True):
        cells = flat[a:b]
        hashes = np.array([crc32(t) for t in c], dtype=np.uint64)
        one, two = search.cells(hashes, (b - a) // 2)
        found = np.minimum(cells[one], cells[two])
        assert all(f >= min(n, search.MOST) for f, n in zip(found, c.values(), strict=True))


def test_whole_sample_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    items = spark.read.parquet(f"{SAMPLES}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    got = search.rank(docs, items).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


@pytest.mark.parametrize("block", [search.BLOCK, 3])
def test_odd_rows_ties_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    docs = [(i, "alpha beta gamma") for i in range(40)] + [(100 + i, f"alpha delta{i % 7} " * (i % 5 + 1)) for i in range(60)]
    docs += [(None, "beta beta"), (None, None), (200, ""), (201, "?!"), (5, "alpha beta gamma"), (300, "rare"), (301, "x " * 5000 + "beta")]
    items = [(1, "Alpha GAMMA"), (2, "rare"), (3, "unknown"), (4, None), (5, ""), (None, "beta"), (6, "delta3, delta4"), (6, "rare alpha")]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, docs, items, 3) == brute(docs, items, 3)


def test_many_rounds_give_the_same(spark, monkeypatch):
    """With few cells and small rounds the bounds are loose, and several rounds are needed."""
    monkeypatch.setattr(search, "GROWTH", 2)
    monkeypatch.setattr(search, "FIRST", 1)
    docs = [(i, " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(i % 13 + 2))) for i in range(300)]
    items = [(j, " ".join(f"w{(j * 3 + k) % 50}" for k in range(6))) for j in range(8)]
    assert ranked(spark, docs, items, 2) == brute(docs, items, 2)


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None)], [(1, "a")]) == []
