import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rentlake.llm import suffix_dedup


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        covered = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(b for b, c in zip(t, covered, strict=False) if not c)
        spans = int(((covered[1:] == 0) & covered[:-1]).sum())
        out.append((doc_id, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    passage = " ".join(word() for _ in range(40))
    texts = [None, "", "short", "aaaa" * 40, "ab" * 60, passage, passage]
    for _ in range(60):
        text = " ".join(word() for _ in range(rng.randrange(5, 120)))
        if rng.random() < 0.5:
            at, k = rng.randrange(len(text)), rng.randrange(len(passage))
            text = text[:at] + passage[k : k + rng.randrange(10, 150)] + text[at:]
        texts.append(text)
        if rng.random() < 0.4:
            at = rng.randrange(len(text))
            texts.append(text[:at] + "X" + text[at + 1 :])
    return [(i, t) for i, t in enumerate(texts)]


def result(spark, rows, length, core):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.deduplicate(docs, length, core).drop("spans").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("length,core,hot", [(40, 20, 4000), (25, 9, 4000), (40, 20, 2)])
def test_equals_brute_force(spark, monkeypatch, length, core, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus(length + hot)
    assert result(spark, rows, length, core) == brute(rows, length)


def test_production_length_long_text_and_repeated_rows(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    rows = [(1, long), (2, long[5000:9000] + "tail"), (3, "x" * 399), (4, "x" * 399), (5, "y" * 500), (6, "z" * 450), (6, "z" * 450), (None, long[100:499])]
    assert result(spark, rows, 400, 200) == brute(rows, 400)


def test_pieces_of_a_long_text_agree(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    offsets = np.array([0, 5000])
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    starts = []
    for _, _, begin, end in suffix_dedup._pieces(offsets, 40):
        _, lo, hi, _, _ = suffix_dedup.contexts(data[begin:end], np.array([0, end - begin]), 40, 20)
        starts += [begin + s for a, b in zip(lo, hi, strict=True) for s in range(a, b + 1)]
    assert starts == list(range(5000 - 40 + 1))


def test_prefix_groups_equal_brute_force():
    rng = random.Random(4)
    for length in (9, 12, 30):
        base = bytes(rng.choice(b"ab") for _ in range(200))
        parts = [base[k : k + length + rng.randrange(25)] for k in (0, 5, 5, 40, 90, 92)]
        starts = [len(p) - length + 1 for p in parts]
        counts = Counter(p[i : i + length] for p, s in zip(parts, starts, strict=True) for i in range(s))
        for p, s, flags in zip(parts, starts, suffix_dedup.repeated_starts(parts, starts, length), strict=True):
            assert flags.tolist() == [counts[p[i : i + length]] > 1 for i in range(s)]


def test_empty_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a" * 900, "lo", 5)], "doc_id long, text string, ranges string, text_key int")
    row = suffix_dedup.deduplicate(docs).first()
    assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (900, 900, 1)
    assert suffix_dedup.deduplicate(docs.limit(0)).collect() == []
