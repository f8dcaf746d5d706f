import random
import re
from collections import Counter

import numpy as np
import pytest

from rentlake.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words=3, percent=90):
    """(doc_id, size, component, links): sets as strings, all pairs, and components by repeated minimum."""
    sets = []
    for _, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = WORD.findall(lowered)
        short = {tuple(found)} if found else set()
        sets.append({tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or short)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[root(i)], links[i]) for i, (doc_id, _) in enumerate(rows))


def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(rng.randrange(30))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n\t", "One", "one", "one two", "One TWO", "one two three", "Ärger one", "ärger one"]
    for length in (5, 9, 11, 12, 15, 20, 21, 25, 31, 40, 80, 150, 400):
        base = [word() for _ in range(length)]
        texts.append(" ".join(base))
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, length // 40))):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.4:
                    copy[at] = word()
                elif kind < 0.7:
                    copy.pop(at)
                else:
                    copy.insert(at, word())
                copy = copy or ["x"]
            if rng.random() < 0.3:
                copy = copy[: max(1, len(copy) - rng.randrange(1, 3))]
            texts.append("  ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy))
    texts += [" ".join([word() for _ in range(30)] + passage) for _ in range(30)]
    rng.shuffle(texts)
    return [(7 * i - 300, t) for i, t in enumerate(texts)]


def components(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in ngram_join.linked_components(docs).collect())


def test_equals_brute_force(spark):
    rows = corpus()
    assert components(spark, rows) == brute(rows)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    # Lists longer than a chunk are compared chunk against chunk.
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    assert components(spark, rows) == brute(rows)


def test_repeated_rows_other_columns_and_empty_table(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (5, "q r s t")]
    docs = spark.createDataFrame(
        [(i, t, "n", 3) for i, t in rows], "doc_id long, text string, node string, n_shingles int"
    )
    got = ngram_join.linked_components(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == [
        (0, 2, 1, 2), (1, 2, 1, 2), (1, 2, 1, 2), (5, 2, 5, 0)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.linked_components(empty).collect() == []


@pytest.mark.parametrize("n", [9, 10, 19, 40, 333, 5000])
def test_sizes_that_link_share_a_class(n):
    for m in range(n, n * 10 // 9 + 1):
        assert set(ngram_join.size_classes(n)) & set(ngram_join.size_classes(m))
        overlap = -(-9 * (n + m) // 19)
        assert n + m - 2 * overlap <= ngram_join.differing(n + m)
        shared = max(set(ngram_join.size_classes(n)) & set(ngram_join.size_classes(m)))
        assert n + m < 2 * ngram_join.PAIRS.bounds[shared + 1]


def test_boundary_follows_cost():
    assert ngram_join.choose_boundary({}) == 8
    assert 9 <= ngram_join.choose_boundary({n: 100 for n in range(9, 30)}) <= 29
    assert ngram_join.choose_boundary({29: 1000}) == 8


def test_sketch_distance_never_exceeds_difference():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        b = np.unique(np.concatenate((a[:280], rng.integers(0, 2**63, 90).astype(np.uint64))))
        s, t = ngram_join.sketch(a), ngram_join.sketch(b)
        short = min(len(s), len(t))
        apart = np.bitwise_count(ngram_join.fold(s, short) ^ ngram_join.fold(t, short)).sum()
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("measure", [ngram_join.PAIRS, ngram_join.NEAR_COPIES])
@pytest.mark.parametrize("n", [10, 13, 17, 23, 30, 45, 60, 90, 120, 200, 300, 450, 800, 2000])
def test_unrelated_sets_share_no_key(measure, n):
    rng = np.random.default_rng(n)
    sets = 2000 if n < 500 else 500
    keys = Counter()
    for _ in range(sets):
        keys.update(set(ngram_join.heavy_keys(np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)), measure).tolist()))
    assert max(keys.values()) <= max(1, 0.002 * sets)


@pytest.mark.parametrize("measure", [ngram_join.PAIRS, ngram_join.NEAR_COPIES])
def test_linked_sets_share_a_key(measure):
    """Sets that differ in as many shingles as linked ones can, of sizes at both ends of what a set links with."""
    rng = np.random.default_rng(4)
    for n in [*range(measure.least, 60), 100, 250, 411, 900]:
        for m in {n, n * 10 // measure.tenths, (n + n * 10 // measure.tenths) // 2}:
            same = -(-measure.tenths * (n + m) // (10 + measure.tenths))
            if same > min(n, m):
                continue
            for _ in range(20):
                pool = rng.integers(0, 2**64, n + m - same, dtype=np.uint64)
                a, b = np.sort(pool[:n]), np.sort(pool[n - same :])
                assert 10 * same >= measure.tenths * (n + m - same)
                assert set(ngram_join.heavy_keys(a, measure).tolist()) & set(ngram_join.heavy_keys(b, measure).tolist()), (n, m)


def test_links_of_triangles_chains_and_copies(spark):
    base = [f"w{i}" for i in range(100)]
    texts = [base, base, [*base[:99], "x"], [*base[:98], "y", "z"], [*base[:90], *[f"q{i}" for i in range(10)]], ["alone"] * 9]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert components(spark, rows) == brute(rows)
    assert [r[3] for r in brute(rows)][:2] == [3, 3]


def test_links_across_chunks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    monkeypatch.setattr(ngram_join, "SLICE", 64)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(120)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(copy)))
    assert components(spark, rows) == brute(rows)


def test_rows_that_share_an_id_but_not_the_text_all_stay(spark):
    rows = [(1, "a b c d e f g"), (1, "other words are here in this one"), (2, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "x")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rows int")
    got = ngram_join.representatives(docs, ngram_join.NEAR_COPIES)
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in got.collect())
    assert kept == sorted([(0, "x"), (1, rows[0][1]), (1, rows[1][1]), (2, rows[2][1])])
