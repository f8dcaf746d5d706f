import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rentlake.llm import language_id, mixing, ngram_join
from tests.conftest import SAMPLES
from tests.llm.test_ngram_join import WORD, corpus
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_packing import check as check_pieces
from tests.llm.test_secrets import weak

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def masked(text):
    out, at = "", 0
    for start, _, _, end in weak(text):
        if end <= at:
            continue
        out += text[at:start] + "[SECRET]" if start >= at else "[SECRET]"
        at = end
    return out + text[at:]


def rows_of(docs):
    return {r["doc_id"]: r for r in docs.collect()}


def test_each_stage_equals_brute_force(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "packing"]
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    whole = rows_of(docs)

    known = stages[0](spark, docs, SAMPLES).cache()
    assert known.columns == COLUMNS
    rejected = {r["doc_id"] for r in language_id.identify(docs).where("rejected").collect()}
    first = rows_of(known)
    assert set(first) == set(whole) - rejected and len(first) >= 0.98 * len(whole)
    assert all(first[i] == whole[i] for i in first)

    single = stages[1](spark, known, SAMPLES).cache()
    second = rows_of(single)
    assert single.columns == COLUMNS
    assert set(second) == {c for _, _, c, _ in brute_components([(i, r["text"]) for i, r in first.items()], 5, 80)}

    clean = stages[2](spark, single, SAMPLES).cache()
    third = rows_of(clean)
    assert clean.columns == COLUMNS and set(third) == set(second)
    for i, r in third.items():
        assert r["text"] == masked(second[i]["text"])
        assert r["n_chars"] == (second[i]["n_chars"] if r["text"] == second[i]["text"] else len(r["text"]))

    mixed = stages[3](spark, clean, SAMPLES).cache()
    assert mixed.columns == COLUMNS
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect() if r["copies"]}
    assert dict(Counter(r["doc_id"] for r in mixed.collect())) == want

    once = mixed.dropDuplicates(["doc_id"]).cache()
    check_pieces(stages[4](spark, once, SAMPLES).collect(), {r["doc_id"]: r["text"] for r in once.collect()})
    pieces, tokens = stages[4](spark, mixed, SAMPLES).collect(), defaultdict(int)
    for r in pieces:
        tokens[r["doc_id"]] += r["length"]
    size = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert tokens == {i: n * size[i] for i, n in want.items()}


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SAMPLES)
    again = corpus_pipeline.run(spark, SAMPLES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    assert got.count() > 100


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "the cat sat on the mat", "en", "a", 22), (3, "the cat sat on the mat", "en", "a", 22),
            (None, "the cat token=abcdefghij", "en", None, 24), (7, "the " * 40_000, "en", "b", 160_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            some = stage(spark, some, SAMPLES).cache()
            some.count()
    assert not re.search("token=abcdefghij", " ".join(r["text"] for r in corpus_pipeline.STAGES[2][1](spark, docs, SAMPLES).collect() if r["text"]))


def first_of_near_copies(rows):
    """Smallest ids of the groups whose five-word shingles have 0.8 or more in common, over all pairs."""
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    least = {doc_id: doc_id for doc_id in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                low, high = sorted((least[i], least[j]))
                least = {k: low if v == high else v for k, v in least.items()}
    return set(least.values())


def test_join_takes_five_words_and_four_fifths(spark):
    rng = random.Random(2)
    rows = corpus()
    for length in (8, 9, 12, 16, 18, 24, 33, 60, 120, 300):
        base = [f"v{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(1 + max(1, length // 40))):
                copy[rng.randrange(length)] = f"y{rng.randrange(10**6)}"
            copy = copy[rng.randrange(1 + length // 20) : length - rng.randrange(1 + length // 12)]
            rows.append((10_000 + len(rows), " ".join(copy)))
    rows += [(5000, "p q r s"), (5001, "p r q s"), (5002, "P q r s"), (5003, "p q r s t"), (5004, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = first_of_near_copies(rows)
    assert want != {c for _, _, c, _ in brute_components(rows)}
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, SAMPLES).collect()} == want


@pytest.mark.parametrize("n", [4, 9, 14, 15, 40, 333, 5000])
def test_blocks_and_classes_of_the_join(n):
    measure = ngram_join.NEAR_COPIES
    for m in range(n, n * 10 // 8 + 1):
        both = set(ngram_join.size_classes(n, measure)) & set(ngram_join.size_classes(m, measure))
        assert measure.blocks(max(both)) > n + m - 2 * -(-8 * (n + m) // 18)
    found = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    assert len(ngram_join.heavy_keys(found, measure)) <= sum(measure.blocks(c) for c in ngram_join.size_classes(len(found), measure))
