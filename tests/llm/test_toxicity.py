import random
import zlib
from collections import Counter

import pytest
import regex

from rentlake.llm import toxicity


def fixture(n):
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"w{(i * 7 + k * 13) % 97}x".replace("0", "o") for k in range(30)]
        if toxic:
            words[i % 30] = "scumbag"
            words[(i + 2) % 30] = "you"
        elif i % 11 == 0:
            words[3] = "you"
        rows.append((i, " ".join("".join(c for c in w if not c.isdigit()) + "abcdefghij"[int(zlib.crc32(w.encode())) % 10] if w not in ("scumbag", "you") else w for w in words), int(toxic)))
    return rows


def test_held_out_texts_are_told_apart(spark):
    rows = fixture(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == 600
    for i, _, toxic in rows:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"]:
            assert r["predicted"] == toxic


def test_labels_of_held_out_ids_teach_nothing(spark):
    rows = fixture(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, _, t in rows]
    results = [
        sorted(map(tuple, toxicity.score(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()))
        for x in ([(i, t) for i, _, t in rows], other)
    ]
    assert results[0] == results[1]


@pytest.mark.parametrize("labels,value", [([], 0.0), ([(1, 1), (4, 1)], 1.0), ([(1, 0)], 0.0)])
def test_without_labels_of_both_kinds(spark, labels, value):
    rows = [(1, None), (2, ""), (4, "you scum"), (None, "x"), (1, None)]
    docs = spark.createDataFrame([(*r, "a", 1.5) for r in rows], "doc_id long, text string, lexicon string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, marks).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {value}
    assert toxicity.score(docs.limit(0), marks).collect() == []


def test_features(spark):
    docs = spark.createDataFrame([(1, "You total SCUM! w@y b4d you? fine"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r.asDict() for r in toxicity.with_features(docs, ["scum"]).collect()}
    assert rows[1]["lexicon"] == 1 and rows[1]["near_address"] == 1 and rows[1]["bangs"] > 0
    assert rows[1]["obfuscated"] == pytest.approx(2 / rows[1]["words"])
    assert rows[2]["words"] == 0 and rows[2]["lexicon"] == 0


def brute_features(text, lexicon):
    """The features of one text in plain Python."""
    text = text or ""
    words = regex.findall(r"[\p{L}\p{M}]+", text.lower())
    address = set(toxicity.ADDRESS)
    letters = "".join("L" if w in lexicon else "Y" if w in address else "x" for w in words)
    n, near, at = max(1, len(words)), 0, 0
    while at < len(letters):  # an address and a lexicon word with at most NEAR others between, left to right
        step = 1
        if letters[at] in "YL":
            want = "L" if letters[at] == "Y" else "Y"
            for k in range(at + 1, min(len(letters), at + toxicity.NEAR + 2)):
                if letters[k] == want:
                    near, step = near + 1, k - at + 1
                    break
        at += step
    capital_words = [m for m in regex.finditer(r"\p{Lu}{2,}", text)
                     if not (m.start() and regex.match(r"\p{L}", text[m.start() - 1])) and not regex.match(r"\p{L}", text[m.end() : m.end() + 1])]
    return {
        "lexicon": letters.count("L"),
        "lexicon_density": letters.count("L") / n,
        "lexicon_kinds": len({w for w in words if w in lexicon}),
        "near_address": near,
        "address_density": letters.count("Y") / n,
        "capital_share": sum(bool(regex.match(r"\p{Lu}", c)) for c in text) / max(1, len(text)),
        "capital_words": len(capital_words) / n,
        "bangs": text.count("!") / n,
        "questions": text.count("?") / n,
        "punctuation": sum(c in ".,;:#*$%&|<>@" for c in text) / n,
        "obfuscated": len(regex.findall(r"\p{L}[0-9@$*!]+\p{L}", text)) / n,
        "words": len(words),
    }


def test_features_equal_brute_force(spark):
    rng = random.Random(8)
    pieces = ["scumbag", "idiot", "you", "Your", "TU", "the", "Ärger", "ÄÖ", "ABC", "aBC", "sh1t", "f*ck", "a@b", "x", "!", "?!", "...", "1", "日本", "\n", "é", "A"]
    texts = [None, "", " ", "YOU", "you scumbag you", "scumbag x x x you", "scumbag x x x x you", "word " * 60_000 + "you idiot"]
    texts += [rng.choice([" ", "", "  "]).join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    lexicon = ["scumbag", "idiot"]
    for r in toxicity.with_features(docs, lexicon).collect():
        want = brute_features(texts[r["doc_id"]], set(lexicon))
        assert {f: r[f] for f in toxicity.FEATURES} == pytest.approx(want), texts[r["doc_id"]]


def test_lexicon_equals_brute_force(spark):
    rows = fixture(400)
    texts = spark.createDataFrame([(t, x) for _, t, x in rows], "text string, toxic int").repartition(3)
    bad, every = Counter(), Counter()
    for _, text, toxic in rows:
        for w in set(text.split()):
            every[w] += 1
            bad[w] += toxic
    toxic = sum(x for _, _, x in rows)
    odds = {w: ((bad[w] + 0.5) / (toxic + 1)) / ((n - bad[w] + 0.5) / (len(rows) - toxic + 1)) for w, n in every.items() if bad[w] >= toxicity.SEEN}
    want = sorted((w for w, o in odds.items() if o >= toxicity.ODDS), key=lambda w: (-odds[w], w))[: toxicity.LEXICON]
    assert toxicity.learn_lexicon(texts) == want and "scumbag" in want


def test_repeated_labels_clashing_columns_and_no_labels(spark):
    rows = fixture(200)
    docs = spark.createDataFrame([(i, t, "a", 1.0) for i, t, _ in rows], "doc_id long, text string, words string, score double")
    once = spark.createDataFrame([(i, t, "b") for i, _, t in rows], "doc_id long, toxic int, text string")
    twice = toxicity.score(docs, once.unionByName(once)).collect()
    assert len(twice) == 200 and {r["doc_id"] for r in twice} == set(range(200))
    none = toxicity.score(docs, once.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
