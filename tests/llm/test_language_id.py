import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rentlake.llm import language_id
from tests.conftest import SAMPLES


def padded_word(w):
    """Marks around the 16-bit units of a word."""
    units = w.encode("utf-16-le")
    return "\x01\x01\x01" + "".join(chr(units[i] + 256 * units[i + 1]) for i in range(0, len(units), 2)) + "\x02"


def brute_model(rows):
    """Interpolated Kneser-Ney probabilities in plain dictionaries."""
    models = {}
    for lang in {r[1] for r in rows}:
        grams = Counter()
        for text, of in rows:
            if of == lang:
                for w in language_id.words_of(text):
                    padded = padded_word(w)
                    grams.update(padded[i - 3 : i + 1] for i in range(3, len(padded)))
        orders = {4: grams}
        for n in (3, 2, 1):
            orders[n] = Counter(g[1:] for g in orders[n + 1])
        models[lang] = orders
    kinds = len(set().union(*(m[1] for m in models.values())))

    def probability(orders, gram):
        p = 1.0 / (kinds + 1)
        for n in (1, 2, 3, 4):
            counts, g = orders[n], gram[-n:]
            once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
            d = min(0.9, max(0.1, once / (once + 2 * twice) if once + 2 * twice else 0.5))
            follow = [c for h, c in counts.items() if h[:-1] == g[:-1]]
            if follow:
                p = max(counts[g] - d, 0) / sum(follow) + d * len(follow) / sum(follow) * p
        return p

    def entropy(lang, text):
        bits = n = 0
        for w in language_id.words_of(text):
            padded = padded_word(w)
            for i in range(3, len(padded)):
                bits -= math.log2(probability(models[lang], padded[i - 3 : i + 1]))
                n += 1
        return bits / n

    return entropy


def test_entropies_equal_brute_force(spark):
    rows = [("the cat and the hat", "en"), ("that other cat", "en"), ("die Katze und der Hut", "de"), ("über den Hut", "de"), ("😀 x𝔸y", "de")]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["de", "en"]
    entropy = brute_model(rows)
    texts = ["the hat", "Der Hut!", "ñandú zzz", "a", "then THE cat's hut"]
    bits, _ = model.entropies(texts)
    for text, row in zip(texts, bits, strict=True):
        assert row.tolist() == pytest.approx([entropy("de", text), entropy("en", text)])


def test_letters_beyond_the_basic_plane_are_told_apart(spark):
    gothic, deseret = (["".join(chr(first + (7 * i + 3 * k * k) % 20) for k in range(4)) for i in range(20)] for first in (0x10330, 0x10400))
    rows = [(" ".join(gothic), "got"), (" ".join(deseret), "dsrt")]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    bits, sizes = model.entropies([" ".join(gothic[:5]), " ".join(deseret[:5])])
    assert [model.langs[k] for k in bits.argmin(axis=1)] == ["got", "dsrt"]
    assert np.abs(bits[:, 0] - bits[:, 1]).min() > 3 and sizes[1] == 45  # two units a letter, and the end of each word


def test_probabilities_sum_to_one_with_very_many_grams(spark):
    rng = random.Random(4)
    text = " ".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(12)) for _ in range(40_000))
    model = language_id.train(spark.createDataFrame([(text, "zh"), ("the cat", "en")], "text string, lang string"))
    grams, _ = language_id.four_grams(text.split())
    assert len(np.unique(grams)) > 400_000
    kinds = np.unique(np.concatenate([language_id.four_grams([w])[0] for w in (*text.split(), "the", "cat")]) & np.uint64(0xFFFF))
    kinds = np.append(kinds, np.uint64(0xFFFE))  # one that no language has
    for gram in rng.sample(grams.tolist(), 20):
        context = np.uint64(gram >> 16 << 16 & (1 << 64) - 1)
        assert np.exp2(-model.log_probs(context | kinds)).sum(axis=0) == pytest.approx([1, 1])


def test_held_out_accuracy_and_rejections(spark):
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    tested = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(tested)) for i in truth)
    assert sum(got[i]["lang_pred"] == truth[i] for i in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(r["rejected"] for r in got.values()) <= 0.02 * len(got)


def test_foreign_and_random_texts_of_every_length_are_rejected(spark):
    rng = random.Random(6)
    plain = {"en": "the cat and that hat sat on a mat with his other friend", "de": "die Katze und der Hut auf dem Tisch mit seinem Freund"}
    rows = [(i, " ".join(rng.choices(plain[lang].split(), k=rng.randrange(5, 60))), lang) for i in range(300) for lang in [rng.choice(["en", "de"])]]
    odd = set()
    for letters in (2, 3, 5, 9, 20, 40, 90, 400, 3000, 70_000, 200_000):
        for alphabet in ("абвгдежзийклмн", "qxzjvkwyp"):
            doc_id = 1000 + len(odd)
            odd.add(doc_id)
            text = "".join(rng.choices(alphabet, k=letters))
            rows.append((doc_id, " ".join(text[k : k + 7] for k in range(0, letters, 7)), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["rejected"] for r in language_id.identify(docs).collect()}
    assert all(got[i] for i in odd)
    assert sum(r for i, r in got.items() if i not in odd) <= 6
    assert {r["doc_id"] for r in language_id.identified(docs).collect()} == {i for i, r in got.items() if not r}


def test_limits_of_bins_with_few_texts():
    limits = language_id.every_limit({4: (100, 3.0), 5: (1, 9.0), 7: (30, 2.5)})
    assert len(limits) == language_id.BINS
    assert [limits[b] for b in (0, 4, 7, 20)] == [3.0, 3.0, 2.5, 2.5]
    assert language_id.every_limit({3: (2, 4.0)})[60] == 4.0
    assert language_id.every_limit({}) == {}


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = [(i, "the cat and the hat sat" if i % 2 else "die Katze und der Hut", "en" if i % 2 else "de") for i in range(60)]
    spoiled = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else l) for i, t, l in rows]
    schema = "doc_id long, text string, lang string"
    results = [
        sorted(tuple(r) for r in language_id.identify(spark.createDataFrame(x, schema)).collect()) for x in (rows, spoiled)
    ]
    assert results[0] == results[1]


def test_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ½ ²!", "en"), (4, "the cat", None), (None, "the cat sat", "en"), (6, "the hat", "en"), (6, "the hat", "en"), (8, "x" * 300_000, "en")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = defaultdict(list)
    for r in language_id.identify(docs).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"], r["rejected"]))
    assert all(got[i] == [("und", 0.0, True)] for i in (1, 2, 3))
    assert got[4][0][0] == "en" and len(got[6]) == 2
    kept = language_id.identified(docs)
    assert kept.schema == docs.schema
    assert {1, 2, 3}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert language_id.identify(docs.limit(0)).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_limits_rest_on_all_training_folds(spark):
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i in range(400)}
    # Only folds 2 to 4 hold the long words; fold 1 has as many short texts.
    rows = [(i, "the cat" if f == 1 else "the cat " * 40 + "qxzjv " * 20, "en") for i, f in folds.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert not any(r["rejected"] for r in got.values())
    taught = docs.where(language_id.teaches())
    limits = language_id.calibrate(language_id.scored(taught, language_id.train(taught)))
    top = limits.where("bin = 8").first()["limit"]
    assert top == pytest.approx(max(r["entropy"] for i, r in got.items() if folds[i] > 1) + language_id.SLACK)
