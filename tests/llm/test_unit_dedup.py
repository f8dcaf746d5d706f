import random

from rentlake.llm import unit_dedup


def brute(rows):
    seen, out = {}, []
    ranked = sorted(((i is None, i or 0, k, t) for k, (i, t) in enumerate(rows)), key=lambda r: r[:3])
    for none, i, _, text in ranked:
        for start, end, _ in unit_dedup.units(text or ""):
            key = " ".join(text[start:end].split()).lower()
            here = (None if none else i, start)
            if key in seen:
                out.append((*here, end, *seen[key]))
            else:
                seen[key] = here
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(8)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    sentence = lambda: " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(rng.randrange(2, 14))) + rng.choice([".", "!", ""])
    common = [sentence() for _ in range(6)]
    texts = [None, "", "\n\n", "short line"]
    for _ in range(60):
        parts = [rng.choice(common) if rng.random() < 0.2 else sentence() for _ in range(rng.randrange(1, 12))]
        texts.append("".join(p + rng.choice([" ", "\n", "  \t", "\n\n"]) for p in parts))
    return [(3 * i, t) for i, t in enumerate(texts)]


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in unit_dedup.repeated_units(docs).drop("row").collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus()
    assert result(spark, rows) == brute(rows)
    assert len(brute(rows)) > 20


def test_passage_within_other_lines_is_found(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(" ".join(word() for _ in range(n)).capitalize() + "." for n in (4, 9, 12, 3, 15, 11, 8))
    rows = [(i, f"{' '.join(word() for _ in range(30))}. {passage} {' '.join(word() for _ in range(20))}.") for i in range(5)]
    removed = {r[0] for r in result(spark, rows)}
    assert removed == {1, 2, 3, 4}


def test_cut_texts(spark):
    rows = [(1, "One two three four five.\nKeep this other line right here"), (2, "x\nONE  two three four five. tail"), (3, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    got = unit_dedup.without_repeats(docs)
    assert got.dtypes == docs.dtypes
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: rows[0][1], 2: "x\n tail", 3: None}


def test_repeated_rows_and_empty(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f")]
    assert result(spark, rows) == [(5, 0, 11, 5, 0), (None, 0, 11, 5, 0)]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert unit_dedup.repeated_units(docs).collect() == []


def lines_of(rows):
    """Repeated lines, split by hand: every line that is not blank counts, however short."""
    seen, out = {}, set()
    for doc_id, text in rows:
        at = 0
        for line in (text or "").split("\n"):
            key = " ".join(line.lower().split())
            start = at + len(line) - len(line.lstrip())
            if key in seen:
                out.add((doc_id, start, at + len(line.rstrip()), *seen[key]))
            elif key:
                seen[key] = (doc_id, start)
            at += len(line) + 1
    return out


def test_every_repeated_line_goes_whatever_its_length(spark):
    han = "".join(chr(0x4E00 + i) for i in range(200))
    rows = [
        (1, f"All rights reserved.\nHome | About\n{han}\nOne two three four five. A tail"),
        (2, f"Other text\n  all  rights reserved.\t\n\n{han}\nhome | about\nx"),
        (3, "One two three four five. A tail\nA tail\nSix seven eight nine ten eleven. a tail"),
        (4, "x\nSix seven eight nine ten eleven! One two three four five. Twelve"),
        (5, "a tail"),
    ]
    got = result(spark, rows)
    lines = lines_of(rows)
    assert len(lines) == 6 and lines <= set(got)
    # Beside these only the sentence that stands in a line of its own right.
    assert set(got) - lines == {(4, 35, 59, 1, 31 + len(han) + 4)}
    assert len(got) == len(set(got))
    assert {r[:3] for r in lines_of(corpus())} <= {r[:3] for r in result(spark, corpus())}


def test_removed_units_do_not_overlap(spark):
    line = "One two three four five. Six seven eight nine ten eleven. Rest"
    rows = [(1, line), (2, f"y\n{line}\nz"), (3, f"Six seven eight nine ten eleven. Other {line}")]
    got = result(spark, rows)
    assert [r[:3] for r in got if r[0] == 2] == [(2, 2, 2 + len(line))]
    for a in got:
        assert not any(a is not b and a[0] == b[0] and a[1] < b[2] and b[1] < a[2] for b in got)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in unit_dedup.without_repeats(docs).collect()}[2] == "y\n\nz"
