import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rentlake.llm import fill_middle
from tests.conftest import SAMPLES

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, rate=100, spm=50, seed=7):
    """(n, form, prefix_chars, middle_chars, output), one unit after the other."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    None, "", "\n", "\n\n\n", "no end", "a\nb", "a\nb\n", "one <P> marker\nx", "x<S>", "<M>", "almost <P <S\n< M>\n<", "<\n<\n<\nS>\nP>\n",
    "\r\n\x85 tabs\tare no units\x0b\n", "é😀\n日本\n😀", " ", "x" * 50_000 + "\n" + "y\n" * 3000,
]


def test_whole_sample_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = fill_middle.digests(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        n, form, prefix, middle, output = brute(r["doc_id"], texts[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert {r["form"] for r in got} >= {"psm", "spm"}


def test_odd_texts_and_extra_columns(spark):
    rows = [(100 * k + i, t, "kept", 5) for k in range(30) for i, t in enumerate(ODD)] + [(None, "a\nb\nc", "kept", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(4)
    cut = fill_middle.fill_in_middle(docs)
    got = cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) and cut.columns[:3] == ["doc_id", "text", "source"]
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "") and r["source"] == "kept"
    assert fill_middle.digests(docs.limit(0)).collect() == []


@pytest.mark.parametrize(("rate", "spm"), [(0, 50), (40, 0), (100, 100)])
def test_rates_seeds_and_other_units(spark, rate, spm):
    rules = fill_middle.Rules(rate=rate, spm_rate=spm, seed=9)
    rows = [(i, f"line {i}\nmore\nend") for i in range(200)]
    got = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rules).collect()
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"], rate, spm, 9)
    words = fill_middle.Rules(unit=r"\s*\S+|\s+")
    got = fill_middle.fill_in_middle(spark.createDataFrame([(1, "one two  three ")], "doc_id long, text string"), words).collect()
    assert got[0]["n"] == 4


def test_units_must_cover_and_markers_must_not_overlap(spark):
    with pytest.raises(ValueError):
        fill_middle.Rules(prefix="<a", suffix="b<")
    with pytest.raises(ValueError):
        fill_middle.Rules(prefix="<P>", suffix="<P>>")
    bad = fill_middle.fill_in_middle(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), fill_middle.Rules(unit="[a-z]"))
    with pytest.raises(Exception, match="do not cover"):
        bad.collect()
