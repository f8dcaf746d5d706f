"""Language identification by interpolated Kneser-Ney character models.

Each language has a four-gram model over the letters of its words, lower-cased, with
three start marks before and one end mark after each word. Counts are taken over all
training rows: every task counts its distinct words, then their four-grams, and Spark
adds the counts up. Lower orders use continuation counts, as Kneser and Ney have it, and
every order is interpolated with the one below it.

The model has, per order, a sorted array of hashes, and beside it the values of the
languages that have the gram or context. It holds every gram of the training rows, so the
probabilities of a language sum to one; its size follows the number of different grams,
and it has to fit into the driver and into each worker.

A text gets the language of the lowest cross-entropy per character. Its score is the
share of that language among the likelihoods of about EVIDENCE characters. It is rejected
if its cross-entropy is above what nearly all training texts of such a length reach in
their own language (quantile KEPT of all training texts, plus SLACK). Lengths are binned by
powers of two; a bin with fewer than FEW such texts takes the largest limit of
the nearest bins that have as many together, so that every length has a limit.

Edge cases: a null text, or one without a letter, is `und` with score 0 and rejected, and
so is every text if there is no training row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.llm.bytesum import U, mix
from rentlake.llm.scratch import Scratch

ORDER = 4
EVIDENCE = 64.0
KEPT = 0.999
SLACK = 0.5  # bits a character
FEW = 20  # texts that a limit rests on, if there are as many
BINS = 64  # powers of two that a number of letters can reach
ROWS = 1000  # texts that one task scores at a time
COUNTED = 2500  # texts whose words one task counts at a time

LETTERS = re.compile(r"[^\W\d_]+")
START, END = "\x01", "\x02"
COLUMNS = "doc_id long, lang_pred string, score double, entropy double, letters long, teaches boolean"


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def letters_of(word: str) -> str:
    """The word without signs that count as neither letters nor digits, such as fractions."""
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def four_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed four-grams of all words, and the number of the word each belongs to.

    A unit of 16 bits counts as a character; one beyond the basic plane is two of them, so that
    different ones stay apart.
    """
    clean = [letters_of(w) for w in words]
    joined = "".join([f"{START * (ORDER - 1)}{w}{END}" for w in clean if w])
    points = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), dtype="<u2").astype(U)
    packed = points.copy()
    for k in range(1, ORDER):
        packed[k:] |= points[:-k] << U(16 * k)
    units = len if len(points) == len(joined) else lambda w: len(w.encode("utf-16-le", "surrogatepass")) // 2
    word = np.repeat(np.arange(len(words)), [units(w) + 1 if w else 0 for w in clean])
    return packed[points != ord(START)], word


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the batches of a task, added up for COUNTED texts at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, COUNTED):
            part = batch.slice(low, COUNTED)
            counters: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                counters[lang].update(words_of(text))
            for lang, words in counters.items():
                yield _counted(lang, words)


def _counted(lang: str, words: Counter) -> pa.RecordBatch:
    grams, word = four_grams(list(words))
    times = np.fromiter(words.values(), dtype=np.int64, count=len(words))
    found, at = np.unique(grams, return_inverse=True)
    n = np.bincount(at, weights=times[word], minlength=len(found)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
        ["lang", "gram", "n"],
    )


def smoothed(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Of (lang, gram, n): (lang, gram, alpha) and (lang, context, gamma) of one order.

    alpha is the discounted share of the gram after its context, gamma what is left for the
    order below.
    """
    context = F.shiftrightunsigned("gram", 16)
    once = F.sum(F.when(F.col("n") == 1, 1).otherwise(0))
    twice = F.sum(F.when(F.col("n") == 2, 1).otherwise(0))
    discounts = counts.groupBy("lang").agg(
        F.greatest(F.lit(0.1), F.coalesce(F.try_divide(once, once + 2 * twice), F.lit(0.5))).alias("discount")
    )
    kept_back = F.least("discount", F.lit(0.9))
    totals = (
        counts.groupBy("lang", context.alias("context"))
        .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        .join(discounts, "lang")
        .withColumn("discount", kept_back)
        .withColumn("gamma", F.col("discount") * F.col("kinds") / F.col("total"))
    )
    grams = (
        counts.withColumn("context", context)
        .join(totals, ["lang", "context"])
        .select("lang", "gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("alpha"))
    )
    return grams, totals.select("lang", "context", "gamma")


@dataclass
class Table:
    """Sorted hashes; those at k have `values` of `langs` from first[k] to first[k + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    def of(self, keys: np.ndarray, n_langs: int, absent: float) -> np.ndarray:
        """A row of values for each key, `absent` where a language has none."""
        out = np.full((len(keys), n_langs), absent)
        if not len(self.hashes):
            return out
        wanted = mix(keys)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        row = np.flatnonzero(self.hashes[at] == wanted)
        low, size = self.first[at[row]], self.first[at[row] + 1] - self.first[at[row]]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        entry = np.repeat(low, size) + within
        out[np.repeat(row, size), self.langs[entry]] = self.values[entry]
        return out


@dataclass
class Model:
    """Per order, tables of grams and of contexts."""

    langs: list[str]
    grams: list[Table]
    contexts: list[Table]
    floor: float
    limits: np.ndarray | None = None

    def log_probs(self, packed: np.ndarray) -> np.ndarray:
        """Bits of the last character of each packed four-gram, in every language."""
        p = np.full((len(packed), len(self.langs)), self.floor)
        for order in range(1, ORDER + 1):
            gram = packed & U((1 << 16 * order) - 1)
            context = (gram >> U(16)) if order > 1 else np.zeros(len(packed), dtype=U)
            n_langs = len(self.langs)
            p = self.grams[order - 1].of(gram, n_langs, 0.0) + self.contexts[order - 1].of(context, n_langs, 1.0) * p
        return -np.log2(p)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text in every language, and its number of characters."""
        numbers: dict[str, int] = defaultdict(count().__next__)
        lists = [[numbers[w] for w in words_of(t)] for t in texts]
        grams, word = four_grams(list(numbers))
        found, at = np.unique(grams, return_inverse=True)
        each = self.log_probs(found)
        length = np.bincount(word, minlength=len(numbers))
        flat = np.fromiter((w for ws in lists for w in ws), dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in lists])
        sizes = np.bincount(owner, weights=length[flat], minlength=len(texts)) if len(flat) else np.zeros(len(texts))
        sums = np.zeros((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            of_word = np.bincount(word, weights=each[at, k], minlength=len(numbers))
            if len(flat):
                sums[:, k] = np.bincount(owner, weights=of_word[flat], minlength=len(texts))
        return sums / np.maximum(sizes, 1)[:, None], sizes.astype(np.int64)

    def predict(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                bits, sizes = self.entropies(part.column("text").to_pylist())
                known = (sizes > 0) & bool(self.langs)
                best = bits.argmin(axis=1) if self.langs else np.zeros(len(sizes), dtype=int)
                least = bits.min(axis=1) if self.langs else np.zeros(len(sizes))
                apart = (bits - least[:, None]) * np.minimum(sizes, EVIDENCE)[:, None]
                score = 1 / np.maximum(np.exp2(-apart).sum(axis=1), 1e-9) if self.langs else np.zeros(len(sizes))
                names = [self.langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(names, pa.string()),
                        pa.array(np.where(known, np.clip(score, 0, 1), 0.0)),
                        pa.array(least),
                        pa.array(sizes),
                        part.column("teaches"),
                    ],
                    ["doc_id", "lang_pred", "score", "entropy", "letters", "teaches"],
                )


def _table(rows: DataFrame, key: str, value: str, langs: list[str]) -> Table:
    number = F.create_map(*(F.lit(x) for k, lang in enumerate(langs) for x in (lang, k))) if langs else F.lit(None)
    of = number[F.col("lang")] if langs else number
    frame = rows.select(of.cast("short").alias("lang"), key, value).toArrow()
    hashes = mix(frame.column(key).to_numpy().astype(np.int64).view(U))
    order = np.argsort(hashes, kind="stable")
    found, first = np.unique(hashes[order], return_index=True)
    return Table(
        found,
        np.append(first, len(hashes)).astype(np.int64),
        frame.column("lang").to_numpy().astype(np.int16)[order],
        frame.column(value).to_numpy().astype(np.float64)[order],
    )


def train(training: DataFrame) -> Model:
    """A model from the rows of (lang, text) whose lang is not null."""
    scratch = Scratch(training.sparkSession)
    rows = training.select(F.col("lang").cast("string").alias("lang"), "text").where("lang is not null")
    counts = rows.mapInArrow(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts, "counts_4")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    grams, contexts = [], []
    for order in range(ORDER, 0, -1):
        alpha, gamma = smoothed(counts, order)
        grams.append(_table(alpha, "gram", "alpha", langs))
        contexts.append(_table(gamma, "context", "gamma", langs))
        if order > 1:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
            counts = scratch.keep(
                counts.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), f"counts_{order - 1}"
            )
    kinds = max(len(grams[-1].hashes), 1)
    scratch.clear(*(f"counts_{order}" for order in range(1, ORDER + 1)))
    return Model(langs, grams[::-1], contexts[::-1], 1.0 / (kinds + 1))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    predict: Callable = lambda batches: shared.value.predict(batches)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), teaches().alias("teaches"))
    return texts.mapInArrow(predict, COLUMNS)


def length_bin(letters: str = "letters") -> Column:
    return F.floor(F.log2(F.greatest(F.col(letters), F.lit(1)))).cast("int")


def calibrate(known: DataFrame) -> DataFrame:
    """(bin, limit): the cross-entropy that texts of a length may have, for every bin, from the
    (entropy, letters) of all training texts."""
    rows = known.where("letters > 0").groupBy(length_bin().alias("bin")).agg(
        F.count("*").alias("n"), (F.percentile_approx("entropy", KEPT, 100_000) + SLACK).alias("limit")
    ).collect()  # at most BINS rows
    limits = every_limit({r["bin"]: (r["n"], r["limit"]) for r in rows})
    return known.sparkSession.createDataFrame(sorted(limits.items()), "bin int, limit double")


def every_limit(found: dict[int, tuple[int, float]]) -> dict[int, float]:
    """A limit for every bin from the (number of texts, limit) of some."""
    limits = {}
    for b in range(BINS) if found else ():
        for reach in range(BINS):
            near = [found[k] for k in range(b - reach, b + reach + 1) if k in found]
            if near and (sum(n for n, _ in near) >= FEW or len(near) == len(found)):
                limits[b] = max(limit for _, limit in near)
                break
    return limits


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def teaches() -> Column:
    """Is a row one that models and limits are learned from, one of folds 1 to 4 with a language?"""
    return (fold_of(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull()


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected, entropy) for every row of `docs` (doc_id, text, lang).

    Every text is scored once; limits and rejections are taken from the written scores.
    """
    model = train(docs.where(teaches()))
    each = Scratch(docs.sparkSession).keep(scored(docs, model), "scores")
    limits = calibrate(each.where("teaches"))
    return (
        each.withColumn("bin", length_bin())
        .join(F.broadcast(limits), "bin", "left")
        .select(
            "doc_id",
            (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
            "lang_pred",
            "score",
            ((F.col("lang_pred") == "und") | (F.col("entropy") > F.col("limit"))).alias("rejected"),
            "entropy",
        )
    )


def identified(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that are rejected.

    The text is scored where it lies, so no row moves: the other columns are carried along.
    """
    taught = docs.where(teaches())
    model = train(taught)
    limits = calibrate(scored(taught, model))
    numbers = {r["bin"]: r["limit"] for r in limits.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                bits, sizes = shared.value.entropies(part.column("text").cast(pa.string()).to_pylist())
                least = bits.min(axis=1) if shared.value.langs else np.full(len(sizes), np.inf)
                limit = [numbers.get(int(b), -np.inf) for b in np.log2(np.maximum(sizes, 1)).astype(int)]
                yield part.filter(pa.array((sizes > 0) & (least <= limit) & (least < np.inf)))

    return docs.mapInArrow(known, docs.schema)
