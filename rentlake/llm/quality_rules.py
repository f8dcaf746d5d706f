"""Learned decision lists for text quality.

Each text has a few counts (words, symbols, repeated lines and windows, capitals and so
on). From labelled texts a list of rules is learned by sequential covering: a rule grows
one threshold at a time, always the one that best separates the bad texts still uncovered
(weighted information gain), and is then pruned from its end on texts held back. A rule
that is precise enough there joins the list, the texts it covers leave, and the next one
is grown. The list becomes one ordered CASE expression of plain comparisons.

Learning reads labelled statistics alone: each step is one aggregation of counts per
feature and threshold over a narrow table, so it is bounded by the number of features and
thresholds whatever the number of rows. All labelled rows take part.

Only DataFrame functions are used. Edge cases: a null text has no words; a label without
a document, and a document without a label, teach nothing; repeated labels count as
often as they stand; without labels the list is empty and only the base rules judge; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.llm.scratch import Scratch

FEATURES = (
    "n_words",
    "mean_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "bang_share",
    "words_per_line",
    "stop_share",
)
THRESHOLDS = 24  # quantiles tried per feature
CONDITIONS = 3  # at most so many in a rule
RULES = 8  # at most so many in the list
PRECISION = 0.9  # of a rule on the texts held back
LEAST_COVERED = 5  # bad texts a rule must cover when grown, and one when pruned
GROWN = 2 / 3  # share of labelled texts that rules are grown on

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _words() -> Column:
    return F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))


def _after(items: Column, step: int) -> Column:
    """The items from number `step` on, moved to the front."""
    return F.slice(items, step + 1, F.greatest(F.size(items), F.lit(1)))


def with_repeated_words(texts: DataFrame) -> DataFrame:
    """`texts` (words) and n_repeat_words: how many words lie in three-word windows that stand
    twice or more in the text.

    Windows are sorted by hash and position; one equals a neighbour there if it repeats.
    Sorted again by position, a repeated window adds its words up to the next one. Each
    step is a column of its own, as an array that is used twice would be made twice.
    """
    words = F.col("words")
    doubles = F.zip_with(words, _after(words, 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    windows = F.zip_with(
        doubles, _after(words, 2), lambda p, c: F.when(c.isNotNull(), F.xxhash64(p["a"], p["b"], c))
    )
    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered, at = F.col("_ordered"), F.col("_at")
    pairs = F.zip_with(ordered, _after(ordered, 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    gaps = F.zip_with(at, _after(at, 1), lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3)))
    return (
        texts.withColumn("_ordered", F.array_sort(F.filter(placed, lambda s: s["h"].isNotNull())))
        .withColumn("_at", F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
        .withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("long"), lambda n, g: n + g))
        .drop("_ordered", "_at")
    )


def measured(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with its base counts, FEATURES and base_failed; the text is dropped."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))

    def of(pattern: str) -> Column:
        return (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")

    counted = (
        with_repeated_words(texts.withColumn("words", _words()))
        .withColumn("lines", lines)
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            of(SPACES).alias("spaces"),
            F.length("text").cast("long").alias("chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            "n_repeat_words",
            of("[A-Z]+").alias("upper"),
            of("[0-9]+").alias("digits"),
            of("!+").alias("bangs"),
            F.size(F.filter("words", lambda w: F.length(w) <= 3)).cast("long").alias("short"),
        )
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        "doc_id",
        "n_words",
        (F.col("chars") - F.col("spaces")).alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        ((F.col("chars") - F.col("spaces")) / words).alias("mean_word"),
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("upper") / F.greatest(F.col("chars"), F.lit(1))).alias("upper_share"),
        (F.col("digits") / F.greatest(F.col("chars"), F.lit(1))).alias("digit_share"),
        (F.col("bangs") / words).alias("bang_share"),
        (F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))).alias("words_per_line"),
        (F.col("short") / words).alias("stop_share"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self) -> Column:
        return _all(self.conditions)

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """First-order information gain of a condition, weighted by the bad texts it keeps."""
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good)))


def _counts(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Per feature, (bad, good) texts in each interval between thresholds, from one aggregation."""

    def interval(feature: str, limits: list[float]) -> Column:
        below = F.filter(F.array(*map(F.lit, limits)), lambda t: t < F.col(feature))
        return F.struct(F.lit(feature).alias("feature"), F.size(below).alias("interval"))

    pairs = [interval(feature, limits) for feature, limits in thresholds.items()]
    table = rows.select("bad", F.explode(F.array(*pairs)).alias("s")).groupBy("s.feature", "s.interval").agg(
        F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")
    )
    out = {f: [(0, 0)] * (len(t) + 1) for f, t in thresholds.items()}
    for r in table.collect():  # at most features x (thresholds + 1) rows
        out[r["feature"]][r["interval"]] = (r["bad"], r["good"])
    return out


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[Condition | None, int, int]:
    counts = _counts(rows, thresholds)
    first = next(iter(counts.values()))
    all_bad, all_good = sum(b for b, _ in first), sum(g for _, g in first)
    best, most, covered = None, 1e-9, (all_bad, all_good)
    for feature, limits in thresholds.items():
        bad = good = 0
        for (b, g), limit in zip(counts[feature], limits, strict=False):
            bad, good = bad + b, good + g
            for above, x, y in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                gain = _gain(x, y, all_bad, all_good)
                if x >= LEAST_COVERED and gain > most:
                    best, most, covered = Condition(feature, above, limit), gain, (x, y)
    return best, *covered


def _pruned(grown: list[Condition], held: DataFrame) -> tuple[tuple[Condition, ...], float, int]:
    """The beginning of the rule that does best on the texts held back: conditions, precision, bad texts covered."""
    sums = []
    for k in range(1, len(grown) + 1):
        hit = _all(grown[:k]).cast("int")
        sums += [F.coalesce(F.sum(hit * F.col("bad")), F.lit(0)), F.coalesce(F.sum(hit * (1 - F.col("bad"))), F.lit(0))]
    found = list(held.agg(*sums).first())
    best = max(
        range(len(grown)),
        key=lambda k: ((found[2 * k] - found[2 * k + 1]) / max(found[2 * k] + found[2 * k + 1], 1), -k),
    )
    bad, good = found[2 * best], found[2 * best + 1]
    return tuple(grown[: best + 1]), bad / max(bad + good, 1), bad


def learn(labelled: DataFrame) -> list[Rule]:
    """A decision list for bad texts from rows of FEATURES, `bad` (0 or 1) and `grows` (boolean)."""
    grow, held = labelled.where("grows"), labelled.where(~F.col("grows"))
    cuts = [(k + 1) / (THRESHOLDS + 1) for k in range(THRESHOLDS)]
    # Thresholds lie at quantiles of the bad and of all texts, so that rare faults get some too.
    both = [
        F.percentile_approx(F.when(F.col("bad") == bad, F.col(f).cast("double")), cuts, 10_000).alias(f"{f}_{bad}")
        for f in FEATURES
        for bad in (0, 1)
    ]
    quantiles = grow.agg(*both).first()
    thresholds = {f: sorted({*(quantiles[f"{f}_0"] or []), *(quantiles[f"{f}_1"] or [])}) for f in FEATURES}
    thresholds = {f: t for f, t in thresholds.items() if t}
    rules: list[Rule] = []
    while thresholds and len(rules) < RULES:
        left = F.lit(True)
        for r in rules:
            left = left & ~r.column()
        rows, grown = grow.where(left), []
        while len(grown) < CONDITIONS:
            condition, bad, good = _best_condition(rows.where(_all(grown)), thresholds)
            if condition is None:
                break
            grown.append(condition)
            if good <= (1 - PRECISION) * bad / 10:
                break
        if not grown:
            break
        conditions, precision, covered = _pruned(grown, held.where(left))
        if precision < PRECISION or not covered:
            break
        rules.append(Rule(conditions, precision))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that a text falls under, as one CASE expression; 0 for none."""
    out = None
    for k, rule in enumerate(rules):
        out = F.when(rule.column(), k + 1) if out is None else out.when(rule.column(), k + 1)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept, rule) for every row of `docs` (doc_id, text), by a list
    learned from `labels` (doc_id, quality); `rule` is the rule that spoke against a text."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(measured(docs), "measured")
    grows = F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(1000)) < int(1000 * GROWN)
    marks = labels.select("doc_id", (F.col("quality") == 0).cast("int").alias("bad")).where("bad is not null")
    labelled = rows.where(~F.col("base_failed")).join(marks, "doc_id").select(*FEATURES, "bad", grows.alias("grows"))
    labelled = scratch.keep(labelled, "labelled")
    rules = learn(labelled)
    scratch.clear("labelled")
    names = F.array(F.lit("none"), *(F.lit(str(r)) for r in rules))
    return rows.withColumn("number", verdict(rules)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("number") == 0)).alias("kept"),
        F.element_at(names, F.col("number") + 1).alias("rule"),
    )
