"""Toxicity by boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words that stand in toxic training texts far more often than in
others. Features are its density and its nearness to words of address (you, your and the
like in four languages), capitals, punctuation and obfuscated spellings. Gradient-boosted
trees are fitted to them, and an isotonic regression, fitted on texts held back, turns
their margin into a probability.

Fitting reads at most SAMPLE labelled texts, those of the smallest hashes of their ids,
so the sample does not depend on partitions; features and scores cover all texts.

Edge cases: a null text has no words and gets a score like any other; repeated labels
count as often as they stand; without labels of both kinds every text gets the share of
toxic ones (0 without any); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlake.llm.language_id import fold_of
from rentlake.llm.scratch import Scratch

SAMPLE = 20_000
LEXICON = 200  # words at most
ODDS = 4.0  # how many times as often a word must stand in toxic texts
SEEN = 5  # toxic texts a word must stand in
NEAR = 3  # words between an address and a lexicon word
TREES, DEPTH = 20, 4
CUT = 0.3

# Words of address in English, German, French and Spanish.
ADDRESS = (
    "you", "your", "yours", "yourself", "u", "ur",
    "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer",
    "tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "vos",
    "ti", "tus", "usted", "ustedes", "vosotros",
)

FEATURES = (
    "lexicon",
    "lexicon_density",
    "lexicon_kinds",
    "near_address",
    "address_density",
    "capital_share",
    "capital_words",
    "bangs",
    "questions",
    "punctuation",
    "obfuscated",
    "words",
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def learn_lexicon(rows: DataFrame) -> list[str]:
    """Words of `rows` (text, toxic) that tell toxic texts from others, strongest first."""
    words = rows.select("toxic", F.explode(F.array_distinct(words_of(_text()))).alias("word"))
    sizes = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    counts = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    odds = ((F.col("bad") + 0.5) / (sizes[0] + 1)) / ((F.col("n") - F.col("bad") + 0.5) / (sizes[1] - sizes[0] + 1))
    top = counts.where(F.col("bad") >= SEEN).withColumn("odds", odds).where(F.col("odds") >= ODDS)
    return [r["word"] for r in top.orderBy(F.desc("odds"), "word").limit(LEXICON).collect()]


def with_features(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """`docs` (doc_id, text, ...) with FEATURES instead of the text.

    The words become one letter each, L for the lexicon and Y for an address, so that
    nearness is a pattern over that string.
    """
    kinds = lambda w: F.when(w.isin(lexicon), "L").when(w.isin(*ADDRESS), "Y").otherwise("x")
    others = [c for c in docs.columns if c != "text" and c not in FEATURES]
    counted = (
        docs.select(*others, _text().alias("text"))
        .withColumn("_words", words_of(F.col("text")))
        .select(
            *others,
            F.array_join(F.transform("_words", kinds), "").alias("_kinds"),
            F.size(F.array_distinct(F.filter("_words", lambda w: w.isin(lexicon)))).alias("lexicon_kinds"),
            F.greatest(F.length("text"), F.lit(1)).alias("_chars"),
            (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).alias("_capitals"),
            F.regexp_count("text", F.lit(r"(?<!\p{L})\p{Lu}{2,}(?!\p{L})")).alias("_capital_words"),
            (F.length("text") - F.length(F.translate("text", "!", ""))).alias("bangs"),
            (F.length("text") - F.length(F.translate("text", "?", ""))).alias("questions"),
            (F.length("text") - F.length(F.translate("text", ".,;:#*$%&|<>@", ""))).alias("_marks"),
            F.regexp_count("text", F.lit(r"\p{L}[0-9@$*!]+\p{L}")).alias("_obfuscated"),
        )
    )
    words = F.greatest(F.length("_kinds"), F.lit(1))

    def number(letter: str) -> Column:
        return F.length("_kinds") - F.length(F.translate("_kinds", letter, ""))

    near = F.regexp_count("_kinds", F.lit(rf"Y[^L]{{0,{NEAR}}}L|L[^Y]{{0,{NEAR}}}Y"))
    return counted.select(
        *others,
        number("L").cast("double").alias("lexicon"),
        (number("L") / words).alias("lexicon_density"),
        F.col("lexicon_kinds").cast("double").alias("lexicon_kinds"),
        near.cast("double").alias("near_address"),
        (number("Y") / words).alias("address_density"),
        (F.col("_capitals") / F.col("_chars")).alias("capital_share"),
        (F.col("_capital_words") / words).alias("capital_words"),
        (F.col("bangs") / words).alias("bangs"),
        (F.col("questions") / words).alias("questions"),
        (F.col("_marks") / words).alias("punctuation"),
        (F.col("_obfuscated") / words).alias("obfuscated"),
        F.length("_kinds").cast("double").alias("words"),
    )


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text), learned from
    `labels` (doc_id, toxic) of ids outside the held-out fold."""
    scratch = Scratch(docs.sparkSession)
    held_out = fold_of(F.col("doc_id"), 4) == 2
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = marks.where(~held_out & F.col("toxic").isin(0, 1)).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    # At most SAMPLE rows of two numbers, so the texts need not be shuffled.
    sample = scratch.keep(texts.join(F.broadcast(chosen), "doc_id").repartition(8), "sample")
    lexicon = learn_lexicon(sample)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    back = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0
    rows = scratch.keep(with_features(sample, lexicon).withColumn("back", back), "features")
    kinds = {(r["back"], r["toxic"]): r["count"] for r in rows.groupBy("back", "toxic").count().collect()}
    scored = with_features(texts, lexicon)
    if all(kinds.get((b, t)) for b in (True, False) for t in (0, 1)):
        trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=5)
        model = trees.fit(table.transform(rows.where("not back")).select("features", "toxic"))

        def margin(of: DataFrame) -> DataFrame:
            raw = model.transform(table.transform(of))
            return raw.withColumn("margin", vector_to_array("rawPrediction")[1]).drop(
                "features", "rawPrediction", "probability", "prediction"
            )

        isotonic = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="score")
        calibrated = isotonic.fit(margin(rows.where("back")).select("margin", F.col("toxic").cast("double").alias("toxic")))
        scored = calibrated.transform(margin(scored))
        value = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    else:
        total = sum(kinds.values())
        value = F.lit(sum(n for (_, t), n in kinds.items() if t) / total if total else 0.0)
    return scored.select("doc_id", held_out.alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )
