"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line; a long line is cut at the first sentence end after UNIT code
points. Its digest is a hash of it without space around. A sketch has three rows of cells. Every
distinct digest is added to one cell of each row, which keeps a count, the exclusive or
of its digests and that of their check hashes. The difference of two sketches holds the
digests of one text only. A cell with a single one gives it away; once that is taken out
of its other cells, more become single, until all differing digests are recovered.

The fingerprint of a text is its sketch of CELLS cells a row. Where peeling the
difference of two fingerprints fails, it is done again, larger: the digests of both texts
are dealt by hash to as many sketches as their number needs, each peeled alone; one that
fails is dealt to four more. What fails even then is compared digest by digest. The
likeness of two texts is the number of shared digests over that of all.

Only DataFrame functions are used, and the texts are shuffled once: dealt by ranges of
ids, so that each meets the next; the first text of the next range goes along. Edge
cases: a null text is empty and has no paragraphs; two texts without paragraphs are alike
(1); repeated rows and ids follow each other in the order of their texts, null ids come
first; a single row follows itself; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELLS = 16  # in each of the three rows of a fingerprint
FEWER = 8  # in each row of a sketch that is one of many
PER_SKETCH = 8  # digests of both texts that such a sketch is sized for
ROUNDS = 8  # of peeling
UNIT = 200
PARAGRAPH = rf"[^\n]{{1,{UNIT}}}(?:[^\n.!?]*[.!?]+)?"
SPACES = " \t\r\x0b\x0c"
RANGES = 4  # ranges of ids for each shuffle partition


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs; blank ones have none."""
    plain = F.transform(
        F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.btrim(p, F.lit(SPACES))
    )
    return F.array_distinct(F.transform(F.filter(plain, lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(digest: Column, row: int, cells: int) -> Column:
    return F.shiftrightunsigned(digest, 8 * row).bitwiseAND(F.lit(cells - 1))


def _bind(value: Column, use) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(digest: Column, n: Column, cells: int) -> Column:
    """A digest with its check hash and its cell in each row, worked out once."""
    return F.struct(
        n.alias("n"),
        digest.alias("key"),
        _check(digest).alias("check"),
        *(_cell(digest, row, cells).alias(f"cell{row}") for row in range(3)),
    )


def sketch(found: Column, cells: int = CELLS) -> Column:
    """Three rows of cells (n, key, check) of an array of distinct digests."""
    none = F.lit(0).cast("long")

    def rows(placed: Column) -> Column:
        def cell(row: int, j: int) -> Column:
            return F.aggregate(
                F.filter(placed, lambda d: d[f"cell{row}"] == j),
                F.struct(none.alias("n"), none.alias("key"), none.alias("check")),
                lambda a, d: F.struct(
                    (a["n"] + 1).alias("n"),
                    a["key"].bitwiseXOR(d["key"]).alias("key"),
                    a["check"].bitwiseXOR(d["check"]).alias("check"),
                ),
            )

        return F.array(*(cell(row, j) for row in range(3) for j in range(cells)))

    return _bind(F.transform(found, lambda d: _placed(d, F.lit(1).cast("long"), cells)), rows)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(
        a,
        b,
        lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"),
            x["key"].bitwiseXOR(y["key"]).alias("key"),
            x["check"].bitwiseXOR(y["check"]).alias("check"),
        ),
    )


def peel(difference: Column, cells: int = CELLS) -> Column:
    """(mine, others, whole): the digests on either side, and whether nothing is left in the cells."""
    none = F.array().cast("array<bigint>")
    names = [f"row{r}" for r in range(3)]

    def taken_out(state: Column, singles: Column) -> Column:
        def less(row: int):
            def cell(c: Column, j: Column) -> Column:
                return F.aggregate(
                    F.filter(singles, lambda s: s[f"cell{row}"] == j),
                    c,
                    lambda a, s: F.struct(
                        (a["n"] - s["n"]).alias("n"),
                        a["key"].bitwiseXOR(s["key"]).alias("key"),
                        a["check"].bitwiseXOR(s["check"]).alias("check"),
                    ),
                )

            return cell

        def keys(sign: int) -> Column:
            return F.transform(F.filter(singles, lambda s: s["n"] == sign), lambda s: s["key"])

        return F.struct(
            *(F.transform(state[name], less(row)).alias(name) for row, name in enumerate(names)),
            F.concat(state["mine"], keys(1)).alias("mine"),
            F.concat(state["others"], keys(-1)).alias("others"),
        )

    def singles(state: Column) -> Column:
        rows = (F.filter(state[n], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))) for n in names)
        return F.array_distinct(F.transform(F.concat(*rows), lambda c: _placed(c["key"], c["n"], cells)))

    def empty(row: Column) -> Column:
        return F.forall(row, lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))

    start = _bind(
        difference,
        lambda c: F.struct(
            *(F.slice(c, 1 + cells * row, cells).alias(name) for row, name in enumerate(names)),
            none.alias("mine"),
            none.alias("others"),
        ),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda state, _: _bind(singles(state), lambda s: F.when(F.size(s) == 0, state).otherwise(taken_out(state, s))),
        lambda state: F.struct(
            state["mine"].alias("mine"),
            state["others"].alias("others"),
            (empty(state["row0"]) & empty(state["row1"]) & empty(state["row2"])).alias("whole"),
        ),
    )


def _dealt(found: Column, sketches: Column | int, k: Column, salt: int) -> Column:
    return F.filter(found, lambda d: F.pmod(F.xxhash64(d, F.lit(salt)), sketches) == k)


def _joined(parts: Column) -> Column:
    return _bind(
        parts,
        lambda every: F.struct(
            F.flatten(F.transform(every, lambda p: p["mine"])).alias("mine"),
            F.flatten(F.transform(every, lambda p: p["others"])).alias("others"),
        ),
    )


def _exact(a: Column, b: Column) -> Column:
    return F.struct(F.array_except(a, b).alias("mine"), F.array_except(b, a).alias("others"))


def _many(a: Column, b: Column, sketches: Column, salt: int, otherwise) -> Column:
    """(mine, others) from as many sketches as asked for, to which digests are dealt by hash;
    `otherwise` has the digests of a sketch that cannot be peeled."""

    def solved(pair: Column) -> Column:
        peeled = peel(minus(sketch(pair["a"], FEWER), sketch(pair["b"], FEWER)), FEWER)
        return _bind(
            peeled,
            lambda r: F.when(r["whole"], F.struct(r["mine"].alias("mine"), r["others"].alias("others"))).otherwise(
                otherwise(pair["a"], pair["b"])
            ),
        )

    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), sketches - 1),
        lambda k: F.struct(_dealt(a, sketches, k, salt).alias("a"), _dealt(b, sketches, k, salt).alias("b")),
    )
    return _joined(F.transform(pairs, solved))


def with_difference(rows: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, name: str) -> DataFrame:
    """`rows` and column `name` (mine, others): the digests of `a` that `b` lacks, and the other way."""
    needed = F.greatest(F.ceil((F.size(a) + F.size(b)) / PER_SKETCH), F.lit(2)).cast("long")

    def larger(x: Column, y: Column) -> Column:
        return _many(x, y, F.lit(4).cast("long"), 2, _exact)

    done = F.col(name)
    return rows.withColumn(name, peel(minus(F.col(sketch_a), F.col(sketch_b)))).withColumn(
        name,
        F.when(done["whole"], F.struct(done["mine"].alias("mine"), done["others"].alias("others"))).otherwise(
            _many(F.col(a), F.col(b), needed, 1, larger)
        ),
    )


def likeness(found: str, difference: str) -> Column:
    shared = F.size(found) - F.size(F.col(difference)["mine"])
    every = F.size(found) + F.size(F.col(difference)["others"])
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def printed(cells: Column) -> Column:
    """A sketch as text: count, digests and checks of each cell in hexadecimal."""
    return F.array_join(
        F.transform(
            cells,
            lambda c: F.concat_ws(
                "", F.hex(c["n"]), F.lit("."), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0")
            ),
        ),
        "-",
    )


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """`docs` (doc_id, text, ...) with next_<c> of each carried column: its value in the row with
    the next doc_id, in the first row for the last one.

    Ranges of ids are cut at quantiles. Each range gets a copy of the first row of the
    one after it, so that one window over each range suffices.
    """
    spark = docs.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cuts = [(k + 1) / ranges for k in range(ranges - 1)]
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", cuts, 100 * ranges)).first()[0] or []))
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    long = "array<bigint>"
    heads = F.array(*(F.lit(g[0]) for g in groups)).cast(long)
    nested = F.array(*(F.array(*map(F.lit, g)).cast(long) for g in groups)).cast(f"array<{long}>")
    # The number of bounds up to the id, found among the heads of groups and in one group.
    group = F.size(F.filter(heads, lambda x: x <= F.col("doc_id")))
    inside = F.size(F.filter(F.get(nested, F.col("_group") - 1), lambda x: x <= F.col("doc_id")))
    place = F.when(F.col("_group") > 0, (F.col("_group") - 1) * width + inside).otherwise(0)
    # A null id lies before all others.
    placed = (
        docs.withColumn("_group", F.when(F.col("doc_id").isNull(), 0).otherwise(group))
        .withColumn("_range", F.when(F.col("doc_id").isNull(), -1).otherwise(place))
        .drop("_group")
    )
    firsts = placed.groupBy("_range").agg(F.min("doc_id").alias("doc_id")).orderBy("_range").collect()
    before = [(r["doc_id"], firsts[k - 1]["_range"]) for k, r in enumerate(firsts)]  # one row a range
    copies = spark.createDataFrame(before, "_first long, _range int")
    along = (
        docs.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("_first")))
        .drop("_first")
        .withColumn("_copy", F.lit(1))
    )
    order = Window.partitionBy("_range").orderBy("_copy", "doc_id", "text")
    return (
        placed.withColumn("_copy", F.lit(0))
        .unionByName(along)
        .select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried))
        .where("_copy = 0")
        .drop("_copy", "_range")
    )


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    changed, changed_to) for every row of `docs` (doc_id, text); the last two are the digests
    that the edited text lacks and those it has instead."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("found", digests(F.col("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (
        with_next(texts, ["text", "found"])
        .withColumn("n_chars", F.length("text"))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half), F.substring(F.col("next_text"), F.lit(1), half)
            ),
        )
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "found",
            "next_found",
            digests(F.col("edited")).alias("edited_found"),
        )
        .withColumn("own", sketch(F.col("found")))
        .withColumn("edited", sketch(F.col("edited_found")))
        .withColumn("next", sketch(F.col("next_found")))
    )
    rows = with_difference(rows, "found", "edited_found", "own", "edited", "by_edit")
    rows = with_difference(rows, "found", "next_found", "own", "next", "by_next")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("edited")).alias("edited_fingerprint"),
        likeness("found", "by_edit").alias("near_edited"),
        likeness("found", "by_next").alias("near_next"),
        F.col("by_edit")["mine"].alias("changed"),
        F.col("by_edit")["others"].alias("changed_to"),
    )
