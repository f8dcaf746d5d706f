"""Mix sources to target weights by pivotal dependent rounding.

A document's size is its number of words (runs of characters other than space and 09 to
0D; a null text has none). Sources, by code point and null last, weigh 1, 2, 3 and so on
again, and share the total of all sizes; a target stops at three times its source's size
and the excess is shared again by weight until none is above.

A source's documents are rounded by size, the classes of the largest ones first. In each
class every document is due what is left of the target over the words that are left, three
copies at most. The whole part is certain. The fractional parts are rounded in dependence on
each other: two documents pass words from one to the other, the direction drawn so that each
keeps its expected copies, until one of them has a whole number. Documents meet in small
chunks; what a chunk leaves unsettled meets the rest of other chunks one level up, down to
one document a source, which is drawn alone. The words that it takes too many or too few
fall to the smaller classes, where they change what is due a little; so a source's words
differ from its target by less than the last, small document, as long as its smaller
documents have words enough.

Only DataFrame functions are used. Draws depend on documents alone, so reruns agree.
Edge cases: an empty table gives no rows; documents without words are taken 0 times;
repeated rows are told apart by a running number; null ids and sources are values like
any other; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.llm.scratch import Scratch
from rentlake.operators.ordered import ranked

MOST = 3  # a target is at most so many times its source's size
FAN_IN = 64  # documents, or rests of chunks, that are rounded together
CLASS_BITS = 3  # sizes of one class differ by a factor of 2 ** CLASS_BITS at most
SEED = 8
WORD = r"[^\x20\x09-\x0D]+"

UNIT = "struct<size:bigint,doc_id:bigint,copy:bigint,base:bigint,p:double>"
DONE = "array<struct<size:bigint,doc_id:bigint,copies:bigint>>"

# One step over the units of a chunk: `a.c` is the unsettled unit so far, `x` the next one.
# `up` and `down` are the most words that a.c can take from x or give to it.
PIVOT = f"""
aggregate(units, named_struct('c', cast(null as {UNIT}), 'done', cast(array() as {DONE})), (a, x) ->
  CASE WHEN a.c IS NULL THEN named_struct('c', x, 'done', a.done) ELSE
    transform(array(named_struct(
        'up', least(a.c.size * (1 - a.c.p), x.size * x.p),
        'down', least(a.c.size * a.c.p, x.size * (1 - x.p)),
        'u', (xxhash64({SEED}, a.c.doc_id, a.c.copy, x.doc_id, x.copy) & 9007199254740991L) / 9007199254740992D)), m ->
      transform(array(
          CASE WHEN m.u * (m.up + m.down) < m.down
            THEN named_struct('whole', m.up >= a.c.size * (1 - a.c.p),
                              'mine', a.c.p + m.up / a.c.size, 'other', x.p - m.up / x.size)
            ELSE named_struct('whole', m.down >= a.c.size * a.c.p,
                              'mine', a.c.p - m.down / a.c.size, 'other', x.p + m.down / x.size) END), s ->
        CASE WHEN s.whole
          THEN named_struct(
            'c', named_struct('size', x.size, 'doc_id', x.doc_id, 'copy', x.copy, 'base', x.base,
                              'p', least(greatest(s.other, 0D), 1D)),
            'done', concat(a.done, array(named_struct('size', a.c.size, 'doc_id', a.c.doc_id,
                                                      'copies', a.c.base + cast(round(s.mine) as bigint)))))
          ELSE named_struct(
            'c', named_struct('size', a.c.size, 'doc_id', a.c.doc_id, 'copy', a.c.copy, 'base', a.c.base,
                              'p', least(greatest(s.mine, 0D), 1D)),
            'done', concat(a.done, array(named_struct('size', x.size, 'doc_id', x.doc_id,
                                                      'copies', x.base + cast(round(s.other) as bigint))))) END)[0])[0]
  END)
"""


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame) -> DataFrame:
    """(source, number, source_size, target) from (source, source_size), one row a source.

    `level` is what a unit of weight is due. Sources that would be above their limit stop
    there and leave the rest to the others, which raises the level, until no more do: two
    sums a round, whatever the number of sources.
    """
    numbered = ranked(totals, [F.asc_nulls_last("source")], "number").withColumn("weight", (F.col("number") - 1) % 3 + 1)
    limit, level = MOST * F.col("source_size"), 0.0
    while True:
        stopped = (F.col("weight") * F.lit(level)) > limit
        sums = numbered.agg(
            (F.sum("source_size") - F.coalesce(F.sum(F.when(stopped, limit)), F.lit(0))).alias("rest"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("weights"),
        ).first()
        risen = sums["rest"] / sums["weights"] if sums["weights"] else level
        if risen <= level:
            break
        level = risen
    target = F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    return numbered.select("source", "number", "source_size", target.alias("target"))


def _rounded(units: DataFrame, most: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """(number, size, doc_id, copies) of documents of one class, with `due` and the `chunks` of their source; `most` chunks at the most."""
    base = F.floor(F.col("due") + 1e-9)
    p = F.greatest(F.col("due") - base, F.lit(0.0))
    units = units.withColumns({"base": base, "p": F.when(p > 1e-9, p).otherwise(0.0)})
    settled = [units.where("p = 0").select("number", "size", "doc_id", F.col("base").alias("copies"))]
    chunk = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "copy"), F.col("chunks"))
    level = units.where("p > 0").select("number", chunk.alias("chunk"), F.struct("size", "doc_id", "copy", "base", "p").alias("unit"))
    chunks, turn = most, 0
    while chunks:
        met = level.groupBy("number", "chunk").agg(F.reverse(F.array_sort(F.collect_list("unit"))).alias("units"))
        met = scratch.keep(met.select("number", "chunk", F.expr(PIVOT).alias("met")), f"{name}_{turn}")
        settled.append(met.select("number", F.inline("met.done")))
        level = met.select("number", F.floor(F.col("chunk") / FAN_IN).alias("chunk"), F.col("met.c").alias("unit"))
        chunks, turn = (0 if chunks == 1 else -(-chunks // FAN_IN)), turn + 1
    draw = F.xxhash64(F.lit(SEED), "unit.doc_id", "unit.copy").bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))
    last = F.col("unit.base") + (draw < F.col("unit.p")).cast("long")
    settled.append(level.select("number", "unit.size", "unit.doc_id", last.alias("copies")))
    return settled


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source) for every row of `docs` (doc_id, text, source)."""
    scratch = Scratch(docs.sparkSession)
    size_class = F.when(F.col("size") > 0, F.floor(F.log2("size") / CLASS_BITS)).cast("int")
    sizes = (
        docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .count()
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "count")))
        .select("doc_id", "source", "size", "copy", size_class.alias("class"))
    )
    sizes = scratch.keep(sizes, "sizes")
    by_class = sizes.groupBy("source", "class").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    by_class = scratch.keep(by_class, "by_class")
    targets = scratch.keep(source_targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size"))), "targets")
    named = targets.withColumnRenamed("source", "_source")
    of_source = F.col("source").eqNullSafe(F.col("_source"))
    numbers = named.select("_source", "number")
    by_class = scratch.keep(by_class.join(numbers, of_source).select("number", "class", "words", "docs"), "numbered_classes")
    units = scratch.keep(sizes.join(numbers, of_source).select("number", "size", "doc_id", "copy", "class"), "units")

    taken = [units.where("size = 0").select("number", "size", "doc_id", F.lit(0).cast("long").alias("copies"))]
    # What is left of the target, and the words left, of each source.
    left = targets.select("number", F.col("target").alias("due_words"), F.col("source_size").alias("words_left"))
    most = by_class.where("class is not null").groupBy("class").agg(F.max("docs").alias("docs")).collect()  # 21 classes at most
    for size_class, docs_in in sorted(((r["class"], r["docs"]) for r in most), reverse=True):
        own = by_class.where(F.col("class") == size_class)
        due = F.greatest(F.least(F.col("due_words") / F.col("words_left"), F.lit(float(MOST))), F.lit(0.0))
        chunks = F.ceil(F.col("docs") / FAN_IN)
        dues = scratch.keep(left.join(own, "number").select("number", due.alias("due"), chunks.alias("chunks")), f"due_{size_class}")
        met = units.where(F.col("class") == size_class).join(dues, "number")
        parts = _rounded(met, -(-docs_in // FAN_IN), scratch, f"class_{size_class}")
        for part in parts:
            taken.append(part)
        words = parts[0]
        for part in parts[1:]:
            words = words.unionByName(part)
        spent = words.groupBy("number").agg(F.sum(F.col("size") * F.col("copies")).alias("spent"))
        left = left.join(spent, "number", "left").join(own.select("number", "words"), "number", "left")
        left = scratch.keep(
            left.select(
                "number",
                (F.col("due_words") - F.coalesce("spent", F.lit(0))).alias("due_words"),
                (F.col("words_left") - F.coalesce("words", F.lit(0))).alias("words_left"),
            ),
            f"left_{size_class}",
        )
    whole = taken[0]
    for part in taken[1:]:
        whole = whole.unionByName(part)
    return whole.join(targets, "number").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """`docs` itself, each row as often as the mix takes it.

    Rows alike in id, source and size share their copies by a running number; the join
    has dealt them out by that key already.
    """
    key = F.struct(F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    taken = mix(docs).groupBy(F.struct("doc_id", "source", "size").alias("_mix_key")).agg(
        F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_rows")
    )
    alike = Window.partitionBy("_mix_key").orderBy("text")
    more = F.row_number().over(alike) <= F.col("_mix_copies") % F.col("_mix_rows")
    times = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + more.cast("long")
    return (
        docs.withColumn("_mix_key", key)
        .join(taken, "_mix_key")
        .withColumn("_mix_times", times)
        .where("_mix_times > 0")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_mix_times")))
        .select(*docs.columns)
    )
