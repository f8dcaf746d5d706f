"""Remove repeated lines and parts of lines, keeping the earliest occurrence.

A unit is a line that is not blank, whatever its length, without the white space around
it. A line of several sentences has further units in it: at least WORDS words up to the
next word that ends a sentence, or to the end of the line; a rest of fewer words is no
unit of its own, but goes with its line. A unit is normalised (lower case, one space
between words) and hashed to 128 bits. Of all units of the corpus with one digest the
first by document id and position stays, the others are removed; each removed one keeps
its place in the original text. Of a removed line only the line is given, not the units
in it, so that no two removed units overlap.

Edge cases: a null text has no units; repeated rows are copies of each other, all but one
of which lose their units; null ids rank last; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlake.llm.scratch import Scratch

WORDS = 5
LINE = re.compile(r"[^\s](?:[^\n]*[^\s])?")
# WORDS words or more, lazily, so that the first sentence end after them ends the unit.
PART = re.compile(rf"(?:[^\s]+\s+){{{WORDS - 1},}}?[^\s]*[.!?](?=\s|\Z)|[^\s].*", re.DOTALL)
UNITS = "doc_id long, row long, line long, start long, end long, d1 long, d2 long"


def units(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, digest) of the lines of a text, each followed by the units in it."""
    for line in LINE.finditer(text):
        low, whole = line.start(), line[0]
        yield low, line.end(), _digest(whole)
        parts = list(PART.finditer(whole))
        for part in parts if len(parts) > 1 else ():
            if len(part[0].split()) >= WORDS:
                yield low + part.start(), low + part.end(), _digest(part[0])


def _digest(unit: str) -> int:
    return xxhash.xxh3_128_intdigest(" ".join(unit.split()).lower())


def unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of a batch; `line` is the start of the line that a unit is part of, null for a line."""
    names = ["doc_id", "row", "line", "start", "end", "d1", "d2"]
    for batch in batches:
        out: list[list[int | None]] = [[] for _ in names]
        for doc_id, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True):
            line, line_end = 0, 0
            for start, end, digest in units(text or ""):
                part = end <= line_end
                if not part:
                    line, line_end = start, end
                values = (doc_id, row, line if part else None, start, end, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)


def repeated_units(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, end, kept_doc_id, kept_start): every removed unit of `docs` (doc_id, text)
    and the occurrence that stays. `row` tells rows of one id apart."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    found = scratch.keep(texts.mapInArrow(unit_rows, UNITS), "units")
    digest = ["d1", "d2"]
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")
    first = (
        found.groupBy(*digest)
        .agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(*digest, F.col("first.doc_id").alias("kept_doc_id"), F.col("first.row").alias("kept_row"), F.col("first.start").alias("kept_start"))
    )
    # Written, so that the join has a shuffle on either side and splits units of very many texts.
    first = scratch.keep(first, "first")
    removed = (
        found.join(first, digest)
        .where((F.col("row") != F.col("kept_row")) | (F.col("start") != F.col("kept_start")))
        .select("doc_id", "row", "line", "start", "end", "kept_doc_id", "kept_start")
    )
    removed = scratch.keep(removed, "removed")
    scratch.clear("units", "first")
    lines = removed.where("line is null")
    parts = removed.where("line is not null").join(lines.select("row", F.col("start").alias("line")), ["row", "line"], "left_anti")
    return lines.drop("line").unionByName(parts.drop("line"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with repeated units cut out of the text, for tables with unique ids."""
    cuts = repeated_units(docs).groupBy(F.col("doc_id").alias("_cut_id")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts")
    )
    none = F.array().cast(cuts.schema["_cuts"].dataType)
    joined = docs.join(cuts, F.col("doc_id") == F.col("_cut_id"), "left").withColumn("_cuts", F.coalesce("_cuts", none))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cuts", lambda c: c["end"]))
    starts = F.concat(F.transform("_cuts", lambda c: c["start"]), F.array(F.length("text").cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    whole = F.when(F.col("text").isNotNull(), F.array_join(kept, ""))
    return joined.withColumn("text", whole).select(*docs.columns)
