"""JSON arrays taken apart element by element: good ones become rows, bad ones are kept with the reason.

A file is one text. Where it is sound JSON, Spark splits the array itself; only the text of
a broken file is cut into elements by `broken_elements`, a small function on one text. Each
element is then parsed on its own, so a bad one costs itself and no other.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlake.sources.files import CORRUPT

NOT_JSON = "not valid JSON"
NOT_OBJECT = "not an object"
CUT_OFF = "cut off"
WRONG_TYPE = "wrong type: "

_BLANK = re.compile(r"\s*")
_STEP = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.DOTALL)
_AFTER = re.compile(r"\s*(?:,|\]|$)")
_NEXT = re.compile(r",\s*(?=\{)")
_DECODER = json.JSONDecoder()


def broken_elements(text: str, names: Collection[str]) -> list[tuple[str, str | None]]:
    """The elements of an array that is not sound JSON, each with its fault if it has one.

    An element ends where its own JSON ends. One with a fault ends before the next object
    after a comma that is sound and has a field of these names, or where its braces and
    brackets balance if that comes first, or with the text. So an open quote costs its own
    element only, and an object inside a faulty element is not taken for an element unless
    it has the names of one.
    """
    at = _BLANK.match(text).end()
    at += text[at : at + 1] == "["
    found = []
    while True:
        at = _BLANK.match(text, at).end()
        if at >= len(text) or (text[at] == "]" and not text[at + 1 :].strip()):
            return found
        end, fault = _element_end(text, at, names)
        found.append((text[at:end].rstrip(), fault))
        at = _BLANK.match(text, end).end()
        at += text[at : at + 1] == ","


def _sound_end(text: str, at: int) -> tuple[object, int] | None:
    """The value that begins here and where it ends, if it is sound and an array goes on or ends after it."""
    try:
        value, end = _DECODER.raw_decode(text, at)
    except (ValueError, RecursionError):
        return None
    return (value, end) if _AFTER.match(text, end) else None


def _element_end(text: str, at: int, names: Collection[str]) -> tuple[int, str | None]:
    sound = _sound_end(text, at)
    if sound:
        return sound[1], None
    balanced, depth = len(text) + 1, 0
    for step in _STEP.finditer(text, at):
        depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(step[0], 0)
        if depth <= 0 and step[0] in "}]":
            # A closing bracket without an opening one ends the array, not the element.
            end = step.end() if depth == 0 else step.start()
            if end > at and _AFTER.match(text, end):
                balanced = end
            break
    for comma in _NEXT.finditer(text, at):
        if comma.start() >= balanced:
            break
        follows = _sound_end(text, comma.end())
        if follows and isinstance(follows[0], dict) and not follows[0].keys().isdisjoint(names):
            return comma.start(), NOT_JSON
    if balanced <= len(text):
        return balanced, NOT_JSON
    return len(text), NOT_JSON if text[at] not in "{[" or text.rstrip().endswith("]") else CUT_OFF


ELEMENT = T.StructType([T.StructField("text", T.StringType()), T.StructField("fault", T.StringType())])


def _broken(names: Collection[str]):
    @F.pandas_udf(T.ArrayType(ELEMENT))
    def split(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: None if t is None else [{"text": e, "fault": f} for e, f in broken_elements(t, names)])

    return split


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(text, source_file): every file of a folder as one text."""
    return spark.read.option("wholetext", True).text(path).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("source_file"))


def elements(files: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Every element of every file: the columns of `files` but `text`, `position`, `row`, `reason`, `element`.

    `files` has a column `text` and may be a stream. `row` holds the element's columns and
    `reason` is NULL where it is good; a bad one has the reason and its own text instead.
    An element is bad if it is not JSON, not an object, or has a value of the wrong type; a
    missing field is NULL as it is in a plain read. Positions count from 0 in each file. An
    empty file, or one that holds an empty array, has no elements; a file with a single
    object has one.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = [c for c in files.columns if c != "text"]
    # A variant keeps every digit of a number, which a cast of the array to texts would not.
    array = F.when(F.trim(F.col("text")).startswith("["), F.try_parse_json("text")).cast("array<variant>")
    sound = F.transform(array, lambda e: F.struct(F.to_json(e).alias("text"), F.lit(None).cast("string").alias("fault")))
    # The function sees the texts of broken files only.
    split = files.withColumn("_sound", sound).withColumn("_broken", _broken(fields.names)(F.when(F.col("_sound").isNull(), F.col("text"))))
    each = split.select(*kept, F.posexplode(F.coalesce("_sound", "_broken")).alias("position", "_element"))
    element = F.col("_element.text")
    as_text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in fields), T.StructField(CORRUPT, T.StringType())])
    each = each.withColumns(
        {"_row": F.from_json(element, fields), "_texts": F.from_json(element, as_text, {"columnNameOfCorruptRecord": CORRUPT})}
    )
    wrong = F.array_compact(
        F.array(*[F.when(F.col(f"_texts.`{f.name}`").isNotNull() & F.col(f"_row.`{f.name}`").isNull(), F.lit(f.name)) for f in fields])
    )
    reason = (
        F.when(F.col("_element.fault").isNotNull(), F.col("_element.fault"))
        .when(~element.startswith("{") & F.try_parse_json(element).isNotNull(), NOT_OBJECT)
        .when(F.col(f"_texts.{CORRUPT}").isNotNull() | ~element.startswith("{"), NOT_JSON)
        .when(F.size(wrong) > 0, F.concat(F.lit(WRONG_TYPE), F.array_join(wrong, ", ")))
    )
    judged = each.withColumn("reason", reason)
    return judged.select(
        *kept,
        F.col("position").cast("long").alias("position"),
        F.when(F.col("reason").isNull(), F.col("_row")).alias("row"),
        "reason",
        F.when(F.col("reason").isNotNull(), element).alias("element"),
    )


def good_rows(found: DataFrame) -> DataFrame:
    """The good elements as rows, with where they come from."""
    kept = [c for c in found.columns if c not in ("row", "reason", "element")]
    return found.where("reason IS NULL").select("row.*", *kept)


def rejects(found: DataFrame) -> DataFrame:
    """The bad elements with position, reason and text."""
    return found.where("reason IS NOT NULL").drop("row")
