"""Fill-in-the-middle: cut a text into prefix, middle and suffix between units, and reorder them.

One full match of `(unit)*` by the `regex` library keeps every repetition of its group, so
`ends(1)` is the list of unit ends: its length is the number of units, and the two cuts are
looked up in it. Only the three numbers leave Python; the text is put together in the JVM.

A cut stands after as many units as a hash of seed and id says, modulo one more than there
are units, so a rerun cuts alike. Prefix, suffix and middle follow their markers: in the
order prefix, suffix, middle (psm) or suffix, prefix, middle (spm). `restored` rebuilds the
text from output and form alone.

Edge cases: a null text is empty; an empty text, one that holds a marker, and one that the
rate leaves out stay plain, with null lengths of prefix and middle; parts may be empty; a
null id hashes as the empty string; copies under different ids are cut differently, repeated
rows alike; an empty table gives no rows. The columns of `docs` are kept; those that share a
name with a result give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"[^\n]*\n|[^\n]+"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Rules:
    """What a unit is, the markers, the seed, and the percentages of texts cut and of spm among them."""

    unit: str = LINE
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 7
    rate: int = 100
    spm_rate: int = 50

    def __post_init__(self):
        marks = self.markers
        # Markers that overlap, or hold each other, could be found where none was put.
        for a in marks:
            for b in marks:
                if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"markers {a!r} and {b!r} overlap")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _cuts(unit: str):
    """A function of (text, h1, h2): number of units, ends of prefix and middle in code points."""

    @F.arrow_udf("struct<n: long, first: long, second: long>")
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        units = regex.compile(f"({unit})*")
        for text, h1, h2 in batches:
            rows = []
            for t, a, b in zip(text, h1.to_pylist(), h2.to_pylist(), strict=True):
                match = units.fullmatch(t.as_py())
                if match is None:
                    raise ValueError(f"units {unit!r} do not cover a text")
                ends = match.ends(1)
                low, high = sorted((a % (len(ends) + 1), b % (len(ends) + 1)))
                rows.append((len(ends), ends[low - 1] if low else 0, ends[high - 1] if high else 0))
            n, first, second = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (n, first, second)], ["n", "first", "second"])

    return cuts


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from a hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`docs` (doc_id, text, ...) with n, form, prefix_chars, middle_chars and output."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), rules.seed)
    holds_marker = F.contains(text, F.lit(rules.prefix)) | F.contains(text, F.lit(rules.suffix)) | F.contains(text, F.lit(rules.middle))
    form = (
        F.when((text == "") | holds_marker | (h3 % 100 >= rules.rate), "plain")
        .when(h4 % 100 < rules.spm_rate, "spm")
        .otherwise("psm")
    )
    first, second = F.col("_cut.first"), F.col("_cut.second")
    part = {
        "P": F.concat(F.lit(rules.prefix), F.substring(text, F.lit(1), first.cast("int"))),
        "M": F.concat(F.lit(rules.middle), F.substring(text, (first + 1).cast("int"), (second - first).cast("int"))),
        "S": F.concat(F.lit(rules.suffix), F.substring(text, (second + 1).cast("int"), F.length(text))),
    }
    cut = F.col("form") != "plain"
    return docs.withColumns({"_cut": _cuts(rules.unit)(text, h1, h2), "form": form}).withColumns(
        {
            "n": F.col("_cut.n"),
            "prefix_chars": F.when(cut, first),
            "middle_chars": F.when(cut, second - first),
            "output": F.when(F.col("form") == "psm", F.concat(part["P"], part["S"], part["M"]))
            .when(F.col("form") == "spm", F.concat(part["S"], part["P"], part["M"]))
            .otherwise(text),
        }
    ).drop("_cut")


def restored(output: Column, form: Column, rules: Rules = Rules()) -> Column:
    """The text that `output` was made of."""

    def after(value: Column, marker: str) -> Column:
        return F.substring(value, F.instr(value, marker) + len(marker), F.length(value))

    def before(value: Column, marker: str) -> Column:
        return F.substring_index(value, marker, 1)

    middle = after(output, rules.middle)
    prefix = {
        "psm": before(after(output, rules.prefix), rules.suffix),
        "spm": before(after(output, rules.prefix), rules.middle),
    }
    suffix = {
        "psm": before(after(output, rules.suffix), rules.middle),
        "spm": before(after(output, rules.suffix), rules.prefix),
    }
    whole = {f: F.concat(prefix[f], middle, suffix[f]) for f in prefix}
    return F.when(form == "psm", whole["psm"]).when(form == "spm", whole["spm"]).otherwise(output)


def digests(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The cuts of every document, with digests of the output and of the text rebuilt from it."""
    cut = fill_in_middle(docs.select("doc_id", "text"), rules)
    return cut.select(
        "doc_id",
        *RESULTS[:-1],
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), rules).cast("binary"), 256).alias("restored_sha256"),
    )
