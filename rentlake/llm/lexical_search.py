"""Ranked lexical search with hashed max-sketches: upper bounds first, exact scores until they decide.

The impact of a term on a document grows with its occurrences there, the document being
given. A document's sketch folds its terms into two rows of hashed cells, each holding the
most occurrences of any term that falls there; the smaller of a term's two cells is never
below its true occurrences. Looked up for a whole block of items at once, the cells give an
upper bound of every item's score for every document without reading a text.

The texts with the highest bounds are scored exactly, which sets a threshold for each item:
its k-th best exact score so far. As long as many more texts have a bound at or above it, the
next ones in descending order of bounds are scored, eight times as many in each round; then
all that are left at or above the threshold are. What stays below cannot be among the k best.

Items are taken in blocks of BLOCK pairs of item and term, so that what is broadcast has a
bound (an item with more terms is a block of its own size). Document frequencies are summed
per task before the shuffle. Texts are looked up by their hash: copies are found once and
ranked row by row, and texts that share a hash are merely scored more often.

Edge cases: null and empty texts have no terms and are never ranked; without documents or
items there are no rows; an item without terms found anywhere has none; rows that share an
item_id are one item, with the terms of all; repeated documents are ranked each, those of
equal score by doc_id (nulls last); long texts are taken apart in segments; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.llm.scratch import Scratch

SPREAD = 4  # cells in a row for each distinct term
MOST = 255  # a cell with this value stands for as many occurrences or more
BLOCK = 20_000  # pairs of item and term that are looked up at once
FIRST = 4  # texts that an item scores in its first round, as a multiple of k
GROWTH = 8
TOGETHER = 128  # documents whose bounds are worked out at once
FLUSH = 500_000  # terms that a task counts before it gives their number
SEGMENT = 1 << 22

# Bytes of terms, A-Z lowered, and a space for all others; bytes from 80 up are parts of characters.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a text of UTF-8 bytes."""
    found, low = Counter(), 0
    while low < len(text):
        high = min(len(text), low + SEGMENT)
        while high < len(text) and _TERM[text[high]] != 32:
            high += 1
        found.update(text[low:high].translate(_TERM).split(b" "))
        low = high
    found.pop(b"", None)
    return found


def cells(hashes: np.ndarray, width: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """A term's cell in the first and in the second row, counted from the start of the first."""
    second = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    mask = np.asarray(width, dtype=np.uint64) - np.uint64(1)
    return (hashes & mask).astype(np.int64), ((second & mask) + mask + np.uint64(1)).astype(np.int64)


def sketches(counts: list[Counter]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all documents one after the other, and where each document's begin."""
    distinct = np.array([len(c) for c in counts], dtype=np.int64)
    width = np.array([1 << max(4, int(SPREAD * n - 1).bit_length()) for n in distinct], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(2 * width)))
    hashes = np.fromiter((crc32(t) for c in counts for t in c), dtype=np.uint64, count=int(distinct.sum()))
    often = np.fromiter((n for c in counts for n in c.values()), dtype=np.int64, count=int(distinct.sum()))
    one, two = cells(hashes, np.repeat(width, distinct))
    owner = np.repeat(begins[:-1], distinct)
    flat = np.zeros(int(begins[-1]), dtype=np.uint8)
    often = np.minimum(often, MOST).astype(np.uint8)
    np.maximum.at(flat, owner + one, often)
    np.maximum.at(flat, owner + two, often)
    return flat, begins


SKETCHED = "text_key long, n long, sketch binary, term binary, holders long"


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and rows with the number of documents that hold a term."""
    names = ["text_key", "n", "sketch", "term", "holders"]
    holders: Counter = Counter()

    def held() -> pa.RecordBatch:
        none = pa.nulls(len(holders), pa.int64())
        columns = [none, none, pa.nulls(len(holders), pa.binary()), pa.array(list(holders), pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(holders.values()), pa.int64())], names)

    for batch in batches:
        for low in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(low, TOGETHER)
            counts = [term_counts(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            for c in counts:
                holders.update(c.keys())
            flat, begins = sketches(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("text_key"),
                    pa.array([sum(c.values()) for c in counts], pa.int64()),
                    pa.array([flat[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)], pa.binary()),
                    pa.nulls(len(counts), pa.binary()),
                    pa.nulls(len(counts), pa.int64()),
                ],
                names,
            )
            if len(holders) > FLUSH:
                yield held()
                holders.clear()
    yield held()


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        pairs = [(i, t) for i, text in zip(ids, batch.column("text").cast(pa.binary()).to_pylist(), strict=True) for t in term_counts(text)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())], ["item_id", "term"]
        )


@dataclass(frozen=True)
class Corpus:
    """Documents with at least one term, and all their terms."""

    documents: int
    terms: int

    def damping(self, n: int) -> int:
        return 8 * (10 + 90 * n * self.documents // self.terms)


def impact(often, damping):
    return (1_000_000_000 * often) // (1000 * often + damping)


class Block:
    """Some items with the weights of their terms."""

    def __init__(self, rows: list[tuple[int | None, bytes, int]]):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.items = list(dict.fromkeys(i for i, _, _ in rows))
        number = {i: k for k, i in enumerate(self.items)}
        self.weights: list[dict[bytes, int]] = [{} for _ in self.items]
        for i, term, w in rows:
            self.weights[number[i]][term] = w
        vocabulary = {t: k for k, t in enumerate(dict.fromkeys(t for _, t, _ in rows))}
        self.hashes = np.array([crc32(t) for t in vocabulary], dtype=np.uint64)
        self.term = np.array([vocabulary[t] for ws in self.weights for t in ws])
        self.weight = np.array([float(w) for ws in self.weights for w in ws.values()])
        self.starts = np.cumsum([0, *(len(ws) for ws in self.weights)])[:-1]

    def bounds(self, batch: pa.RecordBatch, corpus: Corpus) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text keys, bounds by document and item) for parts of a batch of sketches."""
        keys = batch.column("text_key").to_numpy()
        rows = [np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in batch.column("sketch")]
        damping = np.array([corpus.damping(n) for n in batch.column("n").to_pylist()], dtype=np.int64)
        lengths = np.array([len(r) for r in rows])
        for length in np.unique(lengths):
            one, two = cells(self.hashes, length // 2)
            same = np.flatnonzero(lengths == length)
            for low in range(0, len(same), TOGETHER):
                at = same[low : low + TOGETHER]
                sketch = np.stack([rows[k] for k in at])
                often = np.minimum(sketch[:, one], sketch[:, two])
                row, column = np.nonzero(often)
                most = often[row, column].astype(np.int64)
                found = np.zeros(often.shape)
                found[row, column] = np.where(most == MOST, 1_000_000, impact(most, damping[at[row]]))
                # Weights below 2**15 and impacts of at most 10**6: sums stay exact.
                yield keys[at], np.add.reduceat(found[:, self.term] * self.weight, self.starts, axis=1)

    def highest(self, corpus: Corpus, most: int) -> Callable:
        """(item, text_key, bound) of each task's texts of highest bounds."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = np.zeros((len(self.items), 0))
            who = np.zeros((len(self.items), 0), dtype=np.int64)
            for batch in batches:
                for keys, bounds in self.bounds(batch, corpus):
                    best = np.concatenate([best, bounds.T], axis=1)
                    who = np.concatenate([who, np.broadcast_to(keys, (len(self.items), len(keys)))], axis=1)
                    if best.shape[1] > most:
                        keep = np.argpartition(best, -most, axis=1)[:, -most:]
                        best, who = np.take_along_axis(best, keep, 1), np.take_along_axis(who, keep, 1)
            item, at = np.nonzero(best)
            columns = [pa.array(item.astype(np.int32)), pa.array(who[item, at]), pa.array(best[item, at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "text_key", "bound"])

        return rows

    def open_pairs(self, corpus: Corpus, threshold: np.ndarray, count_only: bool) -> Callable:
        """(item, text_key) of all bounds at or above the item's threshold, or their number by task."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = 0
            for batch in batches:
                for keys, bounds in self.bounds(batch, corpus):
                    at, item = np.nonzero(bounds >= threshold)
                    number += len(at)
                    if not count_only:
                        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(keys[at])], ["item", "text_key"])
            if count_only:
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], ["number"])

        return rows

    def scores(self, corpus: Corpus) -> Callable:
        """(item, doc_id, score) of texts and the items that ask for them."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                columns = (batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist())
                for doc_id, text, items in zip(*columns, strict=True):
                    counts = term_counts(text.as_py().encode())
                    damping = corpus.damping(sum(counts.values()))
                    for k in items:
                        score = sum(w * impact(counts[t], damping) for t, w in self.weights[k].items() if t in counts)
                        if score > 0:
                            found.append((k, doc_id, score))
                item, doc, score = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"]
                )

        return rows


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _exact(texts: DataFrame, pairs: DataFrame, block: Block, corpus: Corpus, scratch: Scratch, name: str) -> DataFrame:
    # A text is taken apart once, whatever the number of items that ask for it. Written, so that
    # the join has a shuffle of its own and splits a text of very many copies.
    asked = scratch.keep(pairs.groupBy("text_key").agg(F.collect_set("item").alias("items")), name)
    return texts.join(asked, "text_key").select("doc_id", "text", "items").mapInArrow(
        block.scores(corpus), "item int, doc_id long, score long"
    )


def _rank_block(texts: DataFrame, sketched: DataFrame, block: Block, corpus: Corpus, k: int, scratch: Scratch, name: str) -> DataFrame:
    items, most = len(block.items), FIRST * k
    while True:
        order = Window.partitionBy("item").orderBy(F.desc("bound"), "text_key")
        highest = (
            sketched.mapInArrow(block.highest(corpus, most), "item int, text_key long, bound long")
            .distinct()
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= most)
        )
        tried = _exact(texts, highest.select("item", "text_key"), block, corpus, scratch, f"{name}_highest")
        first = scratch.keep(tried, f"{name}_first")
        # At most k rows for an item; the threshold is the score of the last of them, if there are k.
        best: dict[int, list[int]] = {}
        for r in _best(first, k).select("item", "score").collect():
            best.setdefault(r["item"], []).append(r["score"])
        threshold = np.array([min(best[i]) if len(best.get(i, ())) == k else 1 for i in range(items)], dtype=float)
        number = sketched.mapInArrow(block.open_pairs(corpus, threshold, True), "number long").agg(F.sum("number")).first()[0] or 0
        if number <= GROWTH * most * items:
            break
        most *= GROWTH
    pairs = sketched.mapInArrow(block.open_pairs(corpus, threshold, False), "item int, text_key long").distinct()
    # All at or above the threshold, those of the rounds before included: the k best are among them.
    scored = _exact(texts, pairs, block, corpus, scratch, f"{name}_pairs")
    return scratch.keep(_best(scored, k), f"{name}_best")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of `docs` (doc_id, text) for each of `items` (item_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    table = scratch.keep(texts.select("text_key", "text").mapInArrow(_sketch_rows, SKETCHED), "sketches")
    sketched = table.where("n > 0").select("text_key", "n", "sketch")
    size = sketched.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    corpus = Corpus(size["documents"], size["terms"] or 0)

    holders = table.where("term is not null").groupBy("term").agg(F.sum("holders").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * corpus.documents + 2) / (2.0 * F.col("df") + 1)))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    weights = scratch.keep(
        asked.mapInArrow(_item_rows, "item_id long, term binary")
        .distinct()
        .join(holders, "term")
        .select("item_id", "term", weight.cast("long").alias("w"))
        .where("w > 0"),
        "weights",
    )
    blocks = -(-weights.count() // BLOCK)
    found = []
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b
        rows = [(r["item_id"], bytes(r["term"]), r["w"]) for r in weights.where(mine).collect()]  # about BLOCK rows
        if rows:
            block = Block(rows)
            names = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id long")
            best = _rank_block(texts, sketched, block, corpus, k, scratch, f"block_{b}")
            found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    while len(found) > 1:  # a shallow tree of unions
        found = [a[0] if len(a) == 1 else a[0].unionByName(a[1]) for a in (found[i : i + 2] for i in range(0, len(found), 2))]
    return found[0]
