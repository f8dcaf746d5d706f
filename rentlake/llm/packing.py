"""Pack documents into token sequences along a Hilbert curve.

A document is its token ids and a closing id. Its hashed vector, counts of its ids in
VECTOR buckets, is projected to three dimensions by a fixed random matrix; the cell it
falls in has a number on a Hilbert curve, so that like documents lie near each other in
the order of that number. Documents follow each other in that order as one long row of
ids, which is cut every LENGTH ids: all sequences are full but the last one, which is cut
into powers of two and so needs no padding either.

The order is made on narrow rows: range-sorted, summed up within each range, and shifted
by the totals of the ranges before, of which there is one number a range. The ids
themselves are written once and shuffled once, to meet their offsets.

Edge cases: a null or empty text has only the closing id; an empty table gives no rows;
documents alike are ordered by id, then by their running number, so a group of copies of
any size is spread over ranges; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.llm.scratch import Scratch

LENGTH = 2048
CLOSING = 1
VECTOR = 256
DIMENSIONS = 3
BITS = 12
WORDS = 700_000  # distinct words a worker remembers before it starts anew
ROWS = 500


@cache
def _tokenizer(path: str) -> tuple:
    """The vocabulary, once for a worker, with the normalizer and splitter of whole texts, and those
    for words that are in lower case and whole already, which split at spaces alone."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    plain = normalizers.Sequence([]), pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer, (tokenizer.normalizer, tokenizer.pre_tokenizer), plain


# One word a line: plain letters and the signs after them, which the vocabulary splits just so, and what else there is.
PLAIN = re.compile(r"^([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,!?;:#$%&*|<>]*)(.*)$", re.MULTILINE)
BREAK = "\x01"  # a sign with an id of its own that nothing merges with
WORD_END = "</w>"  # how a vocabulary of words marks the last id of one
TOGETHER = 2000  # parts that are encoded in one call


class Numbers(dict):
    """Numbers for words in the order in which they are first asked for; `new` has the latest."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of texts, word by word: the vocabulary's merges never cross a space or line end.

    Each distinct word is encoded once. Words of letters are lower-cased, as the vocabulary
    does, and parted from the signs that follow, so that fewer of them are distinct.
    """

    def __init__(self, path: str):
        self.tokenizer, self.whole, self.plain = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        # Numbers of words; of each word the numbers of its two parts; of each part its ids.
        self.number = Numbers()
        self.parts: dict[str, int] = {"": 0}
        self.pairs = np.zeros((0, 2), dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint16)
        self.start = np.zeros(1, dtype=np.int64)
        self.length = np.zeros(1, dtype=np.int64)

    def ids_of(self, text: str, plain: bool = False) -> np.ndarray:
        # The fast form works out no offsets.
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.plain if plain else self.whole
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint16)

    def learn_plain(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and lengths of parts that are one word to the vocabulary, whose last id says that a word ends."""
        found, lengths = [], []
        for low in range(0, len(parts), TOGETHER):
            some = parts[low : low + TOGETHER]
            ids = self.ids_of(" ".join(some), plain=True)
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) != len(some):
                raise ValueError("the vocabulary parts words of letters or of signs")
            found.append(ids)
            lengths.append(np.diff(ends, prepend=-1))
        return found, lengths

    def learn_odd(self, words: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
        """Other words in the order in which they are encoded: many in one call with a break after
        each, those that hold the break or a special sign alone."""
        mark = self.ids_of(BREAK)[0]
        alone = [w for w in words if BREAK in w or "<|" in w]
        rest = list(set(words).difference(alone)) if alone else words
        found, lengths = [], []
        for low in range(0, len(rest), TOGETHER):
            ids = self.ids_of(f" {BREAK} ".join([*rest[low : low + TOGETHER], ""]))
            ends = np.flatnonzero(ids == mark)
            found.append(ids[ids != mark])
            lengths.append(np.diff(ends, prepend=-1) - 1)
        for word in alone:
            found.append(self.ids_of(word))
            lengths.append(np.array([len(found[-1])]))
        return [*rest, *alone], found, lengths

    def learn(self, words: list[str]) -> None:
        found = PLAIN.findall("\n".join(words))
        pairs = [(a.lower(), b) if a and not rest else (word, "") for word, (a, b, rest) in zip(words, found, strict=True)]
        odd = [word for word, (a, _, rest) in zip(words, found, strict=True) if (rest or not a) and word not in self.parts]
        flat = list(chain.from_iterable(pairs))
        plain = list(set(flat).difference(self.parts, odd))
        ids, lengths = self.learn_plain(plain)
        odd, more_ids, more_lengths = self.learn_odd(odd)
        self.parts.update(zip([*plain, *odd], range(len(self.parts), len(self.parts) + len(plain) + len(odd)), strict=True))
        self.flat = np.concatenate([self.flat, *ids, *more_ids])
        self.length = np.concatenate([self.length, *lengths, *more_lengths])
        self.start = np.cumsum(self.length) - self.length
        numbers = np.fromiter(map(self.parts.__getitem__, flat), dtype=np.int64, count=len(flat))
        self.pairs = np.concatenate([self.pairs, numbers.reshape(-1, 2)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with its closing id, and where each text begins."""
        if len(self.number) > WORDS:
            self.forget()
        lists = [(t or "").replace("\n", " ").split(" ") for t in texts]
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(lists)), dtype=np.int64)
        if self.number.new:
            self.learn(self.number.new)
            self.number.new = []
        parts = self.pairs[words].ravel()
        length = self.length[parts]
        ends = np.cumsum(length)
        source = np.repeat(self.start[parts] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        last_part = 2 * np.cumsum([len(ws) for ws in lists]) - 1
        stops = ends[last_part]
        ids = np.insert(self.flat[source], stops, np.uint16(CLOSING))
        return ids, np.concatenate(([0], stops + np.arange(1, len(texts) + 1)))


@cache
def _projection() -> np.ndarray:
    return np.random.default_rng(7).normal(size=(VECTOR, DIMENSIONS))


def curve_keys(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The Hilbert number of each document's projected vector."""
    n = len(begins) - 1
    owner = np.repeat(np.arange(n), np.diff(begins))
    bucket = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % VECTOR
    counts = np.bincount(owner * VECTOR + bucket, minlength=n * VECTOR).reshape(n, VECTOR)
    vectors = np.log1p(counts)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    cells = (np.arctan(2 * (vectors @ _projection())) / np.pi + 0.5) * (1 << BITS)
    return hilbert(np.clip(cells.astype(np.int64), 0, (1 << BITS) - 1))


def hilbert(cells: np.ndarray) -> np.ndarray:
    """Numbers along the Hilbert curve of cells (rows, dimensions), after Skilling's transpose form."""
    x = cells.T.copy()
    bit = 1 << (BITS - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            high = (x[i] & bit) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (BITS - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) > 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(BITS - 1, -1, -1):
        for i in range(len(x)):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker, which goes on with the words of its earlier tasks."""
    return Encoder(path)


def tokens(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                ids, begins = own.encode(part.column("text").to_pylist())
                parts = [ids[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(np.diff(begins)),
                        pa.array(curve_keys(ids, begins)),
                        pa.array(parts, pa.binary()),
                    ],
                    ["doc_id", "doc_tokens", "curve", "ids"],
                )

    return encoded


def piece_bounds(first: int, length: int, total: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a document that begins at `first` of `total` ids."""
    whole = total // LENGTH
    pieces, at = [], first
    while at < first + length:
        sequence, begin, size = at // LENGTH, at // LENGTH * LENGTH, LENGTH
        if sequence == whole:  # what does not fill a sequence goes into powers of two
            rest = total - begin
            while True:
                size = 1 << (rest.bit_length() - 1)
                if at < begin + size:
                    break
                begin, rest, sequence = begin + size, rest - size, sequence + 1
        stop = min(first + length, begin + size)
        pieces.append((at - first, stop - at, sequence, at - begin))
        at = stop
    return pieces


def pieces(total: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c) for c in ("doc_id", "first", "doc_tokens"))
            for k, (doc_id, first, length) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
                ids = np.frombuffer(batch.column("ids")[k].as_buffer(), dtype=np.uint16).astype("<u4")
                for start, size, sequence, offset in piece_bounds(first, length, total):
                    crc = zlib.crc32(ids[start : start + size].tobytes())
                    rows.append((doc_id, start, size, crc, length, sequence, offset))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names))], names
            )

    return cut


def _offsets(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(row, first): where each document begins along the curve, and the number of all ids."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = scratch.keep(
        docs.select("row", "doc_id", "doc_tokens", "curve")
        .repartitionByRange(ranges, "curve", "doc_id", "row")
        .withColumn("range", F.spark_partition_id()),
        "ordered",
    )
    sums = {r["range"]: r["n"] for r in ordered.groupBy("range").agg(F.sum("doc_tokens").alias("n")).collect()}
    before, total = [], 0
    for k in sorted(sums):
        before.append((k, total))
        total += sums[k]
    shifts = spark.createDataFrame(before, "range int, shift long")  # one row a range
    along = Window.partitionBy("range").orderBy("curve", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("doc_tokens").over(along), F.lit(0)) + F.col("shift")
    return ordered.join(F.broadcast(shifts), "range").select("row", first.alias("first")), total


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of every row of `docs` (doc_id, text): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset. `tokenizer` is the path of a word-wise vocabulary file."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = scratch.keep(
        texts.mapInArrow(tokens(tokenizer), "doc_id long, doc_tokens long, curve long, ids binary").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "ids",
    )
    offsets, total = _offsets(kept, scratch)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return kept.drop("curve").join(offsets, "row").mapInArrow(pieces(total), schema)
