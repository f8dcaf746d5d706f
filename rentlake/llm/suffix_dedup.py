"""Remove bytes covered by long strings that start more than once in the corpus.

A start is a repeat if the LENGTH bytes from it on stand at another start too, in the same
text or another. All bytes of all repeats are removed; texts are judged as they came.

* Every start has an anchor: of the CORE-byte strings within its LENGTH bytes, the first
  one of the smallest hash. Equal strings have equal anchors, so only starts whose anchor
  string occurs again can be repeats. This is a count per anchor, of which there is one in
  about (LENGTH - CORE) / 2 bytes.
* The starts that share an anchor form a context, the bytes they cover. Contexts that
  occur again as a whole are settled: all their starts are repeats.
* The other contexts of an anchor, mostly where a repeated passage begins or ends, are
  brought together by anchor and compared byte by byte, in shards of about SHARD bytes: a
  suffix array gives the Burrows-Wheeler transform, and breadth-first backward extension
  of its intervals finds the borders between suffixes in order of their common prefixes,
  1 byte, 2 bytes and so on up to LENGTH. Suffixes with no border between them then share
  LENGTH bytes or more.
* An anchor with more than HOT different contexts is not brought into one shard. Its
  starts are counted by two hashes of their LENGTH bytes instead, spread over all tasks.

Edge cases: a null text is empty and keeps the digest of nothing; texts shorter than
LENGTH lose nothing; repeated rows are copies of each other; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlake.llm.bytesum import U, mix, powers, prefix_sums, text_bytes
from rentlake.llm.scratch import Scratch

LENGTH = 400
CORE = 200
SHARD = 1 << 21
HOT = 4000
PIECE = 1 << 20


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The first position of the smallest value in each stretch of `width` values."""
    least, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    return at


def contexts(data: np.ndarray, limits: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(text, lo, hi, anchor hash, context hash) of texts that follow each other in `data`.

    `lo` and `hi` are the first and the last start of the context, counted in `data`.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none.view(U), none.view(U)
    sums = prefix_sums(data)
    _, down = powers(len(data))
    with np.errstate(over="ignore"):
        hashes = mix((sums[core:] - sums[:-core]) * down[: len(data) - core + 1])
    anchor = window_minima(hashes, length - core + 1)
    start = np.arange(len(anchor))
    text = np.searchsorted(limits, start, "right") - 1
    valid = start + length <= limits[text + 1]
    start, anchor, text = start[valid], anchor[valid], text[valid]
    if not len(start):
        return none, none, none, none.view(U), none.view(U)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(start)])) - 1
    lo, hi, at = start[first], start[last], anchor[first]
    with np.errstate(over="ignore"):
        whole = (sums[hi + length] - sums[lo]) * down[lo]
        whole = mix(whole + mix((at - lo).astype(U) + ((hi - lo).astype(U) << U(32))))
    return text[first], lo, hi, hashes[at], whole


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, end text, first byte, end byte): runs of short texts, or parts of a long one."""
    low = 0
    while low < len(offsets) - 1:
        if offsets[low + 1] - offsets[low] > PIECE:
            for begin in range(int(offsets[low]), int(offsets[low + 1]) - length + 1, PIECE):
                yield low, low + 1, begin, min(begin + PIECE + length - 1, int(offsets[low + 1]))
            low += 1
            continue
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, "right")) - 1)
        yield low, high, int(offsets[low]), int(offsets[high])
        low = high


def anchor_rows(length: int, core: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").cast(pa.int64()), batch.column("text_key")
            for low, high, begin, end in _pieces(offsets, length):
                limits = np.clip(offsets[low : high + 1], begin, end) - begin
                text, lo, hi, anchor, whole = contexts(data[begin:end], limits, length, core)
                shift = begin - offsets[low + text]
                at = pa.array(low + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(at),
                        keys.take(at),
                        pa.array(anchor.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(lo + shift),
                        pa.array(hi + shift),
                    ],
                    ["doc_id", "text_key", "anchor", "context", "lo", "hi"],
                )

    return rows


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first `depth` symbols, and the rank of each position by
    its first eight. Ranks of twice as many symbols come from pairs of ranks; only positions
    that are not alone yet are sorted again."""
    n = len(codes)
    packed = np.zeros(n, dtype=U)
    padded = np.concatenate([codes, np.zeros(8, dtype=codes.dtype)]).astype(U)
    for k in range(8):
        packed = (packed << U(8)) | padded[k : k + n]
    order = np.argsort(packed, kind="stable")
    new = np.concatenate(([True], packed[order][1:] != packed[order][:-1]))
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = begin
    eight, size = rank.copy(), 8
    while size < depth:
        after = np.concatenate([rank[size:], np.full(min(size, n), -1)])[:n]
        alone = np.concatenate((new[1:], [True])) & new
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        own = order[slots]
        group = begin[slots]
        resort = np.lexsort((after[own], group))
        own, group = own[resort], group[resort]
        order[slots] = own
        follow = after[own]
        split = np.concatenate(([True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])))
        new[slots] = split
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[own] = begin[slots]
        size *= 2
    return order, eight


def long_prefix_groups(codes: np.ndarray, length: int) -> np.ndarray:
    """For each position, the number of its group of positions with the same `length` symbols.

    Backward extension on the Burrows-Wheeler transform: the interval of a string and the
    symbols before its places give the intervals of all strings one symbol longer. When
    the right border of such an interval is met for the first time, the suffixes on its two
    sides share just what the string had before. Strings are taken in order of length, so
    borders are found in order of common prefix; one that is not found below `length` is
    none. Strings of eight symbols come from the packed order, the search goes on from there.
    """
    n = len(codes)
    order, eight = suffix_array(codes, length)
    before = codes[order - 1]
    by_symbol = np.argsort(before, kind="stable")
    step = np.empty(n, dtype=np.int64)
    step[by_symbol] = np.arange(n)
    sorted_eight = eight[order]
    border = np.ones(n + 1, dtype=bool)
    border[1:n] = sorted_eight[1:] != sorted_eight[:-1]
    left = np.flatnonzero(border[:n])
    right = np.flatnonzero(border[1:])
    for _ in range(8, length):
        if not len(left):
            break
        single = left == right
        lone = step[left[single]]
        lows, highs = [lone], [lone]
        a, b = left[~single], right[~single]
        if len(a):
            sizes = b - a + 1
            owner = np.repeat(np.arange(len(a)), sizes)
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + a[owner]
            key = owner * 512 + before[places]
            resort = np.argsort(key, kind="stable")
            key, places = key[resort], places[resort]
            first = np.concatenate(([True], key[1:] != key[:-1]))
            last = np.concatenate((first[1:], [True]))
            lows.append(step[places[first]])
            highs.append(step[places[last]])
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = ~border[high + 1]
        left, right = low[fresh], high[fresh]
        border[right + 1] = True
    group = np.empty(n, dtype=np.int64)
    group[order] = np.cumsum(border[:n])
    return group


def repeated_starts(parts: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """Of contexts and their numbers of starts: which starts are repeats, one flag each."""
    # UTF-8 has no byte 255, so the bytes move up by one and 0 ends each context.
    end = np.zeros(1, dtype=np.uint8)
    codes = np.concatenate([x for p in parts for x in (np.frombuffer(p, dtype=np.uint8) + np.uint8(1), end)])
    group = long_prefix_groups(codes, length)
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    own = np.concatenate([np.arange(b, b + s) for b, s in zip(begins, starts, strict=True)])
    counts = np.bincount(group[own], minlength=group.max() + 1)
    flags = counts[group[own]] > 1
    return np.split(flags, np.cumsum(starts)[:-1])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


RANGE = "doc_id long, text_key long, lo long, hi long"


def shard_rows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repeated starts of contexts that come sorted by anchor, a shard of whole anchors at a time."""

    def settled(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeated_starts([r[5] for r in rows], [r[4] - r[3] + 1 for r in rows], length)
        found = [(r[1], r[2], r[3] + a, r[3] + b) for r, f in zip(rows, flags, strict=True) for a, b in _runs(f)]
        columns = zip(*found, strict=True) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "text_key", "lo", "hi"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        names = ("anchor", "doc_id", "text_key", "lo", "hi", "part")
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if size > SHARD and row[0] != held[-1][0]:
                    yield settled(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield settled(held)

    return rows


def part_rows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of each wanted context of a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "doc_id", "text_key", "lo", "hi", "part"]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out = []
            for k, (doc_id, key, wanted) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "wanted")), strict=True)
            ):
                for w in wanted:
                    begin = int(offsets[k]) + w["lo"]
                    part = data[begin : int(offsets[k]) + w["hi"] + length].tobytes()
                    out.append((w["anchor"], doc_id, key, w["lo"], w["hi"], part))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return rows


def hashed_starts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(a, b, doc_id, text_key, lo): two hashes of the bytes of every start of hot contexts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, lo, part in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "lo", "part")), strict=True
            ):
                data = np.frombuffer(part, dtype=np.uint8)
                n = len(data) - length + 1
                _, down = powers(len(data))
                sums, other = prefix_sums(data), prefix_sums(data ^ np.uint8(0x55))
                with np.errstate(over="ignore"):
                    a, b = ((mix((s[length:] - s[:-length]) * down[:n])).view(np.int64) for s in (sums, other))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array([doc_id] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array(lo + np.arange(n))],
                    ["a", "b", "doc_id", "text_key", "lo"],
                )

    return rows


def kept_rows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts and the digest of what is left of each text without its ranges of repeated starts."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out = []
            for k, (doc_id, ranges) in enumerate(
                zip(batch.column("doc_id").to_pylist(), batch.column("ranges").to_pylist(), strict=True)
            ):
                text = data[offsets[k] : offsets[k + 1]]
                spans: list[list[int]] = []
                for r in sorted(ranges or [], key=lambda r: r["lo"]):
                    if spans and r["lo"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["hi"] + length)
                    else:
                        spans.append([r["lo"], r["hi"] + length])
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                removed = sum(b - a for a, b in spans)
                out.append((doc_id, len(text), removed, len(spans), digest.hexdigest(), spans))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return rows


def repeated_ranges(texts: DataFrame, scratch: Scratch, length: int, core: int) -> DataFrame:
    """(doc_id, text_key, lo, hi): ranges of repeated starts of texts (doc_id, text_key, text)."""
    schema = "doc_id long, text_key long, anchor long, context long, lo long, hi long"
    anchors = scratch.keep(texts.mapInArrow(anchor_rows(length, core), schema), "anchors")
    again = (
        anchors.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
        .where("n > 1")
        .select("anchor", (F.col("low") < F.col("high")).alias("several"))
    )
    # Written, so that the join has a shuffle on either side and splits anchors of very many texts.
    again = scratch.keep(again, "again")
    shared = scratch.keep(anchors.join(again, "anchor"), "shared")
    scratch.clear("anchors", "again")
    by_context = shared.groupBy("anchor", "context").agg(
        F.count("*").alias("n"),
        F.max("several").alias("several"),
        F.min(F.struct("doc_id", "text_key", "lo", "hi")).alias("at"),
    )
    by_context = scratch.keep(by_context, "by_context")
    settled = shared.join(by_context.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "doc_id", "text_key", "lo", "hi"
    )
    per_anchor = by_context.where("several").groupBy("anchor").agg((F.count("*") > HOT).alias("hot"))
    wanted = (
        by_context.where("several")
        .join(per_anchor, "anchor")
        .select("anchor", "hot", "at.*")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("anchor", "lo", "hi", "hot")).alias("wanted"))
    )
    wanted = scratch.keep(wanted, "wanted")

    def parts(hot: bool) -> DataFrame:
        some = wanted.withColumn("wanted", F.filter("wanted", lambda w: w["hot"] == hot)).where(F.size("wanted") > 0)
        joined = texts.join(some, (texts["doc_id"].eqNullSafe(some["doc_id"])) & (texts["text_key"] == some["text_key"]))
        return joined.select(texts["doc_id"], texts["text_key"], "text", "wanted").mapInArrow(
            part_rows(length), "anchor long, doc_id long, text_key long, lo long, hi long, part binary"
        )

    compared = (
        parts(hot=False).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(shard_rows(length), RANGE)
    )
    found = [settled, scratch.keep(compared, "compared")]
    if per_anchor.where("hot").limit(1).count():
        starts = scratch.keep(
            parts(hot=True).mapInArrow(hashed_starts(length), "a long, b long, doc_id long, text_key long, lo long"), "starts"
        )
        twice = starts.groupBy("a", "b").count().where("count > 1").select("a", "b")
        found.append(starts.join(twice, ["a", "b"]).select("doc_id", "text_key", "lo", F.col("lo").alias("hi")))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every


def deduplicate(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of `docs` (doc_id, text).

    `spans` are the removed runs as [start, end) in bytes.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    ranges = (
        repeated_ranges(texts, scratch, length, core)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    )
    ranges = scratch.keep(ranges, "ranges")
    scratch.clear("shared", "by_context", "compared", "wanted")
    same = texts["doc_id"].eqNullSafe(ranges["doc_id"]) & (texts["text_key"] == ranges["text_key"])
    return (
        texts.join(ranges, same, "left")
        .select(texts["doc_id"], "text", "ranges")
        .mapInArrow(
            kept_rows(length),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>",
        )
    )
