"""Similarity join of documents on their word shingles: a size-aware heavy-light join.

A document's set holds the hashes of its distinct word shingles (A-Z lowered; a text of
fewer words than a shingle has is one shingle; a text without words, or a null, is empty
and links with nothing). Two documents link when their Jaccard similarity reaches a
threshold. A `Measure` says how many words and which threshold: three words and 0.9 for
the query, five words and 0.8 for the stage of the pipeline.

* Equal sets are folded into one class first, so copies never meet in a list.
* Small (light) sets enumerate subsets: two sets link only if they share the subset that
  is their intersection, which leaves out at most a tenth of either (a fifth at 0.8). All subsets of that
  kind are keys, and sets in one key's list link or not by their sizes alone.
* Large (heavy) sets are found by scanning inverted lists. The lists are those of blocks
  of the hash range: sets that differ in at most d shingles agree in one of d + 1 blocks.
  Lists of single shingles would hold every document that quotes a common passage; a list
  of a block holds near copies only, so no list needs a cap. Blocks without a shingle bring
  together what has nothing in common, so a set leaves them out where more than d of its
  blocks have one: then one of these is the same in a linked set. The number of blocks is
  the least with which nearly every set of the class can do so.
* The boundary is the size at which enumerating starts to cost more than scanning, from
  the number of sets of each size. A pair across the boundary is found by the lists,
  which also hold the small sets close to it.

Candidates are verified on the shingles themselves, after short sketches of them have ruled
out most that do not link. A first round links every list to its most central set; a second
one compares, block against block, only what is still in different components, so that a
group of near copies costs no row for each of its pairs. The number of links is counted
last: all links lie within components, whose sets are compared once, chunk against chunk,
each task giving one number for a set.

Edge cases: an empty table gives no rows; other columns are ignored; repeated rows are
one class and link with each other; rows sharing a doc_id are taken as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from itertools import combinations, count
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlake.llm.bytesum import U, mix, text_bytes, word_hashes
from rentlake.llm.components import connected_components
from rentlake.llm.scratch import Scratch

SUBSETS_MOST = 500  # sets with more subsets than this are never enumerated
SCAN_COST = 6.0  # rows that one entry of an inverted list costs: shuffled, joined, verified
CHUNK = 512  # members of one list that are compared in one step
SLICE = 4096  # shingles that are held against each other in one step


@dataclass(frozen=True)
class Measure:
    """Words of a shingle, the similarity of a link, and what follows from them.

    `class_links` is the width of a size class in steps of the largest ratio of two linked sizes.
    """

    words: int
    tenths: int  # a link needs intersection / union of so many tenths
    class_links: int = 3

    @cached_property
    def least(self) -> int:
        """The size of the smallest set that links with a different one."""
        return -(-self.tenths // (10 - self.tenths))

    @cached_property
    def light_most(self) -> int:
        """Sizes up to here may be enumerated; the boundary lies at or below it."""
        return next(n for n in count(self.least) if self.subsets(n + 1) > SUBSETS_MOST)

    @cached_property
    def bounds(self) -> np.ndarray:
        """The smallest size of each class."""
        ratio = (10 / self.tenths) ** self.class_links
        return np.unique(np.ceil(ratio ** np.arange(0, int(41 / np.log(ratio)))).astype(np.int64))

    def subsets(self, n: int) -> int:
        return sum(comb(n, k) for k in range((10 - self.tenths) * n // 10 + 1))

    def class_of(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def differing_in(self, n: int, c: int) -> int:
        """A bound on the shingles in which a set of `n` differs from one of class `c` that it links with."""
        return differing(n + min(n * 10 // self.tenths, int(self.bounds[c + 1]) - 1), self)

    @cached_property
    def _blocks(self) -> dict[int, int]:
        return {}

    def blocks(self, c: int) -> int:
        """The least number of blocks with which nearly every set of class `c` has a shingle in
        more of them than it can differ in.

        Shingles fall into blocks at random; three standard deviations are left.
        """
        if c not in self._blocks:
            high = int(self.bounds[c + 1])
            sizes = np.unique(np.linspace(max(self.least, self.tenths * int(self.bounds[c]) // 10), high - 1, 20).astype(np.int64))
            needed = np.array([self.differing_in(int(n), c) + 1 for n in sizes])
            found = differing(2 * (high - 1), self) + 1
            while True:
                empty = np.exp(-sizes / found)
                filled = found * (1 - empty)
                spread = np.sqrt(np.maximum(found * empty * (1 - (1 + sizes / found) * empty), 0))
                if (filled - 3 * spread >= needed).all() or found >= high:
                    break
                found += 1
            self._blocks[c] = found
        return self._blocks[c]


PAIRS = Measure(words=3, tenths=9)
NEAR_COPIES = Measure(words=5, tenths=8, class_links=2)

SETS = "doc_id long, n_shingles long, c1 long, c2 long, light array<long>, heavy array<long>"


def shingles(data: np.ndarray, offsets: np.ndarray, measure: Measure = PAIRS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words, first = word_hashes(data, offsets)
    width = measure.words
    runs = _run_hash([words[k : len(words) - width + 1 + k] for k in range(width)]) if len(words) >= width else words[:0]
    return [
        _run_hash([words[k : k + 1] for k in range(a, b)]) if 0 < b - a < width else np.unique(runs[a : max(a, b - width + 1)])
        for a, b in zip(first[:-1], first[1:], strict=True)
    ]


def _run_hash(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of runs of words, from the hashes of their first words, of their second ones, and so on."""
    with np.errstate(over="ignore"):
        out = mix(words[-1] + U(len(words)))
        for each in reversed(words[:-1]):
            out = mix(each + out)
    return out


def size_classes(n: int, measure: Measure = PAIRS) -> range:
    """The classes whose lists a set of `n` shingles is in.

    A set is in its own class and in that of the largest set it can link with, so any two
    sets that link share a class.
    """
    return range(measure.class_of(n), measure.class_of(n * 10 // measure.tenths) + 1)


def differing(total: int, measure: Measure = PAIRS) -> int:
    """A bound on the shingles in which two linked sets differ whose sizes add up to `total` or less."""
    return (10 - measure.tenths) * total // (10 + measure.tenths)


def heavy_keys(found: np.ndarray, measure: Measure = PAIRS) -> np.ndarray:
    """Keys of the set's blocks: of those with a shingle if more than it can differ in have one, else of all."""
    keys = []
    for c in size_classes(len(found), measure):
        blocks = measure.blocks(c)
        block = ((found >> U(32)) * U(blocks)) >> U(32)
        edges = np.searchsorted(block, np.arange(blocks + 1, dtype=U))
        with np.errstate(over="ignore"):
            sums = np.concatenate(([U(0)], np.cumsum(mix(found), dtype=U)))
            every = mix(sums[edges[1:]] - sums[edges[:-1]] + mix(np.arange(blocks, dtype=U) + U(c << 32)))
        filled = edges[1:] > edges[:-1]
        keys.append(every[filled] if filled.sum() > measure.differing_in(len(found), c) else every)
    return np.concatenate(keys)


def light_keys(found: np.ndarray, measure: Measure = PAIRS) -> np.ndarray:
    """Keys of all subsets that a linked set can share; the low byte is the subset's size."""
    n = len(found)
    with np.errstate(over="ignore"):
        each = mix(found)
        total, keys = each.sum(dtype=U), []
        for left_out in range((10 - measure.tenths) * n // 10 + 1):
            gone = np.array([each[list(c)].sum(dtype=U) for c in combinations(range(n), left_out)], dtype=U)
            keys.append((mix(total - gone + U(n - left_out)) << U(8)) | U(n - left_out))
    return np.concatenate(keys)


def set_rows(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for low in range(0, batch.num_rows, 500):
            at = offsets[low : low + 501]
            sets = shingles(data[at[0] : at[-1]], at - at[0], measure)
            with np.errstate(over="ignore"):
                c1 = [int(s.sum(dtype=U)) for s in sets]
                c2 = [int(mix(s).sum(dtype=U)) for s in sets]
            small = [light_keys(s, measure) if measure.least <= len(s) <= measure.light_most else s[:0] for s in sets]
            large = [heavy_keys(s, measure) if len(s) >= measure.least else s[:0] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, len(sets)).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(c1, dtype=U).view(np.int64)),
                    pa.array(np.array(c2, dtype=U).view(np.int64)),
                    _lists(small),
                    _lists(large),
                ],
                ["doc_id", "n_shingles", "c1", "c2", "light", "heavy"],
            )


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=U)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def array_rows(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for low in range(0, batch.num_rows, 500):
            at = offsets[low : low + 501]
            sets = shingles(data[at[0] : at[-1]], at - at[0], measure)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, len(sets)).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([sketch(s, measure).tobytes() for s in sets], pa.binary()),
                ],
                ["node", "n", "shingles", "sketch"],
            )


def sketch(found: np.ndarray, measure: Measure = PAIRS) -> np.ndarray:
    """One parity bit for each residue of the hashes: two sketches differ in no more bits
    than the sets differ in shingles, and a longer one folds into a shorter one."""
    bits = max(256, 1 << (16 * differing(2 * len(found), measure)).bit_length())
    parity = np.bincount((found & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(U)


def fold(words: np.ndarray, length: int) -> np.ndarray:
    while len(words) > length:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def verified(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    """Of candidate pairs with their shingles, those that link."""
    for batch in batches:
        a, b = batch.column("a_shingles"), batch.column("b_shingles")
        good = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            x, y = np.frombuffer(a[i].as_buffer(), dtype=U), np.frombuffer(b[i].as_buffer(), dtype=U)
            at = np.searchsorted(x, y)
            at[at == len(x)] = 0
            same = int((x[at] == y).sum())
            good[i] = 10 * same >= measure.tenths * (len(x) + len(y) - same)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def most_apart(total: np.ndarray | int, measure: Measure) -> np.ndarray | int:
    """The shingles in which two linked sets of so many in total can differ."""
    return total - 2 * -(-measure.tenths * total // (10 + measure.tenths))


def possible(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    """Of candidate pairs with their sketches, those that these allow to link."""
    for batch in batches:
        a, b = batch.column("a_sketch"), batch.column("b_sketch")
        allowed = most_apart(batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy(), measure)
        good = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            x, y = np.frombuffer(a[i].as_buffer(), dtype=U), np.frombuffer(b[i].as_buffer(), dtype=U)
            length = min(len(x), len(y))
            good[i] = np.bitwise_count(fold(x, length) ^ fold(y, length)).sum() <= allowed[i]
        yield batch.select(["a", "b"]).filter(pa.array(good))


def close_pairs(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    """Pairs of different components whose sketches allow a link, from sorted groups.

    A group (key, i, j) holds at most two chunks of one list; those of chunk i meet those
    of chunk j. A pair is given once for a batch of groups.
    """
    for group in _groups(batches, ("key", "i", "j", "chunk", "node", "n", "component"), "sketch"):
        left = group["chunk"] == group["i"][0]
        right = group["chunk"] == group["j"][0]
        length = min(len(s) for s in group["sketch"])
        bits = np.stack([fold(s, length) for s in group["sketch"]])
        n, node, component = group["n"], group["node"], group["component"]
        r = np.flatnonzero(right)
        pairs = []
        for x in np.flatnonzero(left):
            total = n[x] + n[r]
            allowed = most_apart(total, measure)
            keep = (component[r] != component[x]) & (10 * np.minimum(n[x], n[r]) >= measure.tenths * np.maximum(n[x], n[r]))
            if keep.any():
                y = r[keep]
                apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1)
                y = y[apart <= allowed[keep]]
                pairs.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])]))
        if pairs:
            both = np.unique(np.concatenate(pairs, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def link_counts(batches: Iterator[pa.RecordBatch], measure: Measure = PAIRS) -> Iterator[pa.RecordBatch]:
    """(node, links) from sorted groups (component, i, j) of one or two chunks of a component.

    Shared shingles of all pairs are one product of two matrices that say which set has
    which shingle, made for SLICE shingles at a time. A set counts the copies of what it
    links with, and each pair of chunks is met in one group.
    """
    for group in _groups(batches, ("component", "i", "j", "chunk", "node", "n", "copies"), "shingles"):
        left = np.flatnonzero(group["chunk"] == group["i"][0])
        right = np.flatnonzero(group["chunk"] == group["j"][0])
        sets = group["shingles"]
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, column, often = np.unique(values, return_inverse=True, return_counts=True)
        shared = often[column] > 1
        column, owner = (np.cumsum(often > 1) - 1)[column[shared]], owner[shared]
        same = np.zeros((len(left), len(right)), dtype=np.int64)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
            at = slice(*np.searchsorted(column, [low, low + SLICE]))
            holds = np.zeros((len(sets), SLICE), dtype=np.float32)
            holds[owner[at], column[at] - low] = 1
            same += (holds[left] @ holds[right].T).astype(np.int64)
        n, copies = group["n"], group["copies"]
        linked = 10 * same >= measure.tenths * (n[left][:, None] + n[right][None, :] - same)
        linked &= group["node"][left][:, None] != group["node"][right][None, :]
        nodes, links = group["node"][left], linked @ copies[right]
        if group["i"][0] != group["j"][0]:
            nodes, links = np.concatenate([nodes, group["node"][right]]), np.concatenate([links, copies[left] @ linked])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links.astype(np.int64))], ["node", "links"])


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], data: str) -> Iterator[dict]:
    """Rows that agree in the first three columns, as arrays; `data` holds arrays of hashes as bytes."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*names, data)), strict=True):
            if row[:3] != held and rows:
                yield _columns(rows, names, data)
                rows = []
            held = row[:3]
            rows.append(row)
    if rows:
        yield _columns(rows, names, data)


def _columns(rows: list[tuple], names: tuple[str, ...], data: str) -> dict:
    return {name: np.array([r[k] for r in rows]) for k, name in enumerate(names)} | {
        data: [np.frombuffer(r[-1], dtype=U) for r in rows]
    }


def choose_boundary(sizes: dict[int, int], measure: Measure = PAIRS) -> int:
    """The largest size to enumerate, from the number of sets of each size up to `light_most`."""
    best, lowest, saved = measure.least - 1, 0.0, 0.0
    for n in range(measure.least, measure.light_most + 1):
        entries = sum(measure.blocks(c) for c in size_classes(n, measure))
        saved += sizes.get(n, 0) * (measure.subsets(n) - SCAN_COST * entries)
        if saved < lowest:
            best, lowest = n, saved
    return best


def _size_fits(n: str, m: str, measure: Measure):
    return 10 * F.least(F.col(n), F.col(m)) >= measure.tenths * F.greatest(F.col(n), F.col(m))


def _with_both(pairs: DataFrame, arrays: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of either set, prefixed a_ and b_."""
    for side in ("a", "b"):
        named = [F.col(c).alias(f"{side}_{c}") for c in columns]
        pairs = pairs.join(arrays.select(F.col("node").alias(side), *named), side)
    return pairs


def _verify(pairs: DataFrame, texts: DataFrame, measure: Measure, scratch: Scratch, name: str) -> DataFrame:
    """Of written candidate pairs, those that link; the shingles of their sets alone are made and moved."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    arrays = scratch.keep(_arrays(texts, ends, measure).drop("sketch"), f"{name}_arrays")
    found = _with_both(pairs, arrays, "shingles").mapInArrow(partial(verified, measure=measure), "a long, b long")
    found = scratch.keep(found, f"{name}_links")
    scratch.clear(f"{name}_arrays")
    return found


def _arrays(texts: DataFrame, nodes: DataFrame, measure: Measure) -> DataFrame:
    """Shingles and sketch of each of some class representatives."""
    return (
        texts.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .mapInArrow(partial(array_rows, measure=measure), "node long, n long, shingles binary, sketch binary")
        .dropDuplicates(["node", "n"])
    )


def _entries(sets: DataFrame, kind: str) -> DataFrame:
    return sets.select("node", "n", F.explode(kind).alias("key"))


def linked_components(docs: DataFrame, measure: Measure = PAIRS, count_links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of `docs` (doc_id, text).

    `n_links` is the number of other rows that a row links with, copies included; without
    `count_links` the column is left out.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = scratch.keep(texts.mapInArrow(partial(set_rows, measure=measure), SETS), "sets")
    same_set = ["c1", "c2", "n_shingles"]
    # Written, so that the join has a shuffle on either side and splits classes of very many copies.
    classes = scratch.keep(
        sets.where("n_shingles > 0").groupBy(*same_set).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "classes"
    )
    members = scratch.keep(
        sets.select("doc_id", *same_set).join(classes, same_set).select("doc_id", "n_shingles", "node", "copies"), "members"
    )
    nodes = members.where("doc_id = node").groupBy("node", F.col("n_shingles").alias("n")).agg(F.count("*").alias("rows"))
    nodes = scratch.keep(nodes, "nodes")
    counts = nodes.where(F.col("n") <= measure.light_most).groupBy("n").count().collect()  # at most light_most rows
    boundary = choose_boundary({r["n"]: r["count"] for r in counts}, measure)
    empty = scratch.keep(sets.where("n_shingles = 0").select("doc_id", "n_shingles"), "empty")

    # The keys of one row for each class; only rows that are repeated as a whole have to be brought together for that.
    # Sets just below the boundary are in the lists too, for their links with larger ones.
    no_keys = F.array().cast("array<long>")
    keyed = sets.select(
        F.col("doc_id").alias("node"),
        F.col("n_shingles").alias("n"),
        F.when(F.col("n_shingles") <= boundary, F.col("light")).otherwise(no_keys).alias("light"),
        F.when(F.col("n_shingles") * 10 >= measure.tenths * (boundary + 1), F.col("heavy")).otherwise(no_keys).alias("heavy"),
    ).join(nodes, ["node", "n"])
    once = keyed.where("rows = 1").drop("rows").unionByName(keyed.where("rows > 1").drop("rows").dropDuplicates(["node", "n"]))
    keyed = scratch.keep(once, "keyed")
    scratch.clear("sets")

    light = _entries(keyed, "light")
    smallest = light.groupBy("key").agg(F.min(F.struct("n", "node")).alias("hub"), F.count("*").alias("len")).where("len > 1")
    common = F.col("key").bitwiseAND(F.lit(255))
    by_subset = (
        light.join(scratch.keep(smallest.drop("len"), "smallest"), "key")
        .where(F.col("node") != F.col("hub.node"))
        .where((10 + measure.tenths) * common >= measure.tenths * (F.col("n") + F.col("hub.n")))
        .select(F.col("node").alias("a"), F.col("hub.node").alias("b"))
    )

    # Most keys are held by one set: only their counts move, and what is shared is looked up in the rest.
    heavy = _entries(keyed, "heavy")
    lists = scratch.keep(heavy.groupBy("key").agg(F.count("*").alias("len")).where("len > 1"), "lists")
    shared = scratch.keep(heavy.join(lists, "key"), "shared")
    central = shared.groupBy("node").agg(F.sum("len").alias("centrality"))
    hubs = (
        shared.join(central, "node")
        .groupBy("key")
        .agg(F.max(F.struct("centrality", (-F.col("node")).alias("minus"), "n")).alias("hub"))
        .select("key", F.col("hub.n").alias("m"), (-F.col("hub.minus")).alias("hub"))
    )
    stars = (
        shared.join(hubs, "key")
        .where((F.col("node") != F.col("hub")) & _size_fits("n", "m", measure))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    sketches = scratch.keep(_arrays(texts, shared, measure).drop("shingles"), "sketches")
    likely = _with_both(stars, sketches, "n", "sketch").mapInArrow(partial(possible, measure=measure), "a long, b long")
    likely = scratch.keep(likely, "likely")
    first = _verify(likely, texts, measure, scratch, "first").unionByName(by_subset)
    first = scratch.keep(first.distinct(), "first")
    scratch.clear("keyed", "lists")
    parts = connected_components(first, scratch, "parts")

    labelled = shared.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_lists = (
        labelled.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            # Lists of the same members are compared once.
            F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
            F.max("len").alias("list"),
        )
        .where("low < high and list > 2")
        .groupBy("members", "list")
        .agg(F.min("key").alias("key"))
        .withColumn("chunks", F.ceil(F.col("list") / CHUNK).cast("int"))
        .select("key", "chunks")
    )
    crossing = (
        _chunk_pairs(labelled.join(open_lists, "key"), ["key"], ["node", "n", "component"])
        .join(sketches, ["node", "n"])
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(partial(close_pairs, measure=measure), "a long, b long")
        .distinct()
    )
    crossing = scratch.keep(crossing, "crossing")
    second = first.unionByName(_verify(crossing, texts, measure, scratch, "second"))
    scratch.clear("sketches", "shared")
    whole = scratch.keep(connected_components(second, scratch, "whole"), "components")
    grouped = members.join(whole, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    alone = empty.withColumn("component_id", F.col("doc_id"))
    if not count_links:
        return grouped.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    links = _links(texts, members, whole, measure, scratch)
    # Copies link with each other as well.
    number = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    counted = grouped.join(links, "node", "left").select("doc_id", "n_shingles", "component_id", number.alias("n_links"))
    return counted.unionByName(alone.withColumn("n_links", F.lit(0).cast("long")))


def _chunk_pairs(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with `chunks`, dealt to the pairs (i, j) of chunks in which their own one is met."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    meets = F.transform(every, lambda k: F.struct(F.least(k, F.col("chunk")).alias("i"), F.greatest(k, F.col("chunk")).alias("j")))
    dealt = rows.withColumn("chunk", chunk).withColumn("meet", F.explode(meets))
    return dealt.select(*keys, "meet.i", "meet.j", "chunk", *columns)


def _links(texts: DataFrame, members: DataFrame, whole: DataFrame, measure: Measure, scratch: Scratch) -> DataFrame:
    """(node, links): the rows that the sets of each class link with, its own class left out."""
    classes = members.where("doc_id = node").select("node", F.col("n_shingles").alias("n"), "copies").distinct()
    linked = scratch.keep(whole.join(classes, "node"), "linked")
    chunks = F.ceil(F.count("*") / F.lit(CHUNK)).cast("int")
    sizes = linked.groupBy("component").agg(chunks.alias("chunks"))
    arrays = scratch.keep(_arrays(texts, linked, measure).drop("sketch"), "linked_arrays")
    links = (
        _chunk_pairs(linked.join(sizes, "component"), ["component"], ["node", "n", "copies"])
        .join(arrays, ["node", "n"])
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
        .mapInArrow(partial(link_counts, measure=measure), "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    return scratch.keep(links, "links")


def representatives(docs: DataFrame, measure: Measure = PAIRS) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their group.

    Only ids of groups with several rows are looked up, and the texts are not shuffled
    where these are few. Of rows that share id and text one stays. Rows without an id, and
    rows that share an id but not the text, which no id tells apart, all stay.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(text).alias("low"), F.max(text).alias("high"))
    repeated = scratch.keep(ids.where("rows > 1").select("doc_id", (F.col("low") != F.col("high")).alias("differ")), "repeated")
    unclear = repeated.where("differ").select("doc_id")
    some = bool(repeated.limit(1).count())
    clear = docs.join(unclear, "doc_id", "left_anti").select(docs.columns) if some else docs
    found = linked_components(clear, measure, count_links=False).select("doc_id", "component_id")
    rows = scratch.keep(found, "components")
    gone = rows.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = clear.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    if not some:
        return kept
    named, unnamed = kept.where("doc_id is not null"), kept.where("doc_id is null")
    return named.dropDuplicates(["doc_id"]).unionByName(unnamed).unionByName(docs.join(unclear, "doc_id", "left_semi").select(docs.columns))
