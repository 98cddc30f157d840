"""Similarity join of n-gram sets by count vectors in R-trees.

A document is the set of its runs of words. Two sets link when their Jaccard similarity reaches a threshold. Tokens
(the runs' hashes) are dealt into groups by hash, and the counts of the groups make a document a point. The overlap of two
sets is at most the sum of the smaller one of each pair of coordinates, and that bound holds for a box of points
too, so an R-tree over points gives all partners that can reach the threshold; those are verified on the sets.

One tree over a corpus would compare most points with most others, so trees are built over shards that lose no pair. Linked
sets of sizes within a band differ in at most D tokens. With more than D groups at least one group holds the same
tokens in both, so documents meet in the shard of each of their groups' contents (``signatures``). A passage that many
documents share makes no shard large, as a group mixes it with the rest of a document.

In a shard, every set is first compared with the one that shares most shards with others. Where a shard still
holds several components, trees find the pairs across components that the bound leaves, and those are compared, in chunks
of a bounded size. Equal sets are one node throughout. So every linked pair ends in one component.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.components import components
from viewloom.llm.textbytes import BLANK, LOWER, SYMBOL, Texts, Words, mix, runs, spans_hash, text_blocks, window_hashes
from viewloom.session import cut_lineage

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
#: Points of a leaf and nodes of a node; shards of fewer members are compared without a tree.
LEAF, FAN, SMALL = 16, 8, 48
#: Counts compared at once.
AT_ONCE = 1 << 21
#: Bytes of points that a task looks at together.
POINT_BYTES = 4 << 20
#: Sizes of sets are cut into bands that grow by a half, up to this size.
LARGEST_SET = 1 << 40
CHUNK_TOKENS, CHUNK_MEMBERS = 2_000_000, 2048
#: A signature ends with the level of its band: points of its shard have 2**level coordinates.
LEVEL_BITS = 6
#: Keys of 32 bytes that may be sent to all tasks, about 50 MB there.
SENT_KEYS = 500_000
#: A level above that of any point.
FINEST = 60
SHARD = ["sig", "low", "high"]


def words_between_blanks(texts: Texts) -> Words:
    """Maximal runs of bytes other than white space after lower-casing A-Z."""
    lower = LOWER[texts.data]
    starts, ends = runs(~BLANK[lower])
    bounds = np.append(np.searchsorted(starts, texts.starts), len(starts))
    return Words(lower, starts, ends, bounds, spans_hash(SYMBOL[lower], starts, ends))


def token_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of all different runs of ``size`` words, in order; fewer words, but not none, are one run."""
    words = words_between_blanks(texts)
    hashes, at = window_hashes(words, size)
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < size))
    owners = np.concatenate((np.searchsorted(words.bounds, at, "right") - 1, short))
    hashes = np.concatenate((hashes, spans_hash(words.hashes, words.bounds[short], words.bounds[short + 1])))
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    first = np.ones(len(owners), bool)
    first[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
    return owners[first], hashes[first]


class Threshold:
    """Similarity of at least ``percent`` hundredths, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def needed(self, sizes):
        """The least overlap of linked sets whose sizes add up to ``sizes``."""
        return -(-self.percent * sizes // (100 + self.percent))

    def largest_partner(self, size):
        return 100 * size // self.percent

    def least_partner(self, size):
        return -(-self.percent * size // 100)

    def differences(self, sizes):
        """How many tokens at most are in one only of linked sets whose sizes add up to ``sizes``."""
        return (100 - self.percent) * sizes // (100 + self.percent)


@cache
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First sizes of the bands; of each its groups, how many of them may be empty, and the level of its points.

    Points have about as many coordinates as sets have tokens, so that tokens in one set only seldom cancel out.
    """
    rule, edges = Threshold(percent), [1]
    while edges[-1] < LARGEST_SET:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
    largest = [e - 1 for e in edges[1:]]
    differ = np.array([rule.differences(m + rule.largest_partner(m)) for m in largest])
    spare = differ // 24
    levels = np.array([max(6, int(m).bit_length()) for m in largest])
    return np.array(edges), differ + 1 + spare, spare, levels


def signatures(owners: np.ndarray, tokens: np.ndarray, texts: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature): one for every group that isn't empty, in every band that the text's set belongs to.

    A set belongs to the band of its size and to those of smaller partners. If more groups are empty than the band
    allows, the tokens are dealt again by another hash, as both of two sets that have too many empty ones in common do.
    """
    edges, groups, spare, levels = bands(percent)
    sizes = np.bincount(owners, minlength=texts)
    there = sizes > 0
    own = np.where(there, np.searchsorted(edges, sizes, "right") - 1, -1)
    lowest = np.where(there, np.searchsorted(edges, Threshold(percent).least_partner(sizes), "right") - 1, 0)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for down in range(int((own - lowest)[there].max(initial=-1)) + 1):
        asked, seed = there & (own - down >= lowest), 0
        while asked.any():
            band = np.where(asked, own - down, 0)
            n = np.where(asked, groups[band], 0)
            base = np.cumsum(n) - n
            at = asked[owners]
            who, what = owners[at], tokens[at]
            drawn = mix(what + np.uint64((seed + 1) * int(GOLDEN) % 2**64)) >> np.uint64(32)
            place = base[who] + ((drawn * n[who].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            sums, counts = np.zeros(n.sum(), np.uint64), np.bincount(place, minlength=n.sum())
            np.add.at(sums, place, mix(what ^ OTHER))
            text = np.repeat(np.arange(texts), n)
            name = ((seed * len(edges) + band[text]) << 40) + np.arange(len(text)) - base[text]
            full = counts > 0
            signature = mix(sums[full] + mix(name[full].astype(np.uint64) * GOLDEN + counts[full].astype(np.uint64)))
            level = levels[band[text[full]]].astype(np.uint64)
            found.append((text[full], signature << np.uint64(LEVEL_BITS) | level))
            empty = np.bincount(text[~full], minlength=texts)
            asked = asked & (empty > spare[band])
            seed += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([t for t, _ in found]), np.concatenate([s for _, s in found])


def points(owners: np.ndarray, tokens: np.ndarray, texts: int, percent: int) -> list[bytes]:
    """The point of every text, a byte per coordinate, compressed; most counts are 0 or 1. Empty for a text without tokens.

    A point has the level of its band at least, and the next ones where a count exceeds a byte. Halving the number of
    coordinates adds the two halves up (``folded``).
    """
    edges, _, _, levels = bands(percent)
    sizes = np.bincount(owners, minlength=texts)
    level = levels[np.searchsorted(edges, np.maximum(sizes, 1), "right") - 1]
    hashes, starts = mix(tokens * OTHER + GOLDEN), np.cumsum(sizes) - sizes
    out = []
    for text in range(texts):
        counts, at = np.zeros(0, np.int64), int(level[text])
        while sizes[text]:
            own = hashes[starts[text] : starts[text] + sizes[text]] & np.uint64((1 << at) - 1)
            counts = np.bincount(own.astype(np.int64), minlength=1 << at)
            if counts.max() < 256:
                break
            at += 1
        out.append(zlib.compress(counts.astype(np.uint8).tobytes(), 1) if len(counts) else b"")
    return out


def folded(point: bytes, level: int) -> np.ndarray:
    """The point's counts at a lower level, or at its own."""
    counts = np.frombuffer(zlib.decompress(point), np.uint8)
    level = min(level, len(counts).bit_length() - 1)
    return counts.reshape(-1, 1 << level).sum(axis=0, dtype=np.uint16)


def set_prints(owners: np.ndarray, tokens: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of every set."""
    out = []
    for salt in (GOLDEN, OTHER):
        sums = np.zeros(texts, np.uint64)
        np.add.at(sums, owners, mix(tokens + salt))
        out.append(mix(sums + np.bincount(owners, minlength=texts).astype(np.uint64) * salt).view(np.int64))
    return out[0], out[1]


class CountTree:
    """A packed R-tree: every node has the largest coordinates and the least and largest set below it."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.concatenate(self._leaves(vectors, np.arange(len(vectors)))) if len(vectors) else np.zeros(0, np.int64)
        self.vectors = vectors[self.order]
        sizes = self.vectors.sum(axis=1, dtype=np.int64)
        self.levels = [(self.vectors, sizes, sizes)]
        self.fans: list[int] = []
        while len(self.levels[-1][0]) > 1:
            high, least, most = self.levels[-1]
            fan = LEAF if not self.fans else FAN
            starts = np.arange(0, len(high), fan)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))
            self.fans.append(fan)

    def _leaves(self, vectors: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Points in an order that keeps near ones together: halves along the widest coordinate."""
        if len(at) <= LEAF:
            return [at]
        own = vectors[at]
        wide = int((own.max(axis=0).astype(np.int64) - own.min(axis=0)).argmax())
        at = at[np.argsort(own[:, wide], kind="stable")]
        half = LEAF * (len(at) // (2 * LEAF) or 1)
        return self._leaves(vectors, at[:half]) + self._leaves(vectors, at[half:])

    def search(self, queries: np.ndarray, rule: Threshold, at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of all pairs whose sizes and summed coordinate minima can reach the threshold."""
        sizes = queries.sum(axis=1, dtype=np.int64)
        low, high = rule.least_partner(sizes), rule.largest_partner(sizes)
        top = len(self.levels) - 1
        asked = np.arange(len(queries))
        stack = [(top, asked, np.zeros(len(asked), np.int64))] if len(self.vectors) else []
        rows = max(1, at_once // max(1, queries.shape[1]))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while stack:
            level, q, node = stack.pop()
            if len(q) > rows:
                stack += [(level, q[:rows], node[:rows]), (level, q[rows:], node[rows:])]
                continue
            highest, least, most = self.levels[level]
            fits = (most[node] >= low[q]) & (least[node] <= high[q])
            q, node = q[fits], node[fits]
            bound = np.minimum(queries[q], highest[node]).sum(axis=1, dtype=np.int64)
            fits = bound >= rule.needed(sizes[q] + np.maximum(least[node], low[q]))
            q, node = q[fits], node[fits]
            if level == 0:
                found.append((q, self.order[node]))
                continue
            fan = self.fans[level - 1]
            below = (node[:, None] * fan + np.arange(fan)[None, :]).reshape(-1)
            q = np.repeat(q, fan)
            real = below < len(self.levels[level - 1][0])
            if real.any():
                stack.append((level - 1, q[real], below[real]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


@dataclass
class Shards:
    """Whole shards, or chunk pairs of shards, one after the other; shard s has the rows bounds[s]:bounds[s + 1]."""

    bounds: np.ndarray
    levels: np.ndarray
    chunks: np.ndarray
    parts: np.ndarray
    sizes: np.ndarray
    points: list[bytes]


def across(shards: Shards, rule: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows that the bound leaves, of one shard and of different parts; of a chunk pair, one row of each chunk."""
    members = np.diff(shards.bounds)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    shard = np.repeat(np.arange(len(members)), members)
    row = np.arange(len(shard))
    first_chunk = np.minimum.reduceat(shards.chunks, shards.bounds[:-1]) if len(row) else row
    paired = (np.maximum.reduceat(shards.chunks, shards.bounds[:-1]) if len(row) else row) != first_chunk

    def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        one_of_each = ~paired[shard[i]] | (shards.chunks[i] != shards.chunks[j])
        low, high = np.minimum(shards.sizes[i], shards.sizes[j]), np.maximum(shards.sizes[i], shards.sizes[j])
        return one_of_each & (shards.parts[i] != shards.parts[j]) & (low >= rule.least_partner(high))

    # Small shards: all later rows of the shard, at once for all shards of a level.
    after = np.where(members[shard] <= SMALL, shards.bounds[shard + 1] - row - 1, 0) if len(row) else row
    i = np.repeat(row, after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    kept = wanted(i, j)
    i, j = i[kept], j[kept]
    for level in np.unique(shards.levels[shard[i]]).tolist():
        of_level = np.flatnonzero(shards.levels[shard[i]] == level)
        step = max(1, AT_ONCE >> level)
        for at in np.split(of_level, range(step, len(of_level), step)):
            used = np.unique(np.concatenate((i[at], j[at])))
            vectors = np.empty((len(used), 1 << level), np.uint16)
            for place, r in enumerate(used):
                vectors[place] = folded(shards.points[r], level)
            a, b = np.searchsorted(used, i[at]), np.searchsorted(used, j[at])
            bound = np.minimum(vectors[a], vectors[b]).sum(axis=1, dtype=np.int64)
            good = at[bound >= rule.needed(shards.sizes[i[at]] + shards.sizes[j[at]])]
            found.append((i[good], j[good]))
    for s in np.flatnonzero(members > SMALL).tolist():
        rows = np.arange(shards.bounds[s], shards.bounds[s + 1])
        vectors = np.array([folded(shards.points[r], int(shards.levels[s])) for r in rows], np.uint16)
        left = np.flatnonzero(shards.chunks[rows] == first_chunk[s]) if paired[s] else np.arange(len(rows))
        right = np.flatnonzero(shards.chunks[rows] != first_chunk[s]) if paired[s] else left
        q, p = CountTree(vectors[right]).search(vectors[left], rule)
        a, b = rows[left[q]], rows[right[p]]
        good = wanted(a, b) & (paired[s] | (a < b))
        found.append((a[good], b[good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.lexsort((j, i))
    return i[order], j[order]


def _bounded_tables(table: pa.Table, starts: np.ndarray) -> Iterator[pa.Table]:
    """Parts of a table of whole shards, cut at ``starts`` of shards after about POINT_BYTES."""
    reached = np.cumsum(pc.binary_length(table.column("point")).to_numpy()) if "point" in table.column_names else np.zeros(table.num_rows)
    first = 0
    while first < table.num_rows:
        before = reached[first - 1] if first else 0
        more = starts[(starts > first) & (reached[starts - 1] - before >= POINT_BYTES)] if len(starts) else starts
        end = int(more[0]) if len(more) else table.num_rows
        yield table.slice(first, end - first).combine_chunks()
        first = end


def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables that end where a shard does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        name = np.column_stack([table.column(c).to_numpy() for c in SHARD])
        last = np.flatnonzero((name[1:] != name[:-1]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from _bounded_tables(table.slice(0, cut), last[:-1] + 1)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def shards_of(table: pa.Table) -> Shards:
    name = np.column_stack([table.column(c).to_numpy() for c in SHARD])
    starts = np.append(0, np.flatnonzero((name[1:] != name[:-1]).any(axis=1)) + 1)
    levels = name[starts, 0] & ((1 << LEVEL_BITS) - 1)
    plain = [table.column(c).to_numpy() for c in ("chunk", "part", "n")]
    return Shards(np.append(starts, len(name)), levels, *plain, table.column("point").to_pylist())


def joining(i: np.ndarray, j: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], rule: Threshold) -> Iterator[tuple[int, int]]:
    """The verified pairs that join parts, as few as connect the same."""
    label = parts.copy()
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        if label[a] != label[b]:
            overlap = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if overlap >= rule.needed(len(sets[a]) + len(sets[b])):
                label[label == label[b]] = label[a]
                yield a, b


def _described(docs: DataFrame, key: str, text: str, size: int, percent: int, bits: int) -> DataFrame:
    """(key, t, u, r, x, y, n, posts) per row; posts are left out where the task has met the same set before."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(whole).alias("t"),
        F.xxhash64(F.lit(1), whole).alias("u"),
        F.xxhash64(F.lit(2), F.col(key)).alias("r"),
        F.col(text).alias("text"),
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column("text")):
                owners, tokens = token_sets(block, size)
                x, y = set_prints(owners, tokens, len(block))
                x = x >> np.int64(64 - bits)
                n = np.bincount(owners, minlength=len(block))
                new = np.zeros(len(block), bool)
                for i, name in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
                    if name not in met:
                        met.add(name)
                        new[i] = True
                kept = new[owners]
                text_of, posts = signatures(owners[kept], tokens[kept], len(block), percent)
                order = np.argsort(text_of, kind="stable")
                offsets = np.concatenate(([0], np.cumsum(np.bincount(text_of, minlength=len(block))))).astype(np.int32)
                plain = [batch.column(c).slice(at, len(block)) for c in ("key", "t", "u", "r")]
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(posts[order].view(np.int64)))
                columns = [*plain, pa.array(x), pa.array(y), pa.array(n), listed]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "t", "u", "r", "x", "y", "n", "posts"])
                at += len(block)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(describe, f"key {kind}, t bigint, u bigint, r bigint, x bigint, y bigint, n bigint, posts array<bigint>")


def _with_nodes(table: DataFrame) -> DataFrame:
    """``table`` with the number of its set: x, or a hash of x and y where different sets have one x."""
    same = table.groupBy("x").agg(F.min("y").alias("low"), F.max("y").alias("high")).where("low < high")
    odd = cut_lineage(same.select("x", F.lit(True).alias("odd")))
    if not odd.limit(1).count():
        return table.withColumnRenamed("x", "node").drop("y")
    marked = table.join(odd, "x", "left")
    return marked.withColumn("node", F.when(F.col("odd"), F.xxhash64("x", "y")).otherwise(F.col("x"))).drop("x", "y", "odd")


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """(node, point, tokens) of every wanted node, from one text of each."""
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.xxhash64(whole).alias("t"), F.xxhash64(F.lit(1), whole).alias("u"), F.xxhash64(F.lit(2), F.col(key)).alias("r"), F.col(text).alias("text")
    )
    places = cut_lineage(nodes.join(wanted, "node", "left_semi").select("node", "at.*"))
    # Texts move only if there are too many of the wanted ones to send their keys to all tasks.
    texts = keyed.join(_sent(places), ["t", "u", "r"]).select("node", "text").dropDuplicates(["node"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column("text")):
                owners, tokens = token_sets(block, size)
                offsets = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(block))))).astype(np.int32)
                columns = [
                    batch.column("node").slice(at, len(block)),
                    pa.array(points(owners, tokens, len(block), percent), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "point", "tokens"])
                at += len(block)

    return cut_lineage(texts.mapInArrow(sets, "node bigint, point binary, tokens array<bigint>"))


def _bounded(rule: Threshold):
    """Whether two points leave the threshold in reach; the finer one is folded."""

    def bound(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
                x, y = folded(a, FINEST), folded(b, FINEST)
                level = min(len(x), len(y)).bit_length() - 1
                x, y = folded(a, level), folded(b, level)
                out.append(int(np.minimum(x, y).sum()) >= rule.needed(int(x.sum() + y.sum())))
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(bound, "boolean")


def _sent(keys: DataFrame) -> DataFrame:
    """Written keys, sent to all tasks if they are few enough; else Spark shuffles both sides of their joins."""
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys


def _both_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """(left, right, l, r): the pairs with both nodes' ``column``. What moves is two rows per pair, not all sets."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("left").alias("node"), F.lit(0).alias("end")), F.struct(F.col("right").alias("node"), F.lit(1).alias("end")))).alias("e"), "left", "right")
    met = sets.select("node", column).join(_sent(cut_lineage(ends.select("e.*", "left", "right"))), "node")
    own = F.array_sort(F.collect_list(F.struct("end", column)))
    both = met.groupBy("left", "right").agg(own.alias("both"))
    return both.select("left", "right", F.element_at("both", 1)[column].alias("l"), F.element_at("both", 2)[column].alias("r"))


def _verified(pairs: DataFrame, sets: DataFrame, nodes: DataFrame, rule: Threshold) -> DataFrame:
    """The linked ones of the pairs (left, right): first by sizes, then by points, then by their sets."""
    sizes = nodes.select("node", "n")
    sized = pairs.join(sizes.select(F.col("node").alias("left"), F.col("n").alias("ln")), "left")
    sized = sized.join(sizes.select(F.col("node").alias("right"), F.col("n").alias("rn")), "right")
    sized = cut_lineage(sized.where(100 * F.least("ln", "rn") >= rule.percent * F.greatest("ln", "rn")).select("left", "right"))
    bounded = _both_sides(sized, sets, "point").where(_bounded(rule)("l", "r"))
    full = _both_sides(cut_lineage(bounded.select("left", "right")), sets, "tokens")
    overlap = F.size(F.array_intersect("l", "r"))
    total = F.size("l") + F.size("r")
    return full.where((100 + rule.percent) * overlap.cast("bigint") >= rule.percent * total.cast("bigint")).select("left", "right")


def _candidates(rule: Threshold):
    """Of whole shards: the members that the bound leaves with a partner of another part."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_shards(batches):
            i, j = across(shards_of(table), rule)
            kept = table.select([*SHARD, "chunk", "node", "part", "n"]).take(pa.array(np.unique(np.concatenate((i, j)))))
            yield from kept.to_batches()

    return find


def _linker(rule: Threshold):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_shards(batches):
            nodes, shards = table.column("node").to_numpy(), shards_of(table)
            lists = table.column("tokens").combine_chunks()
            offsets = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))))
            values = np.asarray(lists.flatten())
            sets = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            i, j = across(shards, rule)
            found = [(nodes[a], nodes[b]) for a, b in joining(i, j, shards.parts, sets, rule)]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["left", "right"])

    return link


def _different(shared: DataFrame) -> DataFrame:
    """(sig, node, members) of one of all shards that have the same members, for the shards of several."""
    prints = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"p{i}") for i in (0, 1)]
    shards = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("members"), *prints).where("members > 1")
    once = shards.groupBy("members", "p0", "p1").agg(F.min("sig").alias("sig")).select("sig", "members")
    return shared.join(once, "sig")


def _across_parts(known: DataFrame, sets: DataFrame, rule: Threshold) -> DataFrame:
    """Links (left, right) that join the parts of a shard; ``known``: sig, node, n, part."""
    spread = known.groupBy("sig").agg(
        F.min("part").alias("first"),
        F.max("part").alias("last"),
        F.greatest(F.ceil(F.sum("n") / CHUNK_TOKENS), F.ceil(F.count(F.lit(1)) / CHUNK_MEMBERS)).cast("int").alias("chunks"),
    )
    rest = known.join(spread.where("first < last").drop("first", "last"), "sig")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    # Every pair of chunks is compared by one task; a shard of one chunk is one.
    dealt = rest.withColumn("chunk", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("chunk", "with")).withColumn("high", F.greatest("chunk", "with"))
    dealt = dealt.select(*SHARD, "chunk", "node", "part", "n")
    light = dealt.join(sets.select("node", "point"), "node").repartition(*SHARD).sortWithinPartitions(*SHARD, "node")
    names = "sig bigint, low int, high int, chunk int, node bigint, part bigint, n bigint"
    left = cut_lineage(light.mapInArrow(_candidates(rule), names))
    full = _sent(left).join(sets, "node").repartition(*SHARD).sortWithinPartitions(*SHARD, "node")
    return full.mapInArrow(_linker(rule), "left bigint, right bigint")


def linked_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85, bits: int = 64
) -> DataFrame:
    """One row per document: ``key``, n_shingles and component_id, the smallest key that links reach, its own included.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``size``-word runs; white space
    separates words and A-Z are lower-cased. A text that is null or has no word has an empty set and links with nothing. Null keys
    come after all others, so a component has a null id only if all its keys are null. Repeated rows are documents of one
    set. Other columns are not returned. ``bits`` shortens the first fingerprint of sets, for tests.
    """
    rule = Threshold(percent)
    table = cut_lineage(_with_nodes(cut_lineage(_described(docs, key, text, size, percent, bits))))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key")).alias("first")
    there = table.where("n > 0")
    nodes = cut_lineage(there.groupBy("node").agg(first, F.min(F.struct("t", "u", "r")).alias("at"), F.first("n").alias("n")))

    posts = there.select("node", F.explode("posts").alias("sig"))
    met = posts.groupBy("sig").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("sig")
    shared = cut_lineage(posts.join(met, "sig").distinct())
    # The node that shares most shards with others stands for its shards.
    shared = cut_lineage(_different(shared))
    shares = shared.groupBy("node").agg(F.sum("members").alias("shares"))
    heads = shared.join(shares, "node").groupBy("sig").agg(F.max(F.struct("shares", "node")).alias("head"))
    stars = shared.join(heads, "sig").select(F.col("node").alias("left"), F.col("head.node").alias("right")).where("left != right")
    stars = cut_lineage(stars.distinct())
    sets = _sets_of(docs, nodes, shared.select("node").distinct(), key, text, size, percent)
    links = cut_lineage(_verified(stars, sets, nodes, rule))
    labels = components(links)

    # Shards that hold several components after the first step.
    known = shared.join(nodes.select("node", "n"), "node").join(labels, "node", "left")
    known = cut_lineage(known.select("sig", "node", "n", F.coalesce("label", "node").alias("part")))
    more = cut_lineage(_across_parts(known, sets, rule))
    if more.limit(1).count():
        labels = components(links.union(more))

    placed = nodes.join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("part"))
    least = placed.groupBy("part").agg(F.min("first").alias("least"))
    found = table.join(placed.join(least, "part").select("node", "least"), "node", "left")
    own = F.when(F.col("n") > 0, F.col("least.key")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))
