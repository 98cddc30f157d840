"""Near duplicates by BagMinHash: weighted Jaccard similarity of bags of word shingles.

A document is the bag of its runs of five words; a shingle's weight is how often it stands there. Weights
are cut into the levels [0, 1), [1, 2), [2, 4), [4, 8) ... Every (shingle, level) has a Poisson
process of its own, of a rate in proportion to the level's width, whose points fall on a
component of the signature and on a height of the level; a point counts if it lies below the
weight. A component keeps its earliest point. Two bags agree in a component with the probability
of their weighted Jaccard similarity. A process stops at the time by which all components
of its bag are surely hit, so a bag of n words costs O(n + m log m) and not n times m.

Documents of equal texts are one class. Signatures of the classes are cut into bands; classes that
share a band's bucket are candidates:

1. every class is compared with one class of each of its buckets, the one that shares most buckets with
   others. That is linear in the size of a bucket. Verified links are put together to components;
2. where a bucket still holds several components, its members are compared across components, in chunks of a
   bounded size, by tasks that hold the bags of two chunks. A task returns the links that join components, less
   than it has members; pairs as such are never written.

So every pair of classes that shares a bucket is either compared exactly or already in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.components import components
from viewloom.llm.textbytes import Texts, mix, spans_hash, text_blocks, window_hashes, words_of
from viewloom.session import cut_lineage

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bounds of a chunk of a bucket: 16 MB of units, and members that are looped over.
CHUNK_UNITS, CHUNK_MEMBERS = 2_000_000, 2048


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle; a text of fewer words, but not none, is one shingle."""
    words = words_of(texts)
    hashes, at = window_hashes(words, size)
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = spans_hash(words.hashes, words.bounds[short], words.bounds[short + 1])
    owners = np.searchsorted(words.bounds, at, "right") - 1
    return np.concatenate((owners, short)), np.concatenate((hashes, whole))


def bags(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight), ordered by text and hash."""
    owners, hashes = shingles(texts, size)
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    first = np.ones(len(owners), bool)
    first[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return owners[at], hashes[at], np.diff(np.append(at, len(owners)))


def signatures(owners: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Times of the earliest points, one row of ``m`` per text; infinite for texts without a shingle."""
    out = np.full((texts, m), np.inf)
    total = np.bincount(owners, weights, texts)
    # All m components are hit by then with a probability of 95 %; the others go on later.
    until = np.divide(np.log(m) + 3.0, total, out=np.zeros(texts), where=total > 0)
    levels = [(0, 1)]
    while levels[-1][1] < weights.max(initial=1):
        levels.append((levels[-1][1], 2 * levels[-1][1]))
    parts = [(np.flatnonzero(weights > low), low, high) for low, high in levels]
    owner = np.concatenate([owners[at] for at, _, _ in parts])
    key = np.concatenate([mix(hashes[at] + np.uint64(k * int(GOLDEN) % 2**64)) for k, (at, _, _) in enumerate(parts)])
    low = np.concatenate([np.full(len(at), a, np.float64) for at, a, _ in parts])
    width = np.concatenate([np.full(len(at), b - a, np.float64) for at, a, b in parts])
    weight = np.concatenate([weights[at] for at, _, _ in parts]).astype(np.float64)
    open_texts = total > 0
    while open_texts.any():
        out[open_texts] = np.inf
        at = np.flatnonzero(open_texts[owner])
        now, nth, step = np.zeros(len(at)), 0, 1
        while len(at):
            # The next points of all processes that are not yet at their end; in longer steps when few are left.
            step = 1 if len(at) > 4096 else 16
            count = (np.uint64(nth + 1) + np.arange(step, dtype=np.uint64)) * GOLDEN
            drawn = mix(key[at][:, None] + count[None, :])
            gaps = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            # Added up one after the other, so that times don't depend on the length of steps.
            gaps /= (m * width[at])[:, None]
            times = np.empty_like(gaps)
            for i in range(step):
                now = now + gaps[:, i]
                times[:, i] = now
            more = mix(drawn + GOLDEN)
            component = ((more >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            height = low[at][:, None] + width[at][:, None] * ((more & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
            good = (height < weight[at][:, None]) & (times <= until[owner[at]][:, None])
            rows = np.broadcast_to(owner[at][:, None], good.shape)[good]
            np.minimum.at(out, (rows, component[good].astype(np.int64)), times[good])
            going = now <= until[owner[at]]
            at, now, nth = at[going], now[going], nth + step
        open_texts = open_texts & ~np.isfinite(out).all(axis=1)
        until[open_texts] *= 1.5
    return out


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash for every ``rows`` components."""
    bits = mix(signature.view(np.uint64))
    out = np.zeros((len(signature), signature.shape[1] // rows), np.uint64)
    for i in range(rows):
        out = mix(out * GOLDEN + bits[:, i::rows])
    return out


def units(owners: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every shingle once per occurrence: the overlap of bags is that of these sets."""
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    return np.repeat(owners, weights), mix(np.repeat(hashes, weights) + nth.astype(np.uint64) * GOLDEN)


def _signer(size: int, m: int, rows: int):
    kind = pa.struct([("n_units", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            counts, listed = [], []
            for block in text_blocks(column):
                owners, hashes, weights = bags(block, size)
                bands = band_hashes(signatures(owners, hashes, weights, len(block), m), rows).view(np.int64)
                n = np.bincount(owners, weights, len(block)).astype(np.int64)
                counts.append(n)
                listed += [list(b) if c else None for b, c in zip(bands, n, strict=True)]
            n = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))
            yield pa.StructArray.from_arrays([n, pa.array(listed, pa.list_(pa.int64()))], fields=list(kind))

    return F.arrow_udf(sign, "struct<n_units: bigint, bands: array<bigint>>").asNondeterministic()


def _bagger(size: int):
    def bag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            values, lengths = [], []
            for block in text_blocks(column):
                owners, hashes = units(*bags(block, size))
                values.append(hashes.view(np.int64))
                lengths.append(np.bincount(owners, minlength=len(block)))
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))) if lengths else np.zeros(1)
            flat = np.concatenate(values) if values else np.zeros(0, np.int64)
            yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))

    return F.arrow_udf(bag, "array<bigint>").asNondeterministic()


def _keys(docs: DataFrame, text: str) -> list:
    """_class: fingerprint of the text, a null being empty; _row: fingerprint of the whole row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    row = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != text] or [F.lit(0)]))
    prints = F.struct(F.xxhash64(whole).alias("x"), F.xxhash64(F.lit(1), whole).alias("y"))
    return [prints.alias("_class"), F.xxhash64(row).alias("_row")]


def _bags_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, text: str, size: int) -> DataFrame:
    """(_class, bag): the units of one text of every class in ``nodes``."""
    # One row of every class: copies differ in _row, which deals a class of many copies out evenly.
    wanted = classes.join(nodes, "_class", "left_semi").select("_class", F.col("_first._row").alias("_row"))
    texts = docs.select(F.col(text).alias("_text"), *_keys(docs, text)).join(wanted, ["_class", "_row"])
    bagged = texts.dropDuplicates(["_class"]).select("_class", _bagger(size)(F.col("_text")).alias("bag"))
    return cut_lineage(bagged)


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, text: str, size: int, similarity: float) -> DataFrame:
    """The pairs (left, right) of classes whose bags are similar enough."""
    sizes = classes.select(F.col("_class").alias("_c"), "n_units")
    sized = (
        pairs.join(sizes.select(F.col("_c").alias("left"), F.col("n_units").alias("nl")), "left")
        .join(sizes.select(F.col("_c").alias("right"), F.col("n_units").alias("nr")), "right")
        .where(F.least("nl", "nr") >= similarity * F.greatest("nl", "nr"))
    )
    sized = cut_lineage(sized)
    nodes = sized.select(F.col("left").alias("_class")).union(sized.select(F.col("right").alias("_class"))).distinct()
    bagged = _bags_of(docs, classes, nodes, text, size)
    both = sized.join(bagged.select(F.col("_class").alias("left"), F.col("bag").alias("lb")), "left").join(
        bagged.select(F.col("_class").alias("right"), F.col("bag").alias("rb")), "right"
    )
    overlap = F.size(F.array_intersect("lb", "rb"))
    return both.where(overlap / (F.col("nl") + F.col("nr") - overlap) >= similarity).select("left", "right")


def joining_links(groups: np.ndarray, parts: np.ndarray, chunks: np.ndarray, offsets: np.ndarray, values: np.ndarray, similarity: float):
    """Pairs (i, j) of similar members that join different parts, as few as connect the same.

    Member i has the part ``parts[i]`` and the units values[offsets[i]:offsets[i + 1]]. Members of one chunk are
    compared here only if there is one chunk.
    """
    numbers = np.unique(values, return_inverse=True)[1]
    flags = np.zeros(len(values) + 1, bool)
    sizes = np.diff(offsets)
    label = parts.copy()
    across = len({*chunks.tolist()}) > 1
    for i in range(len(groups)):
        other = (label != label[i]) & (np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i]))
        if across:
            other &= chunks > chunks[i]
        else:
            other[: i + 1] = False
        at = np.flatnonzero(other)
        if not len(at):
            continue
        own = numbers[offsets[i] : offsets[i + 1]]
        flags[own] = True
        # Units of the members asked for, one after the other.
        picked = np.repeat(offsets[at], sizes[at]) + np.arange(sizes[at].sum()) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
        overlap = np.add.reduceat(flags[numbers[picked]].astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
        flags[own] = False
        for j in at[overlap / (sizes[i] + sizes[at] - overlap) >= similarity]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield i, int(j)


def _linker(similarity: float):
    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        classes = table.column("_class").to_pylist()
        order = sorted(range(len(classes)), key=lambda i: (classes[i]["x"], classes[i]["y"]))
        table = table.take(order)
        classes = [classes[i] for i in order]
        names = [(p["x"], p["y"]) for p in table.column("part").to_pylist()]
        number = {p: i for i, p in enumerate(dict.fromkeys(names))}
        lists = table.column("bag").combine_chunks()
        offsets = np.asarray(lists.offsets, np.int64)
        values = np.asarray(lists.values)[offsets[0] : offsets[-1]]
        pairs = joining_links(
            np.arange(len(classes)),
            np.array([number[p] for p in names]),
            table.column("chunk").to_numpy(),
            offsets - offsets[0],
            values,
            similarity,
        )
        found = [(classes[i], classes[j]) for i, j in pairs]
        kind = pa.struct([("x", pa.int64()), ("y", pa.int64())])
        return pa.table({"left": pa.array([a for a, _ in found], kind), "right": pa.array([b for _, b in found], kind)})

    return link


def _across(docs: DataFrame, classes: DataFrame, known: DataFrame, text: str, size: int, similarity: float) -> DataFrame:
    """Links (left, right) that join the parts of a bucket; ``known``: band, hash, _class, part, n_units."""
    bucket = ["band", "hash"]
    spread = known.groupBy(*bucket).agg(
        F.min("part").alias("low"),
        F.max("part").alias("high"),
        F.greatest(F.ceil(F.sum("n_units") / CHUNK_UNITS), F.ceil(F.count(F.lit(1)) / CHUNK_MEMBERS)).cast("int").alias("chunks"),
    )
    rest = known.join(spread.where("low < high").drop("low", "high"), bucket)
    chunk = F.pmod(F.xxhash64("_class"), F.col("chunks")).cast("int")
    # Every pair of chunks is a task; a bucket of one chunk is one.
    dealt = rest.withColumn("chunk", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("chunk", "with")).withColumn("high", F.greatest("chunk", "with"))
    dealt = cut_lineage(dealt.select(*bucket, "low", "high", "chunk", "_class", "part"))
    bagged = _bags_of(docs, classes, dealt.select("_class").distinct(), text, size)
    pair = "struct<x: bigint, y: bigint>"
    grouped = dealt.join(bagged, "_class").groupBy(*bucket, "low", "high")
    return grouped.applyInArrow(_linker(similarity), f"left {pair}, right {pair}")


def near_duplicates(
    docs: DataFrame,
    order: str = "doc_id",
    text: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    bands: int = 21,
    rows: int = 6,
) -> DataFrame:
    """One row per document: ``order``, class_id, text_id, n_units and the keys _class, _row, _keep.

    class_id is the smallest ``order`` of all documents that links of at least ``similarity`` connect,
    text_id that of the documents of the same text (a null counts as the empty text). _keep
    marks the first row of every class; equal rows are all marked. A text without words is similar to
    none but its equals. With 21 bands of 6, a pair of similarity 0.8 shares a bucket with probability
    0.998. Nulls of ``order`` come after all values; a class of nulls only has a null class_id.
    """
    signed = docs.select(F.col(order).alias("_id"), *_keys(docs, text), _signer(size, bands * rows, rows)(F.col(text)).alias("_s"))
    table = cut_lineage(signed.select("_id", "_class", "_row", "_s.n_units", "_s.bands"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("_first")
    classes = cut_lineage(table.groupBy("_class").agg(first, F.first("n_units").alias("n_units"), F.first("bands").alias("bands")))

    banded = classes.select("_class", "n_units", F.posexplode("bands").alias("band", "hash"))
    bucket = ["band", "hash"]
    counts = banded.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = cut_lineage(banded.join(counts, bucket))
    # The class that shares most buckets with others stands for its buckets.
    shares = shared.groupBy("_class").agg(F.sum("members").alias("shares"))
    heads = shared.join(shares, "_class").groupBy(*bucket).agg(F.max(F.struct("shares", "_class")).alias("head"))
    stars = shared.join(heads, bucket).select(F.col("_class").alias("left"), F.col("head._class").alias("right")).where("left != right")
    links = cut_lineage(_verified(docs, classes, cut_lineage(stars.distinct()), text, size, similarity))
    labels = components(links)

    # Buckets that hold several components after the first step.
    known = shared.drop("members").join(labels.withColumnRenamed("node", "_class"), "_class", "left")
    known = cut_lineage(known.select(*bucket, "_class", "n_units", F.coalesce("label", "_class").alias("part")))
    more = cut_lineage(_across(docs, classes, known, text, size, similarity))
    if more.limit(1).count():
        labels = components(links.union(more))

    placed = classes.join(labels.withColumnRenamed("node", "_class"), "_class", "left").withColumn("_part", F.coalesce("label", "_class"))
    heads = placed.groupBy("_part").agg(F.min("_first").alias("_head"))
    parts = placed.select("_class", "_part", "_first").join(heads, "_part")
    found = table.join(parts, "_class")
    return found.select(
        F.col("_id").alias(order),
        F.col("_head._id").alias("class_id"),
        F.col("_first._id").alias("text_id"),
        "n_units",
        "_class",
        "_row",
        (F.struct(F.col("_id").isNull().alias("none"), "_id", "_row") == F.col("_head")).alias("_keep"),
    )


def one_of_each(docs: DataFrame, order: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of every class: the first by ``order``, then by row fingerprint."""
    kept = near_duplicates(docs, order, text, **options).where("_keep").select("_class", "_row").distinct()
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), *_keys(docs, text))
    return keyed.join(kept, ["_class", "_row"]).dropDuplicates(["_class", "_row"]).select("_doc.*")
