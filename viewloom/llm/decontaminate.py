"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The windows of all benchmark items are hashed and broadcast; every document is scanned once, hash
matches are verified on the words themselves, and every word inside a verified window counts as
hit. The broadcast set holds at most ``set_windows`` windows. Of a larger benchmark only a bitmap of hashes is broadcast, of a
bounded size; the few document windows that the bitmap lets through are joined with the benchmark's by their words, so that no
window passes the driver, and the result is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.frames import TEXT, own, packed, unpacked
from viewloom.llm.textbytes import BASE, Texts, mix, spans_hash, text_blocks, window_hashes, words_of
from viewloom.session import cut_lineage

#: Verified matches of one text: word count, first words and lengths of the hit stretches, items.
#: Of the bitmap that stands for a benchmark of more windows than a set may hold: 256 MB at most.
PIECES, PROBES, BITS_PER_WINDOW, MIN_BITS, MAX_BITS = 64, 3, 24, 1 << 16, 1 << 31
#: Words as runs of anything but what isn't part of one.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCAN = "struct<n_words: bigint, at: array<int>, length: array<int>, items: array<string>>"


def benchmark_windows(benchmark: DataFrame, text: str, item: str, size: int) -> DataFrame:
    """(hash, length, words, items): every different window once, with the items that hold it.

    Items without words have no windows; the windows of an item without an id are there, with no item.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for block in text_blocks(batch.column(0)):
                words = words_of(block)
                rows = []
                for i in range(len(block)):
                    a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                    length = min(size, b - a)
                    for w in range(a, b - length + 1 if length else a):
                        rows.append((length, words.text(w, w + length), ids[block.first + i]))
                columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.string())],
                    ["length", "words", "item"],
                )

    items = benchmark.select(F.col(text).alias("text"), F.col(item).cast("string").alias("item"))
    windows = items.mapInArrow(cut, "length int, words binary, item string")
    return windows.groupBy("length", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Windows:
    """All windows, ready for scanning."""

    def __init__(self, rows: list):
        self.items: dict[bytes, list[str]] = {bytes(r.words): list(r["items"]) for r in rows}
        by_length: dict[int, list[bytes]] = {}
        for r in rows:
            by_length.setdefault(r.length, []).append(bytes(r.words))
        self.hashes: dict[int, np.ndarray] = {}
        for length, listed in by_length.items():
            block = next(text_blocks(pa.array([x.decode() for x in listed]), 1 << 40))
            self.hashes[length] = np.unique(window_hashes(words_of(block), length)[0])
        self.shift = np.uint64(64 - max(16, (8 * len(rows)).bit_length()))
        self.seen: dict[int, np.ndarray] = {}
        for length, hashes in self.hashes.items():
            self.seen[length] = np.zeros(1 << (64 - int(self.shift)), bool)
            self.seen[length][hashes >> self.shift] = True

    def scan(self, block: Texts) -> list[tuple]:
        words = words_of(block)
        found: list[tuple[int, int, list[str]]] = []
        for length, hashes in self.hashes.items():
            windows, at = window_hashes(words, length)
            near = np.flatnonzero(self.seen[length][windows >> self.shift])
            near = near[np.isin(windows[near], hashes)]
            for w in at[near]:
                items = self.items.get(words.text(w, w + length))  # the words themselves decide
                if items is not None:
                    found.append((int(w), length, items))
        found.sort(key=lambda x: x[0])
        per_text: list[tuple] = [([], [], set()) for _ in range(len(block))]
        owners = np.searchsorted(words.bounds, [w for w, _, _ in found], "right") - 1
        for (w, length, items), i in zip(found, owners, strict=True):
            at, lengths, names = per_text[i]
            w -= int(words.bounds[i])
            names.update(items)
            if at and w <= at[-1] + lengths[-1]:
                lengths[-1] = max(lengths[-1], w + length - at[-1])
            else:
                at.append(w)
                lengths.append(length)
        counts = np.diff(words.bounds)
        return [(int(n), at, lengths, sorted(names)) for n, (at, lengths, names) in zip(counts, per_text, strict=True)]


def _scanner(spark, rows: list):
    windows = spark.sparkContext.broadcast(_Windows(rows))
    kind = pa.struct(
        [("n_words", pa.int64()), ("at", pa.list_(pa.int32())), ("length", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
    )

    @F.arrow_udf(SCAN)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = [row for block in text_blocks(column) for row in windows.value.scan(block)]
            yield pa.array([dict(zip(("n_words", "at", "length", "items"), r, strict=True)) for r in rows], kind)

    return scan.asNondeterministic()  # so that it is evaluated once, whatever uses its result


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES places of every hash, one row each, all in one piece of the bitmap."""
    piece = np.uint64(bits // PIECES)
    base, x, out = (hashes >> np.uint64(58)) * piece, hashes, []
    for _ in range(PROBES):
        x = mix(x + BASE)
        out.append(base + x % piece)
    return np.array(out).reshape(PROBES, -1)


def _bitmap(windows: DataFrame, bits: int) -> np.ndarray:
    """The packed bitmap of the windows' hashes; its pieces are made by tasks, so only PIECES rows reach the driver."""
    piece = bits // PIECES

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(0).cast(pa.string())):
                words = words_of(block)
                at = np.unique(_probes(spans_hash(words.hashes, words.bounds[:-1], words.bounds[1:]), bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at // piece).astype(np.int32)), pa.array(at)], ["piece", "at"])

    def pack(table: pa.Table) -> pa.Table:
        held = np.zeros(piece, bool)
        number = table.column("piece")[0].as_py()
        held[table.column("at").to_numpy() - number * piece] = True
        return pa.table({"piece": pa.array([number], pa.int32()), "bits": pa.array([np.packbits(held).tobytes()], pa.binary())})

    # A piece's places are distinct, so a task holds no more of them than its piece has bits.
    distinct = windows.select("words").mapInArrow(places, "piece int, at bigint").distinct()
    out = np.zeros((PIECES, piece // 8), np.uint8)
    for row in distinct.groupBy("piece").applyInArrow(pack, "piece int, bits binary").collect():
        out[row.piece] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _near(spark, packed_bits: np.ndarray, bits: int, lengths: list[int]):
    """Of a text: (at, length, words) of the windows that the bitmap lets through."""
    shared = spark.sparkContext.broadcast(packed_bits)
    kind = pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("words", pa.binary())]))

    @F.arrow_udf("array<struct<at: int, length: int, words: binary>>")
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        for column in batches:
            out: list[list[dict]] = [[] for _ in range(len(column))]
            for block in text_blocks(column):
                words = words_of(block)
                for length in lengths:
                    hashes, at = window_hashes(words, length)
                    where = _probes(hashes, bits).astype(np.int64)
                    kept = at[((held[where >> 3] >> (7 - (where & 7)).astype(np.uint8)) & 1).astype(bool).all(axis=0)]
                    owners = np.searchsorted(words.bounds, kept, "right") - 1
                    for w, i in zip(kept.tolist(), owners.tolist(), strict=True):
                        out[block.first + i].append({"at": w - int(words.bounds[i]), "length": length, "words": words.text(w, w + length)})
            yield pa.array(out, kind)

    return near.asNondeterministic()


def _joined_hits(rows: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """``rows`` with _scan as a scan gives it, by a join of the windows that the bitmap lets through."""
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_WINDOW * n).bit_length()))
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # as many as words of a window
    near = _near(rows.sparkSession, _bitmap(windows, bits), bits, lengths)
    # The rows of one text agree, so hits go by the text's fingerprint and not by the row.
    prints = [F.xxhash64(F.col(TEXT)).alias("_a"), F.xxhash64(F.lit(1), F.col(TEXT)).alias("_b")]
    met = cut_lineage(rows.select(*prints, F.explode(near(F.col(TEXT))).alias("w")).select("_a", "_b", "w.*").distinct())
    found = met.join(windows, ["length", "words"])
    hits = found.groupBy("_a", "_b").agg(F.collect_set(F.struct("at", "length")).alias("_pairs"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"))
    merged = hits.select("_a", "_b", "_items", F.explode(F.array(_merged(F.col("_pairs")))).alias("_spans"))
    joined = rows.select("*", *prints).join(merged, ["_a", "_b"], "left")
    none = F.array().cast("array<int>")
    words = F.coalesce(F.regexp_count(F.col(TEXT), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")
    return joined.withColumn(
        "_scan",
        F.struct(
            words.alias("n_words"),
            F.coalesce(F.col("_spans.at"), none).alias("at"),
            F.coalesce(F.col("_spans.length"), none).alias("length"),
            F.array_sort(F.coalesce("_items", F.array().cast("array<string>"))).alias("items"),
        ),
    )


def _joined(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items), 256)


def _merged(stretches: Column) -> Column:
    """Overlapping or touching (at, length) stretches, in order, as one."""
    zero = F.array().cast("array<struct<at: int, length: int>>")

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.coalesce(last["at"] + last["length"], F.lit(-1)) >= x["at"])
        end = F.greatest(last["at"] + last["length"], x["at"] + x["length"])
        grown = F.struct(last["at"].alias("at"), (end - last["at"]).alias("length"))
        return F.when(
            joins, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))
        ).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(stretches), zero, step)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = 13,
    set_windows: int = 200_000,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items, items_sha256, contaminated and hit_spans.

    hit_spans are (at, length) in words. A null or empty text has no words and is clean; an empty
    benchmark hits nothing; an item that stands more than once counts once, one without an id hits and is no item; repeated
    documents are judged one by one. Columns of ``docs`` with the names of results are replaced.
    """
    windows = cut_lineage(benchmark_windows(benchmark, item_text, item, size))
    rows, n = packed(docs, text), windows.count()
    if n <= set_windows:
        scanned = rows.withColumn("_scan", _scanner(docs.sparkSession, windows.collect())(F.col(TEXT)))
    else:
        scanned = _joined_hits(rows, windows, n)
    hit = F.aggregate("_scan.length", F.lit(0).cast("bigint"), lambda total, x: total + x)
    scanned = scanned.withColumn("_hit", hit)
    results = {
        "n_words": F.col("_scan.n_words"),
        "n_hit": F.col("_hit"),
        "n_items": F.size("_scan.items").cast("bigint"),
        "items": F.col("_scan.items"),
        "items_sha256": _joined(F.col("_scan.items")),
        "hit_spans": F.arrays_zip(F.col("_scan.at").alias("at"), F.col("_scan.length").alias("length")),
        "contaminated": (F.col("_hit") > 0) & (20 * F.col("_hit") >= F.col("_scan.n_words")),
    }
    return unpacked(scanned, docs, text, results)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents of ``docs`` that are not contaminated, with their own columns only."""
    rows = packed(docs, text)
    marked = contamination(rows, benchmark, text=TEXT, **options).where(~F.col("contaminated"))
    return marked.select(*[own(c, text).alias(c) for c in docs.columns])


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    listed = spans.to_pylist()
    for block in text_blocks(texts):
        words = words_of(block)
        for i in range(len(block)):
            base, at, kept = int(words.bounds[i]), int(block.starts[i]), []
            for span in listed[block.first + i] or []:
                first, last = base + span["at"], base + span["at"] + span["length"] - 1
                kept.append(block.data[at : words.starts[first]].tobytes())
                at = int(words.ends[last])
            kept.append(block.data[at : block.ends[i]].tobytes())
            out.append(b"".join(kept).decode())
    return pa.array(out, pa.string())


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, with every hit word cut out of their texts and all else left as it is."""
    marked = contamination(packed(docs, text), benchmark, text=TEXT, **options)
    cut = F.when(F.col("n_hit") > 0, F.arrow_udf(_cut, "string")(F.col(TEXT), F.col("hit_spans"))).otherwise(F.col(TEXT))
    return marked.select(*[cut.alias(c) if c == text else own(c, text).alias(c) for c in docs.columns])
