"""Line deduplication with two Bloom filters, for lines seen once and lines seen twice.

1. Every task puts the lines of its texts into a filter of lines it has seen and one of lines it has
   seen twice, and writes both in pieces. Pieces of the same place are merged one after the other:
   what an earlier piece has already seen goes to "twice". Hot lines are one bit, however frequent.
2. Only lines that the merged "twice" filter suspects are shuffled, as 128-bit fingerprints and
   once per document, and counted exactly.
3. What the counts confirm goes back to the documents that hold it.

The filters are sized by the number of lines (BITS_PER_LINE, a power of two), up to MAX_BITS, 128 MB each, which bounds the
broadcast. A corpus with more lines fills them up: more lines are then suspected and shuffled, up to
all of them, and the result stays the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.frames import OWN, TEXT, own, packed, unpacked
from viewloom.llm.textbytes import BLANK, LINE_FEED, LOWER, SYMBOL, Texts, mix, spans_hash, text_blocks
from viewloom.session import cut_lineage

PIECES = 64
PROBES = 3
SALTS = 32
BITS_PER_LINE, MIN_BITS, MAX_BITS = 12, 1 << 20, 1 << 30
STRIPPED = b" \t\n\x0b\x0c\r"


class Lines:
    """All lines of some texts: bounds of their keys, hashes, and the text they belong to."""

    def __init__(self, texts: Texts):
        data = texts.data
        self.lower = LOWER[data]
        self.ends = np.flatnonzero(data == LINE_FEED)  # every text ends in one
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)).astype(np.int64)
        self.bounds = np.append(np.searchsorted(self.starts, texts.starts), len(self.starts))
        # First and last byte of each line that is not blank.
        full = np.flatnonzero(~BLANK[data])
        first = np.searchsorted(full, self.starts)
        last = np.searchsorted(full, self.ends) - 1
        self.empty = first > last
        some = np.append(full, 0)
        self.key_starts = np.where(self.empty, self.starts, some[first])
        self.key_ends = np.where(self.empty, self.starts, some[np.maximum(last, 0)] + 1)
        self.hashes = spans_hash(SYMBOL[self.lower], self.key_starts, self.key_ends)

    def key(self, i: int) -> bytes:
        return self.lower[self.key_starts[i] : self.key_ends[i]].tobytes()


def fingerprint(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit positions per hash, all within the hash's own piece of the filter."""
    per_piece = np.uint64(bits // PIECES)
    piece = (hashes >> np.uint64(58)) * per_piece
    out, x = [], hashes
    for _ in range(PROBES):
        x = mix(x + np.uint64(0x9E3779B97F4A7C15))
        out.append(piece + x % per_piece)
    return np.concatenate(out)


def _packed(positions: np.ndarray, low: int, size: int) -> bytes:
    bits = np.zeros(size, bool)
    bits[positions - low] = True
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def twice_filter(docs: DataFrame, text: str, min_length: int, bits: int) -> np.ndarray:
    """The packed filter of lines that are seen at least twice, over all documents."""
    size = bits // PIECES

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, twice = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            for block in text_blocks(batch.column(0)):
                lines = Lines(block)
                wanted = lines.hashes[~lines.empty & (_lengths(lines) >= min_length)]
                distinct, counts = np.unique(wanted, return_counts=True)
                seen.append(distinct)
                twice.append(distinct[counts > 1])
            if sum(map(len, seen)) > 1 << 21:  # lines, not texts: a bounded share of the memory
                yield from _pieces(seen, twice, bits)
                seen, twice = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        yield from _pieces(seen, twice, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, twice, piece = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8), None
        for batch in batches:
            for row in batch.to_pylist():
                piece = row["piece"]
                more = np.frombuffer(zlib.decompress(row["seen"]), np.uint8)
                twice |= (seen & more) | np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
                seen |= more
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([twice.tobytes()], pa.binary())], ["piece", "twice"])

    built = docs.select(F.col(text)).mapInArrow(build, "piece int, seen binary, twice binary")
    merged = built.groupBy("piece").applyInArrow(merge, "piece int, twice binary")
    packed = np.zeros((PIECES, size // 8), np.uint8)
    for row in merged.collect():  # PIECES rows of a fixed size
        packed[row.piece] = np.frombuffer(row.twice, np.uint8)
    return packed.reshape(-1)


def _lengths(lines: Lines) -> np.ndarray:
    """Code points of every key: bytes that don't continue a character."""
    heads = np.concatenate(([0], np.cumsum((lines.lower & 0xC0) != 0x80)))
    return heads[lines.key_ends] - heads[lines.key_starts]


def _pieces(seen: list[np.ndarray], twice: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    distinct, counts = np.unique(np.concatenate(seen), return_counts=True)
    repeated = np.union1d(distinct[counts > 1], np.concatenate(twice))
    size = bits // PIECES
    of_seen, of_twice = np.unique(probes(distinct, bits)), np.unique(probes(repeated, bits))
    edges = np.arange(PIECES + 1, dtype=np.uint64) * np.uint64(size)
    a, b = np.searchsorted(of_seen, edges), np.searchsorted(of_twice, edges)
    for p in range(PIECES):
        if a[p] < a[p + 1]:
            low = int(edges[p])
            row = [_packed(x[i[p] : i[p + 1]].astype(np.int64), low, size) for x, i in ((of_seen, a), (of_twice, b))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([row[0]], pa.binary()), pa.array([row[1]], pa.binary())],
                ["piece", "seen", "twice"],
            )


SHARED = pa.struct([("print", pa.binary()), ("share", pa.float64())])


def _suspects(spark, packed: np.ndarray, min_length: int, bits: int, shares: bool = False):
    """UDF: the fingerprints of a text's suspected lines, each once; with ``shares``, and what share of its characters they hold."""
    shared = spark.sparkContext.broadcast(packed)

    def suspects(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for block in text_blocks(column):
                lines = Lines(block)
                at = np.flatnonzero(~lines.empty & (_lengths(lines) >= min_length))
                where = probes(lines.hashes[at], bits).astype(np.int64)
                hit = (shared.value[where >> 3] >> (7 - (where & 7)).astype(np.uint8)) & 1
                at = at[hit.reshape(PROBES, -1).all(axis=0)] if len(at) else at
                owners = np.searchsorted(lines.bounds, at, "right") - 1
                found: list[dict] = [{} for _ in range(len(block))]
                lengths = _lengths(lines)
                for i, owner in zip(at, owners, strict=True):
                    key = fingerprint(lines.key(i))
                    found[owner][key] = found[owner].get(key, 0) + int(lengths[i])
                if shares:
                    ends = np.concatenate(([0], np.cumsum(lengths)))
                    totals = ends[lines.bounds[1:]] - ends[lines.bounds[:-1]]
                    out += [[{"print": k, "share": n / total} for k, n in sorted(x.items())] for x, total in zip(found, totals.tolist(), strict=True)]
                else:
                    out += [sorted(x) for x in found]
            yield pa.array(out, pa.list_(SHARED if shares else pa.binary()))

    kind = "array<struct<print: binary, share: double>>" if shares else "array<binary>"
    return F.arrow_udf(suspects, kind).asNondeterministic()


RESULT = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])


def _drop_lines(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """Texts without the lines whose keys have one of the listed fingerprints."""
    listed, out = drops.to_pylist(), []
    for block in text_blocks(texts):
        for i, (a, b) in enumerate(zip(block.starts, block.ends, strict=True)):
            whole = block.data[a:b].tobytes()
            lines, drop = whole.split(b"\n"), listed[block.first + i]
            kept = lines
            if drop:
                drop = set(drop)
                kept = [x for x in lines if not (key := x.strip(STRIPPED).lower()) or fingerprint(key) not in drop]
            text = whole if len(kept) == len(lines) else b"\n".join(kept)
            out.append({"n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept": text.decode()})
    return pa.array(out, RESULT)


def _row_key() -> list:
    """Two fingerprints of a packed row that don't depend on how often it is read."""
    whole = F.coalesce(F.col(TEXT), F.lit(""))
    return [F.xxhash64(F.to_json(F.col(OWN)), whole).alias("_doc"), F.xxhash64(F.lit(1), whole).alias("_text")]


def filter_bits_of(docs: DataFrame, text: str) -> int:
    """The size of filters for the lines of a table."""
    whole = F.col(text)
    lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    n = docs.agg(F.sum(lines.cast("bigint"))).first()[0] or 0
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * n).bit_length()))


def _suspect_rows(rows: DataFrame, min_length: int, bits: int | None, *more) -> DataFrame:
    """(_doc, _text, print, more...): the suspected lines of every row, written once."""
    bits = bits or filter_bits_of(rows, TEXT)
    packed_filter = twice_filter(rows, TEXT, min_length, bits)
    suspects = _suspects(rows.sparkSession, packed_filter, min_length, bits)
    return cut_lineage(rows.select(*_row_key(), *more, F.explode(suspects(F.col(TEXT))).alias("print")))


def _met(found: DataFrame, lines: DataFrame, how: str = "inner") -> DataFrame:
    """``found`` with the columns of ``lines`` (one row per print), each in SALTS places, for a hot line stands in many documents."""
    salted = lines.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return found.withColumn("salt", F.pmod("_doc", F.lit(SALTS)).cast("int")).join(salted, ["print", "salt"], how).drop("salt")


def _without(docs: DataFrame, rows: DataFrame, text: str, drops: DataFrame) -> DataFrame:
    """Texts without the lines of ``drops`` (_doc, _text, print), which may repeat."""
    per_row = drops.groupBy("_doc", "_text").agg(F.collect_set("print").alias("_drop"))
    joined = rows.select("*", *_row_key()).join(per_row, ["_doc", "_text"], "left")
    drop = F.arrow_udf(_drop_lines, "struct<n_lines: bigint, n_dropped: bigint, kept: string>").asNondeterministic()
    done = joined.withColumn("_done", drop(F.col(TEXT), F.col("_drop")))
    results = {"n_lines": F.col("_done.n_lines"), "n_dropped": F.col("_done.n_dropped"), "kept_text": F.col("_done.kept")}
    return unpacked(done, docs, text, results)


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = 10,
    min_length: int = 1,
    filter_bits: int | None = None,
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text.

    Lines whose key (stripped of white space, A-Z lower-cased, at least ``min_length`` code points)
    stands in at least ``min_docs`` documents lose all their occurrences. Documents are rows: a
    repeated row counts each time. A null or empty text is one empty line, which is never dropped.
    Columns of ``docs`` with the names of results are replaced.
    """
    if min_docs < 2:
        raise ValueError("a repeated line stands in two documents at least")
    rows = packed(docs, text)
    found = _suspect_rows(rows, min_length, filter_bits)
    # Counting combines before the shuffle, so a hot line is a few rows per task.
    frequent = found.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("print")
    # Each confirmed line meets its documents in SALTS places, for a hot one stands in many of them.
    salted = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    drops = found.withColumn("salt", F.pmod("_doc", F.lit(SALTS)).cast("int")).join(salted, ["print", "salt"])
    return _without(docs, rows, text, drops)


def keep_first_lines(docs: DataFrame, order: str, text: str = "text", min_length: int = 1, filter_bits: int | None = None) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text: a line of several documents stays in the first by ``order``.

    Within a document its occurrences stay together. Nulls of ``order`` come first, ties go to the smaller row
    fingerprint, and equal rows count as one document.
    """
    rows = packed(docs, text)
    found = _suspect_rows(rows, min_length, filter_bits, own(order, text).alias("at"))
    place = F.struct("at", "_doc", "_text")
    first = found.groupBy("print").agg(F.min(place).alias("first"))
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = found.withColumn("salt", F.pmod("_doc", F.lit(SALTS)).cast("int")).join(salted, ["print", "salt"])
    return _without(docs, rows, text, met.where(~place.eqNullSafe(F.col("first"))))


def drop_common_lines(
    docs: DataFrame,
    order: str,
    text: str = "text",
    min_docs: int = 10,
    min_length: int = 1,
    copied: float = 0.5,
    filter_bits: int | None = None,
) -> DataFrame:
    """Like ``drop_repeated_lines``, but what copied documents are made of stays once.

    A document is a copy if lines of at least ``min_docs`` documents hold the share ``copied`` of its characters or
    more. Copies with the same set of such lines are a group, whatever other lines they have; the first of a group of
    several by ``order`` (nulls first, ties go to the smaller row fingerprint; equal rows are one) keeps all its lines,
    also those that other groups have as well. So every group keeps one whole document. A line that stands in copies, but in no
    document that is kept whole, stays in the first copy. All other occurrences of such lines go.
    """
    if min_docs < 2:
        raise ValueError("a repeated line stands in two documents at least")
    rows = packed(docs, text)
    filter_bits = filter_bits or filter_bits_of(rows, TEXT)
    packed_filter = twice_filter(rows, TEXT, min_length, filter_bits)
    suspects = _suspects(rows.sparkSession, packed_filter, min_length, filter_bits, shares=True)
    lines = rows.select(*_row_key(), own(order, text).alias("at"), F.explode(suspects(F.col(TEXT))).alias("line"))
    found = cut_lineage(lines.select("_doc", "_text", "at", "line.print", "line.share"))
    frequent = found.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("print")
    met = cut_lineage(_met(found, frequent))
    of_row = met.groupBy("_doc", "_text").agg(F.min("at").alias("at"), F.collect_set(F.struct("print", "share")).alias("lines"))
    held = F.aggregate(F.col("lines.share"), F.lit(0.0), lambda total, x: total + x)
    place = F.struct("at", "_doc", "_text")
    prints = F.array_sort("lines.print")
    group = [F.xxhash64(F.lit(i), prints.cast("string")).alias(f"g{i}") for i in (0, 1)]
    copies = cut_lineage(of_row.where(held >= copied).select(place.alias("place"), *group, prints.alias("prints")))
    groups = copies.groupBy("g0", "g1").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = copies.join(groups.select(F.col("first").alias("place")), "place", "left_semi")
    whole = cut_lineage(kept.select("place.*", F.explode("prints").alias("print")))
    rest = copies.select("place", F.explode("prints").alias("print")).join(whole.select("print").distinct(), "print", "left_anti")
    first = rest.groupBy("print").agg(F.min("place").alias("first"))
    drops = _met(met, first, "left").where(~place.eqNullSafe(F.col("first")))
    same = [drops[c].eqNullSafe(whole[c]) for c in ("_doc", "_text", "print")]
    return _without(docs, rows, text, drops.join(whole, same, "left_anti"))
