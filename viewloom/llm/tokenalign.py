"""Alignment of two tokenizers by coalescing the byte intervals of their tokens.

Every whole text, with a blank before it, is encoded by A (byte-level pairs) and by B (pieces with byte
fallback). The tokens of both are intervals of bytes. A lexsort puts all intervals of a block of documents in order of
their starts; where a start reaches the running maximum of the ends, a group ends. Pairs of an A and a B token whose
intervals overlap are links; they lie within groups.

How many documents hold a pair of ids linked is counted over the whole corpus: a task reports the different pairs of
a block of documents with their documents, the reports are added up by pair, and every block gets the
counts of its own pairs back. What is shuffled for that are the different pairs of blocks, not links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.session import cut_lineage

BLOCK_BYTES = 2 << 20
#: Longer texts are encoded in parts, cut at single blanks between letters, which no token of either kind spans. The pieces' encoder
#: merges over a whole text, in time that grows faster than the text, hence its shorter parts.
PART, PIECES_PART = 200_000, 1000
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
MAX_VOCABULARY_BYTES = 64 << 20
META = "▁"

_encoders: dict = {}


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def byte_level_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Ids by token bytes of a byte-level vocabulary file, without its special tokens."""
    file = json.loads(vocabulary)
    special = {t["id"] for t in file.get("added_tokens", [])}
    value = byte_of_character()
    return {bytes(value[c] for c in token): i for token, i in file["model"]["vocab"].items() if i not in special}


class Encoder:
    """Both tokenizers, with the bytes of every token and the printed forms of ids."""

    def __init__(self, vocabulary: bytes, pattern: str, pieces: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_level_ranks(vocabulary)
        self.a = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(META, " ").encode()
            for i, p in enumerate(names)
        ]
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("the byte-level vocabulary lacks bytes, so its tokens may not give a text back")
        if any(META in p.lstrip(META) for p in names):
            raise ValueError("pieces hold blanks after other characters, so long texts can't be encoded in parts")
        self.b_bytes = np.array(b_bytes, object)
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes)]
        most = max(len(a_bytes), len(b_bytes))
        width = len(str(most - 1))
        self.digits = np.zeros((most, width + 1), np.uint8)
        for i in range(most):
            s = str(i).encode()
            self.digits[i, : len(s)] = list(s)
        self.size = np.array([len(str(i)) for i in range(most)], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B; both empty if B's bytes aren't those of the blank and the text. A has all bytes, so its tokens are."""
        whole = " " + text
        b = np.concatenate([np.array(x, np.int64) for x in self.b.encode([p[1:] for p in parts_of(whole, PIECES_PART)], num_threads=1)])
        if b"".join(self.b_bytes[b].tolist()) != whole.encode():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a = np.concatenate([self.a.encode_to_numpy(p, disallowed_special=()) for p in parts_of(whole, PART)]).astype(np.int64)
        return a, b


def parts_of(whole: str, size: int) -> list[str]:
    """Parts of a text that begins with a blank, each of ``size`` characters and on to the next cut; each begins with a blank."""
    parts, at = [], 0
    while len(whole) - at > size and (cut := CUT.search(whole, at + size)):
        parts.append(whole[at : cut.start()])
        at = cut.start()
    return [*parts, whole[at:]]


def encoder(vocabulary: bytes, pattern: str, pieces: bytes) -> Encoder:
    """The encoder of two vocabulary files, made once per process."""
    key = (hashlib.sha256(vocabulary).digest(), pattern, hashlib.sha256(pieces).digest())
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary, pattern, pieces)
    return _encoders[key]


def coalesced(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every A and every B interval: unions of overlapping intervals, from left to right."""
    starts, ends = np.concatenate((starts_a, starts_b)), np.concatenate((ends_a, ends_b))
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(breaks)
    return groups[: len(starts_a)], groups[len(starts_a) :]


def overlapping(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B intervals of all overlapping pairs; both sides are in order and don't overlap themselves."""
    first = np.searchsorted(ends_b, starts_a, "right")
    counts = np.searchsorted(starts_b, ends_a, "left") - first
    at = np.repeat(np.arange(len(starts_a)), counts)
    return at, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)


def printed(encoders: Encoder, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, docs: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each of ``docs`` documents; docs[g] is the document of group g."""
    n = len(docs)
    of_a, of_b = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    # A group's A tokens follow all tokens of the groups before it, and its B tokens follow those.
    at_a = np.arange(len(a)) + (np.cumsum(of_b) - of_b)[ga]
    at_b = np.arange(len(b)) + np.cumsum(of_a)[gb]
    ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    ends = np.cumsum(of_a + of_b) - 1
    marks[ends - of_b] = ord("|")
    marks[ends] = ord(";")
    final = np.zeros(len(ids), bool)
    final[ends[np.append(docs[1:] != docs[:-1], True)]] = True
    rows = encoders.digits[ids]
    size = encoders.size[ids]
    rows[np.arange(len(ids)), size] = marks
    length = size + ~final
    flat = rows[np.arange(rows.shape[1])[None, :] < length[:, None]].tobytes().decode("ascii")
    bounds = np.append(0, np.cumsum(length)[final])
    return [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


SCHEMA = """block bigint, at int, key {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string,
  links array<int>, times array<int>, pairs array<bigint>, pair_docs array<int>"""


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def aligned_block(encoders: Encoder, block: int, keys: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """The rows of SCHEMA for some documents. ``links`` are places in the block's ``pairs``, which its first row holds."""
    none = np.zeros(0, np.int64)
    encoded = [encoders.encode(t) if t else (none, none) for t in texts]
    counts = [np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1)]
    a, b = (np.concatenate([e[k] for e in encoded]) for k in (0, 1))
    ends = [np.cumsum(encoders.lengths[k][ids]) for k, ids in enumerate((a, b))]
    starts = [e - encoders.lengths[k][ids] for k, (e, ids) in enumerate(zip(ends, (a, b), strict=True))]
    ga, gb = coalesced(starts[0], ends[0], starts[1], ends[1])
    n, documents = len(texts), np.repeat(np.arange(len(texts)), counts[0])
    n_groups = int(ga[-1]) + 1 if len(ga) else 0
    owner = np.zeros(n_groups, np.int64)
    owner[ga] = documents
    at_a, at_b = overlapping(starts[0], ends[0], starts[1], ends[1])
    pairs, place = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True)
    held, times = np.unique(documents[at_a] * max(1, len(pairs)) + place, return_counts=True)
    holder, place = np.divmod(held, max(1, len(pairs)))
    texts_of = iter(printed(encoders, a, b, ga, gb, owner) if n_groups else [])
    first = np.zeros(n, bool)
    first[:1] = True

    def of_block(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.array([values if f else None for f in first], pa.list_(kind))

    columns = {
        "block": pa.array(np.full(n, block)),
        "at": pa.array(np.arange(n, dtype=np.int32)),
        "key": keys,
        "n_a": pa.array(counts[0]),
        "n_b": pa.array(counts[1]),
        "n_groups": pa.array(np.bincount(owner, minlength=n)),
        "n_links": pa.array(np.bincount(documents[at_a], minlength=n)),
        "groups": pa.array([next(texts_of) if c else "" for c in counts[0]]),
        "links": _lists(place, np.bincount(holder, minlength=n), pa.int32()),
        "times": _lists(times, np.bincount(holder, minlength=n), pa.int32()),
        "pairs": of_block(pairs, pa.int64()),
        "pair_docs": of_block(np.bincount(place, minlength=len(pairs)), pa.int32()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _file(path: str) -> bytes:
    with open(path, "rb") as file:
        found = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(found) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be sent to every task")
    return found


def align(docs: DataFrame, vocabulary_path: str, pattern: str, pieces_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, in blocks: key, n_a, n_b, n_groups, n_links and the groups as text.

    ``vocabulary_path`` and ``pattern`` are A's byte-level vocabulary and its rule of words, ``pieces_path`` is B's model; both
    are files of the driver whose size is checked before they are broadcast. Texts that are null or empty, or whose bytes
    the tokens of A or B don't give back, have no tokens: zeros and an empty text. A null key stays, repeated rows
    are documents of their own; other columns are not returned. A very long text is encoded in parts and is one block.
    The other columns are for ``with_link_counts``; write the result first, since block numbers are those of tasks.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((_file(vocabulary_path), pattern, _file(pieces_path)))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoder(*shared.value)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, "right")))
                texts = batch.column("text").slice(at, to - at).to_pylist()
                yield aligned_block(encoders, (task << 32) + number, batch.column("key").slice(at, to - at), texts)
                at, number = to, number + 1

    return rows.mapInArrow(blocks, SCHEMA.format(key=rows.schema["key"].dataType.simpleString()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, documents, best): documents that hold the pair linked; best if no pair of its A id has more."""
    counts = _reports(aligned).groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = counts.withColumn("a", F.shiftright("pair", 32)).withColumn("b", F.col("pair").bitwiseAND(F.lit(2**32 - 1)))
    counts = cut_lineage(counts)
    # A row per id of a vocabulary at most.
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _reports(aligned: DataFrame) -> DataFrame:
    held = aligned.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    return held.select("block", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").cast("bigint").alias("documents"))


def with_link_counts(aligned: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, *keep) for the written result of ``align``.

    n_best: links whose pair is held by as many documents as any pair of their A id; count_sum: the documents of all links.
    """
    counts = pair_counts(aligned).select("pair", (2 * F.col("documents") + F.col("best").cast("bigint")).alias("told"))
    told = _reports(aligned).select("block", "pair").join(counts, "pair").select(F.col("block").alias("of"), "pair", "told")
    plain = ["key", "n_a", "n_b", "n_groups", "n_links"]
    rows = aligned.select("block", *plain, "links", "times", *keep)

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        values = right.column("told").to_numpy()[np.argsort(right.column("pair").to_numpy(), kind="stable")]
        links, times = (left.column(c).combine_chunks() if left.num_rows else pa.array([], pa.list_(pa.int32())) for c in ("links", "times"))
        if isinstance(links, pa.ChunkedArray):
            links, times = links.chunk(0), times.chunk(0)
        place, often = np.asarray(links.flatten(), np.int64), np.asarray(times.flatten(), np.int64)
        owner = np.repeat(np.arange(left.num_rows), np.asarray(pc.list_value_length(links), np.int64))
        best, total = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)
        if len(place):
            np.add.at(best, owner, often * (values[place] & 1))
            np.add.at(total, owner, often * (values[place] >> 1))
        columns = {c: left.column(c) for c in plain} | {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table(columns | {c: left.column(c) for c in keep})

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*plain, *keep).schema)
    names = names.replace("n_links bigint", "n_links bigint, n_best bigint, count_sum bigint", 1)
    return rows.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(summed, names)
