"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

* Features are the one- to three-grams of the letters of a word with its borders, hashed.
* Document frequencies come from all learning rows, in one pass that combines before it shuffles.
* Weights are fitted by follow-the-regularised-leader with L1 and L2 penalties per
  coordinate, in one task, on a sample of at most ``sample_rows`` rows, dealt evenly over the languages.
* A temperature, fitted on a fifth of the sample that the weights never saw, calibrates the scores.
* Every whole text is scored in one pass over the table. Only model-sized data is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.frames import TEXT, packed, unpacked
from viewloom.llm.textbytes import Texts, mix, text_blocks
from viewloom.operators.ranking import top_k

UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other code points; made once per process."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x20000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        # Planes of ideographs have letters only, and no case.
        table[0x20000:0x32000] = np.arange(0x20000, 0x32000)
        _letters.append(table)
    return _letters[0]


def counted(texts: Texts, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, counts) of each text's n-grams; none for a text without a letter."""
    points = letter_table()[np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    heads = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    kept = points != 0
    kept[1:] |= points[:-1] != 0  # one border after each word, the next word begins there too
    at = np.flatnonzero(kept)
    x = np.zeros(len(at) + 2, np.uint64)
    x[1:-1] = points[at]
    inner = np.flatnonzero(x[1:-1]) + 1
    a, b, c = x[inner - 1], x[inner], x[inner + 1]
    shift = np.uint64(64 - (size - 1).bit_length())
    b21 = b << np.uint64(21)
    grams = np.empty((3, len(inner)), np.int64)
    grams[0] = mix(b) >> shift
    grams[1] = mix(a << np.uint64(42) | b21 | np.uint64(1 << 63)) >> shift  # with the letter or border before
    grams[2] = mix((a << np.uint64(42) | b21 | c) + np.uint64(1)) >> shift
    last = np.flatnonzero(c == 0)
    ends = (mix(b21[last] | np.uint64(1 << 63)) >> shift).astype(np.int64)
    owners = heads[texts.starts], heads[texts.ends]
    places = at[inner - 1]
    first, to = np.searchsorted(places, owners[0]), np.searchsorted(places, owners[1])
    first_end, to_end = np.searchsorted(last, first), np.searchsorted(last, to)
    for i in range(len(texts)):
        counts = np.bincount(grams[:, first[i] : to[i]].reshape(-1), minlength=size)
        if first_end[i] < to_end[i]:
            np.add.at(counts, ends[first_end[i] : to_end[i]], 1)
        found = np.flatnonzero(counts != 0)
        yield found, counts[found]


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1.0 + np.log(counts)) * self.idf[at]
        return (x / max(math.sqrt(float(x @ x)), 1e-12)) @ self.weights[at] + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    features: int,
    labels: int,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.002,
    l2: float = 0.0005,
    epochs: int = 3,
) -> np.ndarray:
    """Weights (features + 1, labels), the last row being the bias, which is not penalised."""
    z, n = np.zeros((features + 1, labels)), np.zeros((features + 1, labels))
    l1s = np.append(np.full(features, l1), 0.0)[:, None]

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1s[at], 0.0, -(zs - np.sign(zs) * l1s[at]) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, x, label in rows:
            at, x = np.append(at, features), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1.0
            g = x[:, None] * p[None, :]
            m = n[at] + g * g
            z[at] += g - (np.sqrt(m) - np.sqrt(n[at])) / alpha * w
            n[at] = m
    return weights(np.arange(features + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / math.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    # Within bounds: a sample without errors has no least loss.
    low, high, ratio = math.log(0.25), math.log(8.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def document_frequencies(rows: DataFrame, text: str, size: int) -> tuple[np.ndarray, int]:
    """How many of the rows hold each feature, and how many rows there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for block in text_blocks(batch.column(0)):
                for at, _ in counted(block, size):
                    found[at] += 1
        at = np.flatnonzero(found)
        numbers = np.append(at, -1)  # -1 holds the rows
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(np.append(found[at], n))], ["feature", "n"])

    sums = rows.select(F.col(text)).mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    out, total = np.zeros(size, np.int64), 0
    for feature, n in sums.collect():  # at most ``size`` rows
        if feature < 0:
            total = n
        else:
            out[feature] = n
    return out, total


def train(
    rows: DataFrame,
    text: str,
    lang: str,
    key: Column,
    size: int = 1 << 15,
    sample_rows: int = 6000,
    max_weights: int = 64_000_000,
) -> Model | None:
    """A model from rows with a language, or None without any.

    ``key`` deals rows to the sample; rows whose key is null are not sampled. Every language is learnt, from one row at
    least. A model has ``size`` weights per language; one of more than ``max_weights`` (of 24 bytes each in the one task that
    fits it) is an error.
    """
    most = max_weights // size
    spark = rows.sparkSession
    rows = rows.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), key.alias("key"))
    by_lang = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    if len(by_lang) > most:
        raise ValueError(f"more than {most} languages: the model would have more than {max_weights} weights")
    if not by_lang:
        return None
    labels = sorted(r.lang for r in by_lang)
    share = max(1, sample_rows // len(labels))
    number = {name: i for i, name in enumerate(labels)}
    # At most ``most`` rows, by the check above.
    rates = spark.createDataFrame([(r.lang, min(1.0, 2.0 * share / r.n)) for r in by_lang], "lang string, rate double")
    dealt = rows.where(F.col("key").isNotNull()).select("lang", "key", F.xxhash64(F.lit(17), "key").alias("hash"))
    near = dealt.join(F.broadcast(rates), "lang").where(F.pmod("hash", F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    chosen = top_k(near.distinct(), ["lang"], [F.asc("hash"), F.asc("key")], share, "_nth").select("lang", "key")
    # At most ``sample_rows`` rows, or one per language, by the cut above.
    sample = rows.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))
    found, total = document_frequencies(rows, "text", size)
    idf = np.log((1.0 + total) / (1.0 + found)) + 1.0

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, counts = [], []
            for block in text_blocks(batch.column(2)):
                for a, c in counted(block, size):
                    at.append(a.astype(np.int32))
                    counts.append(c.astype(np.int32))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.string()), pa.array(at, ints), pa.array(counts, ints)],
                ["lang", "key", "at", "counts"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = [r for batch in batches for r in batch.to_pylist()]
        listed.sort(key=lambda r: (hash_of(r["key"]), r["lang"]))
        fitted, held = [], []
        for nth, r in enumerate(listed):
            at, counts = np.asarray(r["at"], np.int64), np.asarray(r["counts"], np.float64)
            if len(at):
                x = (1.0 + np.log(counts)) * idf[at]
                row = (at, x / math.sqrt(float(x @ x)), number[r["lang"]])
                (held if nth % 5 == 4 else fitted).append(row)
        w = fit_ftrl(fitted, size, len(labels))
        logits = np.array([x @ w[at] + w[-1] for at, x, _ in held]).reshape(-1, len(labels))
        temperature = fit_temperature(logits, np.array([y for _, _, y in held], np.int64))
        used = np.append(np.flatnonzero(np.abs(w[:-1]).sum(axis=1)), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), pa.array([*w[used].tolist(), [temperature]], pa.list_(pa.float64()))],
            ["feature", "weights"],
        )

    ready = sample.mapInArrow(featurise, "lang string, key string, at array<int>, counts array<int>")
    fitted = ready.groupBy(F.lit(0).alias("one")).applyInArrow(fit, "feature int, weights array<double>")
    weights, temperature = np.zeros((size + 1, len(labels))), 1.0
    for feature, row in fitted.collect():  # model-sized: at most ``size`` + 2 rows
        if feature < 0:
            temperature = row[0]
        else:
            weights[feature] = row
    return Model(labels, idf, weights[:-1], weights[-1], temperature)


def hash_of(key: str) -> int:
    """An order of the sample that neither follows the keys nor the arrival of the rows."""
    return int(mix(np.array([int.from_bytes(key.encode()[-8:], "little")], np.uint64))[0])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text if there was
    nothing to learn from. Equal scores go to the smaller language code. Columns of ``docs`` with the
    names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in batches:
            out = []
            for block in text_blocks(column):
                for at, counts in counted(block, len(m.idf)) if m else [((), ())] * len(block):
                    if len(at):
                        p = _softmax(m.logits(at, counts) / m.temperature)
                        best = int(p.argmax())
                        out.append({"lang": m.labels[best], "score": float(min(1.0, p[best]))})
                    else:
                        out.append({"lang": UNKNOWN, "score": 0.0})
            yield pa.array(out, kind)

    predicted = F.arrow_udf(score, "struct<lang: string, score: double>").asNondeterministic()
    scored = packed(docs, text).withColumn("_p", predicted(F.col(TEXT)))
    return unpacked(scored, docs, text, {"lang_pred": F.col("_p.lang"), "score": F.col("_p.score")})


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of the key's text falls into the fold; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold
