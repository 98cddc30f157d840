"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are shares of byte classes, repetition and length,
of itself and of its two neighbours. Learning rows have one label per document, which all of their
lines inherit; the chain is fitted by the gradient of its log likelihood (forward-backward), in one
task, on a sample of at most ``sample_rows`` labelled documents. A document's quality is the mean of the
lines' marginals, weighted by length, and calibrated on a fifth of the sample kept aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.frames import TEXT, packed, unpacked
from viewloom.llm.textbytes import BLANK, LINE_FEED, LOWER, SYMBOL, Texts, mix, runs, spans_hash, text_blocks
from viewloom.operators.ranking import top_k

_UPPER, _LOWER, _DIGIT, _BLANK, _POINT, _SYMBOL, _FEED = range(7)
CLASS = np.full(256, _SYMBOL, np.int64)
CLASS[65:91] = _UPPER
CLASS[97:123] = CLASS[128:] = _LOWER
CLASS[48:58] = _DIGIT
CLASS[BLANK] = _BLANK
CLASS[list(b".,;:?!'\"()-")] = _POINT
CLASS[LINE_FEED] = _FEED
OWN = 17  # features of a line itself


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, bounds): a row per line, its length plus one, and the lines of each text."""
    data = texts.data
    ends = np.flatnonzero(data == LINE_FEED)
    starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
    bounds = np.append(np.searchsorted(starts, texts.starts), len(starts))
    n = len(starts)
    size = (ends - starts).astype(np.float64)
    line = np.repeat(np.arange(n), ends - starts + 1)
    shares = np.bincount(line * 8 + CLASS[data], minlength=8 * n).reshape(n, 8) / np.maximum(size, 1)[:, None]

    lower = LOWER[data]
    a, b = runs(~BLANK[data])
    hashes = spans_hash(SYMBOL[lower], a, b)
    at = line[a] if len(a) else np.zeros(0, np.int64)
    words = np.bincount(at, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    again = np.zeros(len(a), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
    distinct = np.unique(mix(hashes + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    marked = np.bincount(at[CLASS[data[b - 1]] == _SYMBOL], minlength=n) if len(a) else np.zeros(n)
    long_words = np.bincount(at[(b - a) > 25], minlength=n)

    # Lines that stand earlier in the same text.
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(bounds))
    keys = mix(spans_hash(SYMBOL[data], starts, ends) + owner * np.uint64(0x9E3779B97F4A7C15))
    repeated = np.ones(n)
    repeated[np.unique(keys, return_index=True)[1]] = 0
    repeated[size == 0] = 0

    features = np.column_stack(
        (
            shares[:, [_UPPER, _DIGIT, _BLANK, _POINT, _SYMBOL]],
            shares[:, _UPPER] > 0.5,
            shares[:, _SYMBOL] > 0.04,
            marked / some,
            np.bincount(at[again], minlength=n) / some,
            1 - np.bincount(at[distinct], minlength=n) / some,
            long_words / some,
            np.minimum(size / some, 30) / 30,
            np.log1p(size) / 8,
            np.log1p(words) / 6,
            words == 0,
            words == 1,
            repeated,
        )
    )
    return features, size + 1, bounds


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before and the line after in the same text, and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    first, last = bounds[:-1][bounds[:-1] < bounds[1:]], bounds[1:][bounds[:-1] < bounds[1:]] - 1
    before[first], after[last] = 0, 0
    edge = np.zeros((len(features), 2))
    edge[first, 0], edge[last, 1] = 1, 1
    return np.column_stack((features, before, after, edge, np.ones(len(features))))


@dataclass
class Chain:
    """Weights of the label "good", log weights of label pairs, and the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    theta: np.ndarray
    pair: np.ndarray
    slope: float
    offset: float

    def emissions(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return with_neighbours((features - self.mean) / self.scale, bounds) @ self.theta

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        raw = np.clip(raw, 1e-6, 1 - 1e-6)
        return _sigmoid(self.slope * np.log(raw / (1 - raw)) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def forward_backward(scores: np.ndarray, bounds: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of "good" over "bad" from each line and those before it, and from those after it.

    All texts advance together, the longest ones longest.
    """
    ahead, back = np.array(scores, np.float64), np.zeros(len(scores))
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    (a00, a01), (a10, a11) = pair
    for t in range(1, int(sizes[0]) if len(sizes) else 0):
        at = starts[: np.searchsorted(-sizes, -t, "left")] + t
        r = ahead[at - 1]
        ahead[at] += np.logaddexp(r + a11, a01) - np.logaddexp(r + a10, a00)
    for t in range(1, int(sizes[0]) if len(sizes) else 0):
        live = np.searchsorted(-sizes, -t, "left")
        at = starts[:live] + sizes[:live] - 1 - t
        s = scores[at + 1] + back[at + 1]
        back[at] = np.logaddexp(a11 + s, a10) - np.logaddexp(a01 + s, a00)
    return ahead, back


def raw_quality(chain: Chain, features: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean marginal of a text's lines, weighted by length."""
    ahead, back = forward_backward(chain.emissions(features, bounds), bounds, chain.pair)
    good = _sigmoid(ahead + back)
    return np.add.reduceat(good * weights, bounds[:-1]) / np.add.reduceat(weights, bounds[:-1])


def fit_chain(
    lines: list[np.ndarray], labels: np.ndarray, shares: np.ndarray, steps: int = 150, rate: float = 0.08, l2: float = 2e-3
) -> Chain:
    """Fit on the lines of documents with their labels; ``shares``: what a document counts."""
    held = np.arange(len(lines)) % 5 == 4
    if len({*labels[held]}) < 2 or len({*labels[~held]}) < 2:
        held[:] = False
    rows = [x for x, h in zip(lines, held, strict=True) if not h]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    features = np.concatenate(rows)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = with_neighbours((features - mean) / scale, bounds)
    sizes = np.diff(bounds)
    gold = np.repeat(labels[~held], sizes).astype(np.float64)
    part = shares[~held] / shares[~held].sum()
    weight = np.repeat(part / sizes, sizes)  # a document counts alike, however many lines it has
    inner = np.ones(len(x), bool)
    inner[bounds[1:] - 1] = False  # lines that a line follows
    inner = np.flatnonzero(inner)
    chain = Chain(mean, scale, np.zeros(x.shape[1]), np.zeros((2, 2)), 1.0, 0.0)
    p = np.concatenate((chain.theta, chain.pair.reshape(-1)))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        theta, pair = p[:-4], p[-4:].reshape(2, 2)
        scores = x @ theta
        ahead, back = forward_backward(scores, bounds, pair)
        g = np.zeros_like(p)
        g[:-4] = x.T @ (weight * (_sigmoid(ahead + back) - gold))
        after = scores[inner + 1] + back[inner + 1]
        logs = np.column_stack(
            (np.full(len(inner), pair[0, 0]), pair[0, 1] + after, ahead[inner] + pair[1, 0], ahead[inner] + pair[1, 1] + after)
        )
        e = np.exp(logs - logs.max(axis=1, keepdims=True))
        e /= e.sum(axis=1, keepdims=True)
        e[:, 0] -= 1 - gold[inner]
        e[:, 3] -= gold[inner]
        g[-4:] = weight[inner] @ e
        g += l2 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    chain.theta, chain.pair = p[:-4], p[-4:].reshape(2, 2)

    # Calibration: a logistic curve on the log odds of the raw quality.
    check = held if held.any() else ~held
    kept = [x for x, h in zip(lines, check, strict=True) if h]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in kept])))
    raw = np.clip(raw_quality(chain, np.concatenate(kept), np.exp(8 * np.concatenate(kept)[:, 12]), bounds), 1e-6, 1 - 1e-6)
    odds, y, w = np.log(raw / (1 - raw)), labels[check].astype(np.float64), shares[check] / shares[check].sum()
    a, b = 1.0, 0.0
    for _ in range(50):
        q = _sigmoid(a * odds + b)
        d = w * (q - y)
        h = w * q * (1 - q)
        hessian = np.array([[h @ (odds * odds) + 1e-3, h @ odds], [h @ odds, h.sum() + 1e-3]])
        da, db = np.linalg.solve(hessian, [d @ odds + 1e-3 * (a - 1), d.sum() + 1e-3 * b])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    chain.slope, chain.offset = float(max(a, 0.05)), float(b)
    return chain


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    sample_rows: int = 6000,
    sample_lines: int = 2000,
) -> Chain | float | None:
    """A chain from the labelled documents; a constant score if one label is missing; None without labels.

    The weights are learnt from at most ``sample_rows`` documents of at most ``sample_lines`` lines, which bounds the one task
    that fits them; longer documents are scored like all others.
    Labels other than 0 and 1 and rows without a key are not learnt from. Of several labels of a
    key the smallest counts, of several texts the smallest.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    there = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct().join(known, "key")
    hashed = there.select("key", "label", F.pmod(F.xxhash64(F.lit(23), "key"), F.lit(1 << 30)).alias("hash"))
    sizes = {r.label: r.n for r in hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = max(1, sample_rows // 2)
    rate = F.coalesce(*[F.when(F.col("label") == k, min(1.0, 2.0 * share / n)) for k, n in sizes.items()])
    near = hashed.where(F.col("hash") < rate * (1 << 30))
    chosen = top_k(near, ["label"], [F.asc("hash"), F.asc("key")], share, "_nth").select("key", "label")
    # At most ``sample_rows`` rows, by the cut above.
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    sample = texts.groupBy("key", "label").agg(F.min("text").alias("text")).select(F.xxhash64(F.lit(29), "key").alias("at"), "label", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in text_blocks(batch.column(2)):
                features, _, bounds = line_features(block)
                out += [features[a:b].astype(np.float32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["at", "label", "lines"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((r["at"], r["label"], r["lines"]) for b in batches for r in b.to_pylist()))
        lines = [np.frombuffer(x, np.float32).reshape(-1, OWN).astype(np.float64) for _, _, x in rows]
        y = np.array([label for _, label, _ in rows])
        drawn = np.bincount(y, minlength=2)
        shares = np.array([sizes.get(k, 0) / max(drawn[k], 1) for k in (0, 1)])[y]
        chain = fit_chain(lines, y, shares) if drawn.all() else None
        flat = [] if chain is None else [*chain.mean, *chain.scale, *chain.theta, *chain.pair.reshape(-1), chain.slope, chain.offset]
        yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.float64()))], ["p"])

    described = sample.mapInArrow(describe, "at bigint, label int, lines binary").where(F.length("lines") <= sample_lines * OWN * 4)
    fitted = described.groupBy(F.lit(0).alias("one")).applyInArrow(fit, "p array<double>").collect()
    p = np.array(fitted[0].p if fitted else [])
    if not len(p):
        return (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    return Chain(p[:OWN], p[OWN : 2 * OWN], p[2 * OWN : -6], p[-6:-2].reshape(2, 2), float(p[-2]), float(p[-1]))


def score(docs: DataFrame, model: Chain | float | None, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted (1 from a score of 0.5 on).

    A null or empty text is one empty line and is scored as such; without a model every score is 0.5.
    Columns of ``docs`` with the names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chain = shared.value
        for column in batches:
            if not isinstance(chain, Chain):
                yield pa.array(np.full(len(column), 0.5 if chain is None else chain))
                continue
            out = [np.zeros(0)]
            for block in text_blocks(column):
                out.append(chain.calibrated(raw_quality(chain, *line_features(block))))
            yield pa.array(np.concatenate(out))

    scored = packed(docs, text).withColumn("_score", F.arrow_udf(rate, "double").asNondeterministic()(F.col(TEXT)))
    return unpacked(scored, docs, text, {"score": F.col("_score"), "predicted": (F.col("_score") >= 0.5).cast("int")})
