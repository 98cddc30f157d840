"""Features, fits and statistics against loops over characters and coordinates."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from viewloom.llm import langid, linecrf, secretscan
from viewloom.llm.textbytes import text_blocks

TEXTS = [
    "Der schnelle, braune Fuchs!\nEr springt über den faulen Hund.",
    "été ÉTÉ naïve\n\nİstanbul 東京 x1y2z3",
    "",
    "1234 --- ...",
    "a",
    "THE END\nTHE END\nthe end of the the end\n   \n{}[]<>#=$ %%% code(); x=1;\nword " + "w" * 30,
    "\n\n",
    "\ttabs\tand  blanks \n0123456789 a.b,c;d:e?f!",
]


# Language: n-grams, weights, probabilities


def mixed(x):
    x &= 2**64 - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def ngrams(text, bits):
    """Letters, letters with the letter or border before them or the border after the last, and letters with both neighbours."""
    out = collections.Counter()
    words = [[]]
    for c in text:
        if c.isalpha():
            low = c.lower()
            words[-1].append(ord(low) if len(low) == 1 else ord(c))
        else:
            words.append([])
    for word in words:
        for i, b in enumerate(word):
            a = word[i - 1] if i else 0
            c = word[i + 1] if i + 1 < len(word) else 0
            out[mixed(b) >> 64 - bits] += 1
            out[mixed(a << 42 | b << 21 | 1 << 63) >> 64 - bits] += 1
            out[mixed((a << 42 | b << 21 | c) + 1) >> 64 - bits] += 1
            if not c:
                out[mixed(b << 21 | 1 << 63) >> 64 - bits] += 1
    return out


@pytest.mark.parametrize("bits", [8, 15])
def test_ngrams_are_those_of_the_letters(bits):
    found = [dict(zip(at.tolist(), n.tolist(), strict=True)) for block in text_blocks(pa.array(TEXTS), 40) for at, n in langid.counted(block, 1 << bits)]
    assert found == [dict(ngrams(t, bits)) for t in TEXTS]


def test_weights_follow_the_regularised_leader():
    rng = np.random.default_rng(1)
    features, labels = 12, 3
    rows = []
    for _ in range(60):
        at = np.sort(rng.choice(features, 4, replace=False))
        rows.append((at, rng.random(4), int(at.sum() % labels)))
    alpha, beta, l1, l2 = 0.7, 1.3, 0.8, 0.01
    got = langid.fit_ftrl(rows, features, labels, alpha, beta, l1, l2, epochs=2)
    z, n = collections.Counter(), collections.Counter()

    def weight(i, k):
        own = 0.0 if i == features else l1
        if abs(z[i, k]) <= own:
            return 0.0
        return -(z[i, k] - math.copysign(own, z[i, k])) / ((beta + math.sqrt(n[i, k])) / alpha + l2)

    for _ in range(2):
        for at, x, label in rows:
            values = [*zip(at.tolist(), x.tolist(), strict=True), (features, 1.0)]
            scores = [sum(weight(i, k) * v for i, v in values) for k in range(labels)]
            total = sum(math.exp(s) for s in scores)
            old = {(i, k): weight(i, k) for i, _ in values for k in range(labels)}
            for i, v in values:
                for k in range(labels):
                    g = (math.exp(scores[k]) / total - (k == label)) * v
                    step = (math.sqrt(n[i, k] + g * g) - math.sqrt(n[i, k])) / alpha
                    z[i, k] += g - step * old[i, k]
                    n[i, k] += g * g
    want = [[weight(i, k) for k in range(labels)] for i in range(features + 1)]
    assert np.allclose(got, want, rtol=0, atol=1e-12) and (got == 0).any()


def test_scores_are_softmax_of_tfidf(spark):
    rng = random.Random(3)
    words = {"de": ["der", "und", "nicht", "über"], "en": ["the", "and", "not", "over"], "fr": ["le", "et", "pas", "été"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)), lang) for i, lang in enumerate(list(words) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bits = 10
    model = langid.train(df, "text", "lang", F.col("doc_id").cast("string"), size=1 << bits)
    held = collections.Counter()
    for _, text, _ in rows:
        held.update(ngrams(text, bits).keys())
    want = [math.log((1 + len(rows)) / (1 + held[i])) + 1 for i in range(1 << bits)]
    assert np.allclose(model.idf, want)
    got = {r.text: (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    for _, text, _ in rows[:20]:
        x = {i: (1 + math.log(c)) * want[i] for i, c in ngrams(text, bits).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        logits = [sum(v / norm * model.weights[i, k] for i, v in x.items()) + model.bias[k] for k in range(3)]
        e = [math.exp((s - max(logits)) / model.temperature) for s in logits]
        best = max(range(3), key=lambda k: e[k])
        assert got[text][0] == model.labels[best] and got[text][1] == pytest.approx(e[best] / sum(e), abs=1e-9)


# Lines: features and calibration


def kind(byte):
    c = chr(byte)
    if byte == 10:
        return "feed"
    if c in " \t\x0b\x0c\r":
        return "blank"
    if "A" <= c <= "Z":
        return "upper"
    if "a" <= c <= "z" or byte > 127:
        return "lower"
    if "0" <= c <= "9":
        return "digit"
    return "point" if c in ".,;:?!'\"()-" else "symbol"


def plain_features(text):
    out, seen = [], set()
    for line in text.encode().split(b"\n"):
        kinds = collections.Counter(kind(b) for b in line)
        share = {k: kinds[k] / max(len(line), 1) for k in ("upper", "digit", "blank", "point", "symbol")}
        words = [w for w in re.split(rb"[ \t\x0b\x0c\r]+", line) if w]
        low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
        some = max(len(words), 1)
        out.append(
            [
                *share.values(),
                share["upper"] > 0.5,
                share["symbol"] > 0.04,
                sum(kind(w[-1]) == "symbol" for w in words) / some,
                sum(a == b for a, b in itertools.pairwise(low)) / some,
                1 - len(set(low)) / some,
                sum(len(w) > 25 for w in words) / some,
                min(len(line) / some, 30) / 30,
                math.log1p(len(line)) / 8,
                math.log1p(len(words)) / 6,
                not words,
                len(words) == 1,
                bool(line) and line in seen,
            ]
        )
        seen.add(line)
    return np.array(out, float)


def test_line_features_are_those_of_the_lines():
    for limit in (30, 1 << 20):
        found = []
        for block in text_blocks(pa.array(TEXTS), limit):
            features, weights, bounds = linecrf.line_features(block)
            found += [(features[a:b], weights[a:b]) for a, b in itertools.pairwise(bounds)]
        for text, (features, weights) in zip(TEXTS, found, strict=True):
            assert np.allclose(features, plain_features(text)), text
            assert weights.tolist() == [len(x) + 1 for x in text.encode().split(b"\n")]


def test_neighbours_stay_within_their_text():
    rows = np.arange(1.0, 6.0)[:, None]
    got = linecrf.with_neighbours(rows, np.array([0, 3, 3, 4, 5])).tolist()
    # own, before, after, first, last, constant
    assert got == [[1, 0, 2, 1, 0, 1], [2, 1, 3, 0, 0, 1], [3, 2, 0, 0, 1, 1], [4, 0, 0, 1, 1, 1], [5, 0, 0, 1, 1, 1]]


def test_the_fit_climbs_and_is_calibrated():
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 200)
    lines = [np.clip(rng.normal(0.3 + 0.4 * y, 0.25, (rng.integers(1, 6), linecrf.OWN)), 0, 1) for y in labels]
    chain = linecrf.fit_chain(lines, labels, np.ones(200))

    def loss(theta, pair):
        total = 0.0
        for x, y in zip(lines, labels, strict=True):
            scores = linecrf.with_neighbours((x - chain.mean) / chain.scale, np.array([0, len(x)])) @ theta
            paths = {}
            for path in itertools.product((0, 1), repeat=len(x)):
                paths[path] = sum(s for s, p in zip(scores, path, strict=True) if p) + sum(pair[a][b] for a, b in itertools.pairwise(path))
            top = max(paths.values())
            total += (math.log(sum(math.exp(v - top) for v in paths.values())) + top - paths[(int(y),) * len(x)]) / len(x)
        return total / len(lines)

    best = loss(chain.theta, chain.pair)
    assert best < 0.6 * loss(np.zeros_like(chain.theta), np.zeros((2, 2)))
    assert best < loss(chain.theta * 0.5, chain.pair * 0.5) < loss(-chain.theta, -chain.pair)
    scores = np.array([chain.calibrated(linecrf.raw_quality(chain, x, np.ones(len(x)), np.array([0, len(x)])))[0] for x in lines])
    assert ((scores >= 0.5) == labels).mean() > 0.9 and abs(scores.mean() - labels.mean()) < 0.08


# Random tokens: the statistics


def log_tail(z):
    return min(0.0, -z * z / 2 - math.log(math.sqrt(2 * math.pi)) + math.log(4 / (3 * z + math.sqrt(z * z + 8)))) if z > 0 else 0.0


def plain_battery(token):
    for name, pattern, alphabet, excess, by_chance, in_text in secretscan.ENCODINGS:  # noqa: B007
        if re.match(pattern, token):
            break
    size, n = len(alphabet), len(token)
    folded = token.replace("-", "+").replace("_", "/") if size == 64 else token.lower()
    chi = sum(c * c for c in collections.Counter(folded).values()) * size / n - n
    text_z = ((size - 1) + n * excess - chi) / math.sqrt(2 * (size - 1) + 4 * excess * n)
    part = 2 / (9 * (size - 1))
    even_z = ((max(chi, 0) / (size - 1)) ** (1 / 3) - (1 - part)) / math.sqrt(part)
    if name == "letters":
        kinds = ["v" if c in "aeiou" else "c" for c in folded]
    else:
        kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in folded]
    changes = sum(a != b for a, b in itertools.pairwise(kinds))
    side = 1 if by_chance > in_text else -1
    runs_text = side * (changes - (n - 1) * in_text) / math.sqrt((n - 1) * in_text * (1 - in_text))
    runs_even = (changes - (n - 1) * by_chance) / math.sqrt((n - 1) * by_chance * (1 - by_chance))
    values = [alphabet.index(c) + 1 - (size + 1) / 2 for c in folded]
    xx = sum(v * v for v in values)
    serial = (sum(a * b for a, b in itertools.pairwise(values)) / xx if xx else 1.0) * math.sqrt(n)
    half = -(log_tail(text_z) + log_tail(runs_text))
    score = (half - math.log(1 + half)) * secretscan.GRID
    return score, even_z <= secretscan.TAIL_Z and abs(runs_even) <= secretscan.BOTH_Z and abs(serial) <= secretscan.BOTH_Z


def test_the_battery_equals_loops_over_the_symbols(spark):
    rng = random.Random(6)
    alphabets = [string.digits + "abcdef", string.ascii_lowercase, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/-_"]
    tokens = ["".join(rng.choices(a, k=rng.randrange(16, 90))) for a in alphabets for _ in range(60)]
    tokens += ["internationalization", "some_long_identifier_name", "a" * 40, "0" * 20, "abcdefghijklmnopqrstuvwxyz", "aeiouaeiouaeiouaeiou", "AB" * 12]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = {r.t: (r.b.bin, r.b.random) for r in df.select("t", secretscan.battery(F.col("t")).alias("b")).collect()}
    for t in tokens:
        score, may_be = plain_battery(t)
        # A score next to the border of two bins may fall to either.
        assert got[t][0] in {int(score - 1e-9), int(score + 1e-9)} and got[t][1] == may_be, t
    assert sum(m for _, m in got.values()) > 280


def test_the_threshold_is_the_step_up_procedure(spark):
    rng = random.Random(7)
    bins = [rng.randrange(0, 12) for _ in range(300)] + [rng.randrange(30, 200) for _ in range(40)]
    df = spark.createDataFrame([([(b, True) for b in bins[i::5]],) for i in range(5)], "tokens array<struct<bin: int, random: boolean>>")
    for rate in (0.001, 0.01, 0.2):
        got = secretscan._threshold(df, rate)
        p = sorted(math.exp(-b / secretscan.GRID) for b in bins)
        accepted = max((i + 1 for i, x in enumerate(p) if x <= rate * (i + 1) / len(p)), default=0)
        assert sum(b >= got for b in bins) == accepted
    none = spark.createDataFrame([([],)], "tokens array<struct<bin: int, random: boolean>>")
    assert secretscan._threshold(none, 0.01) == secretscan.BINS + 1
