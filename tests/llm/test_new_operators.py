"""Tokenizer alignment, whitening and the n-gram join against plain versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import FOLDER
from viewloom.llm import countjoin, tokenalign, whitening
from viewloom.llm.queries import QUERIES, vocabulary

# 11 alignment


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")[0])


def plain_alignment(rows):
    """{key: digest columns} from the tokenizers themselves, token by token."""
    a, b = tokenizers()
    value = tokenalign.byte_of_character()
    token = {i: bytes(value[c] for c in w) for w, i in a.get_vocab().items() if i != 50256}
    found, held = {}, collections.Counter()
    for key, text in rows:
        want = (" " + (text or "")).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        pieces = b.encode(text) if text else []
        names = [b.id_to_piece(i) for i in pieces]
        ta = [token[i] for i in ids]
        tb = [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(pieces, names, strict=True)]
        if not text or b"".join(ta) != want or b"".join(tb) != want:
            found[key] = None
            continue
        ends = [list(itertools.accumulate(map(len, t))) for t in (ta, tb)]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            first = i, j
            while i < len(ids) and ends[0][i] <= cut:
                i += 1
            while j < len(pieces) and ends[1][j] <= cut:
                j += 1
            groups.append(",".join(map(str, ids[first[0] : i])) + "|" + ",".join(map(str, pieces[first[1] : j])))
            for p, q in itertools.product(range(first[0], i), range(first[1], j)):
                if max(ends[0][p] - len(ta[p]), ends[1][q] - len(tb[q])) < min(ends[0][p], ends[1][q]):
                    links.append((ids[p], pieces[q]))
        found[key] = len(ids), len(pieces), len(groups), links, ";".join(groups)
        held.update(set(links))
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = {}
    for key, f in found.items():
        out[key] = (0, 0, 0, 0, 0, 0, "")
        if f is not None:
            links = f[3]
            digest = hashlib.sha256(f[4].encode()).hexdigest()
            out[key] = (*f[:3], len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest)
    return out


HARD = [
    " ",
    "a▁b",
    "<|endoftext|> x <s> </s> <unk> <0x41> \u0000 \U0001f600 été",
    "word " * 60_000,
    "x" * 250_000,
    "\n\n  a \t b  ",
    "don't we'll IT'S 123456 ... !!! ünïcödé 漢字 かな",
    "é ‍   ﻿",
]


def test_alignment_equals_the_tokenizers(spark, documents, edges, tmp_path):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(10**6 + i, t) for i, t in enumerate([None, "", *HARD])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_tokenizer_alignment"](spark, str(tmp_path)).collect()}
    assert got == plain_alignment(rows)


def test_alignment_of_edges_and_clashing_names(spark, clashing):
    pieces, _ = vocabulary("piece_bpe_32k.model")
    found = tokenalign.align(clashing.withColumnRenamed("doc_id", "pairs"), *vocabulary("byte_bpe_50k.json"), pieces, key="pairs").collect()
    assert sorted(str(r.key) for r in found) == sorted(str(r.doc_id) for r in clashing.collect())
    assert all((r.n_a, r.n_b, r.n_groups, r.n_links, r.groups) == (0, 0, 0, 0, "") for r in found if r.key in (1, 2, 3))
    assert all(r.n_a > 0 for r in found if r.key in (5, 6, 7, 8))


def test_a_long_text_is_the_same_in_parts(monkeypatch):
    encode = tokenalign.encoder(open(vocabulary("byte_bpe_50k.json")[0], "rb").read(), vocabulary()[1], open(vocabulary("piece_bpe_32k.model")[0], "rb").read()).encode
    text = " ".join(random.Random(3).choice(["some", "words", "1 2", "it's", "a\nb", "  two  blanks ", "é è", "."]) for _ in range(5000))
    monkeypatch.setattr(tokenalign, "PIECES_PART", 10**9)
    whole = encode(text)
    monkeypatch.setattr(tokenalign, "PART", 50)
    for size in (1, 50, 1000):
        monkeypatch.setattr(tokenalign, "PIECES_PART", size)
        assert all(len(x) == len(y) and (x == y).all() for x, y in zip(whole, encode(text), strict=True))
    assert "".join(tokenalign.parts_of(" " + text, 30)) == " " + text and tokenalign.parts_of(" x", 30) == [" x"]


def test_every_token_and_character_is_encoded_as_by_the_vocabulary_file():
    """The byte pair encoder that is used merges by rank; it agrees with merge rules where every token gives itself."""
    a, _ = tokenizers()
    assert all([t.id for t in a.model.tokenize(w)] == [i] for w, i in a.get_vocab().items() if i != 50256)
    fast = tokenalign.encoder(open(vocabulary("byte_bpe_50k.json")[0], "rb").read(), vocabulary()[1], open(vocabulary("piece_bpe_32k.model")[0], "rb").read()).a
    points = [c for c in itertools.chain(range(1, 0x3000), range(0x3000, 0x110000, 37)) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}a 1{chr(c)}1 {chr(c)} !{chr(c)}! \n{chr(c)}  {chr(c)}a" for c in points]
    assert [e.ids for e in a.encode_batch(texts, add_special_tokens=False)] == [fast.encode_ordinary(t) for t in texts]


# 12 whitening


def plain_whitening(vectors, k=32):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(k, int((values > 1e-9 * values.sum()).sum()))
    return x, n, values, (centred @ axes[:, :kept]) / np.sqrt(values[:kept])


def hold(rows, keys, vectors, k=32, distinct=True):
    x, n, values, projected = plain_whitening(vectors, k)
    assert len(rows) == projected.size
    place = {key: i for i, key in enumerate(keys)}
    found = np.zeros_like(projected)
    exact = ((n * x.astype(object) - x.sum(axis=0)) ** 2).sum(axis=1)
    for r in rows:
        found[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == exact[place[r.vec_id]] and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
    if distinct:
        assert np.abs(np.abs(found) - np.abs(projected)).max() < 1e-6
        assert np.abs(np.abs((found * projected).mean(axis=0)) - 1).max() < 1e-9  # one sign for all rows
    else:
        # Within equal eigenvalues components may turn; the distances of rows don't.
        assert np.abs(found @ found.T - projected @ projected.T).max() < 1e-6


def test_whitening_equals_the_eigenvectors(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = QUERIES["op12_embedding_whitening"](spark, FOLDER).collect()
    data = {r.vec_id: r.embedding for r in df.collect()}
    hold(rows, list(data), list(data.values()))


VECTORS = "vec_id long, embedding array<double>, label int, component int, whitened double, n string"


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, 0.5, "own") for i, v in enumerate(vectors)], VECTORS)


@pytest.mark.parametrize("kind", ["few columns", "repeated values", "low rank", "constant columns", "apart"])
def test_whitening_of_special_shapes(spark, kind):
    rng = np.random.default_rng(1)
    if kind == "few columns":
        data = rng.normal(size=(200, 3))
    elif kind == "repeated values":
        # All eigenvalues are equal: every sign of every axis.
        data = np.concatenate((np.eye(6), -np.eye(6))) * 4.0
    elif kind == "low rank":
        data = np.round(rng.normal(size=(60, 2)) * 8) @ np.array([[1, 0, 2, 0, 1], [0, 1, 0, 3, 1]], float)
    elif kind == "constant columns":
        data = np.column_stack((rng.normal(size=100), np.full(100, 2.5), rng.normal(size=100)))
    else:
        data = rng.normal(size=(300, 6)) * np.array([1000, 100, 10, 1, 0.5, 30])
    df = table_of(spark, data.tolist())
    hold(whitening.whiten(df).collect(), range(len(data)), data, distinct=kind not in ("repeated values", "low rank") or kind == "low rank")


def test_whitening_of_unusable_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [[float(i % 7), float(i * i % 5)] for i in range(20)]
    bad = [None, [None, 1.0], [nan, 1.0], [1.0, inf], []]
    rows = whitening.whiten(table_of(spark, good + bad)).collect()
    hold(rows, range(20), good)
    repeated = whitening.whiten(table_of(spark, good).withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert len(repeated) == 40 and all(r.vec_id is None and r.n == 20 for r in repeated)
    assert whitening.whiten(table_of(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whiten(table_of(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(table_of(spark, bad)).count() == 0
    two = whitening.whiten(table_of(spark, [*good, *[[float(i), 1.0, 2.0 * i] for i in range(9)]])).collect()
    assert collections.Counter(r.n for r in two) == {20: 40, 9: 9}


def test_deviations_are_exact_or_fail():
    centre = whitening.Centre(10**6, np.array([5], np.int64), np.array([-(10**5)], np.int64))
    x = np.array([[5], [2 * 10**3]], np.int64)
    assert centre.deviations(x).tolist() == [10**10, (10**6 * (2 * 10**3 - 5) + 10**5) ** 2]
    with pytest.raises(OverflowError):
        centre.deviations(np.array([[10**7]], np.int64))


# 13 n-gram join


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def plain_components(rows):
    members = collections.defaultdict(list)
    for key, text in rows:
        members[shingles(text)].append(key)
    sets = sorted((s for s in members if s), key=len)
    root = {s: s for s in sets}

    def top(s):
        while root[s] != s:
            s = root[s]
        return s

    links = 0
    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            if 100 * len(a) < 85 * len(b):
                break
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                root[top(a)] = top(b)
                links += 1
    groups = collections.defaultdict(list)
    for s in sets:
        groups[top(s)] += members[s]
    out = []
    for key, text in rows:
        s = shingles(text)
        keys = [k for k in groups[top(s)] if k is not None] if s else []
        out.append((key, len(s), min(keys) if keys else key if not s else None))
    return out, links


def texts(seed, bases, edits):
    """Texts with copies of few edits, many of them near the threshold, and a passage that a third of them share."""
    rng = random.Random(seed)
    vocabulary_ = [f"w{i}" for i in range(500)]
    passage = rng.choices(vocabulary_, k=60)
    rows = []
    for base in range(bases):
        words = rng.choices(vocabulary_, k=rng.choice([1, 2, 3, 4, 5, 8, 12, 20, 40, 80, 200, 600]))
        if base % 3 == 0:
            words += passage
        for _ in range(rng.choice([1, 2, 5, 9])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, int(edits * len(words))))):
                at, how = rng.randrange(len(copy)), rng.random()
                if how < 0.4:
                    copy[at] = rng.choice(vocabulary_)
                elif how < 0.7:
                    copy.insert(at, rng.choice(vocabulary_))
                elif len(copy) > 1:
                    del copy[at]
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.1 else "\t".join(copy)))
    return rows


@pytest.mark.parametrize("seed,bits,sent", [(1, 64, 10**6), (2, 3, 0)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, bits, sent):
    monkeypatch.setattr(countjoin, "SENT_KEYS", sent)
    rows = texts(seed, 70, 0.02) + [(10**6 + i, t) for i, t in enumerate([None, "", " \n\t", "A b", "a B", "x" * 200_000, "y " * 50_000])]
    rows += [(None, "of no key"), (None, "A b"), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, links = plain_components(rows)
    assert links > 50
    got = [tuple(r) for r in countjoin.linked_components(df, bits=bits).collect()]
    assert collections.Counter(got) == collections.Counter(want)


def test_chunks_and_trees_lose_no_link(spark, monkeypatch):
    """No head is compared, so all links come from trees over pairs of small chunks."""
    rows = texts(3, 40, 0.015)
    monkeypatch.setattr(countjoin, "CHUNK_MEMBERS", 3)
    monkeypatch.setattr(countjoin, "SMALL", 2)
    monkeypatch.setattr(countjoin, "_verified", lambda pairs, sets, nodes, rule: pairs.where("false"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want, _ = plain_components(rows)
    assert sorted(tuple(r) for r in countjoin.linked_components(df).collect()) == sorted(want)


def test_join_on_clashing_names(spark, clashing):
    df = clashing.withColumn("node", F.lit(1)).withColumn("sig", F.lit(2)).withColumn("n", F.lit("x"))
    found = countjoin.linked_components(df).collect()
    want, _ = plain_components([(r.doc_id, r.text) for r in clashing.collect()])
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, want))


def test_linked_sets_share_a_signature():
    """Every pair at the threshold, of any size, has a signature in common."""
    rng = np.random.default_rng(5)
    rule = countjoin.Threshold(85)
    for size in [1, 2, 5, 6, 7, 8, 9, 13, 19, 28, 41, 100, 333, 1000, 6000]:
        for larger in {size, int(rule.largest_partner(size)), int(rule.largest_partner(size) + size) // 2}:
            overlap = int(rule.needed(size + larger))
            if overlap > size:
                continue
            for _ in range(40 if size < 500 else 4):
                drawn = rng.integers(0, 2**63, size + larger, dtype=np.uint64)
                a, b = drawn[:size], np.concatenate((drawn[:overlap], drawn[size : size + larger - overlap]))
                owners = np.repeat([0, 1], [len(a), len(b)])
                text, sig = countjoin.signatures(owners, np.concatenate((a, b)), 2, 85)
                assert set(sig[text == 0].tolist()) & set(sig[text == 1].tolist())


def near_points(rows=400, groups=128):
    rng = np.random.default_rng(2)
    vectors = rng.poisson(3, size=(rows, groups))
    half = rows // 2
    vectors[half:] = np.maximum(vectors[:half] + rng.integers(-1, 2, size=(half, groups)) * (rng.random((half, groups)) < 0.1), 0)
    return vectors


def bounded_pairs(vectors, rule):
    sizes = vectors.sum(axis=1)
    bound = np.minimum(vectors[:, None, :], vectors[None, :, :]).sum(axis=2)
    return {(int(i), int(j)) for i, j in np.argwhere(bound >= rule.needed(sizes[:, None] + sizes[None, :]))}


def test_tree_finds_all_points_within_the_bound():
    vectors, rule = near_points(), countjoin.Threshold(85)
    q, p = countjoin.CountTree(vectors).search(vectors, rule, at_once=100_000)
    want = bounded_pairs(vectors, rule)
    assert {(int(i), int(j)) for i, j in zip(q, p, strict=True)} == want and len(want) > 500


@pytest.mark.parametrize("members", [2, 7, 48, 400])
def test_shards_of_any_size_give_the_same_pairs(members):
    vectors, rule = near_points(), countjoin.Threshold(85)
    rng = np.random.default_rng(members)
    order, parts, chunks = rng.permutation(400), rng.integers(0, 30, 400), np.zeros(400, np.int64)
    bounds = np.append(np.arange(0, 400, members), 400)
    odd = np.arange(400) // members % 2 == 1
    chunks[odd] = rng.integers(0, 2, int(odd.sum()))
    vectors = vectors[order]
    shards = countjoin.Shards(
        bounds, np.full(len(bounds) - 1, 7), chunks, parts, vectors.sum(axis=1), [zlib.compress(v.astype(np.uint8).tobytes()) for v in vectors]
    )
    got = {(int(min(i, j)), int(max(i, j))) for i, j in zip(*countjoin.across(shards, rule), strict=True)}
    want = set()
    for i, j in bounded_pairs(vectors, rule):
        both = i // members == j // members and i < j and parts[i] != parts[j]
        whole = len(set(chunks[i // members * members : (i // members + 1) * members].tolist())) == 1
        if both and (whole or chunks[i] != chunks[j]):
            want.add((i, j))
    assert got == want


def test_points_fold_to_every_level():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    owners = np.repeat([0, 2], [4900, 100])
    fine, none, coarse = countjoin.points(owners, tokens, 3, 85)
    assert none == b"" and len(countjoin.folded(fine, 60)) == 8192 and len(countjoin.folded(coarse, 60)) == 256
    hashes = countjoin.mix(tokens * countjoin.OTHER + countjoin.GOLDEN)
    for level in (6, 7, 10, 13):
        assert (countjoin.folded(fine, level) == np.bincount((hashes[:4900] % np.uint64(2**level)).astype(int), minlength=2**level)).all()


@pytest.mark.parametrize("most", [1, 300, 10**9])
def test_whole_shards_are_kept_together(monkeypatch, most):
    import pyarrow as pa

    monkeypatch.setattr(countjoin, "POINT_BYTES", most)
    sig = np.sort(np.random.default_rng(1).integers(0, 40, 500))
    table = pa.table(
        {"sig": sig, "low": np.zeros(500, np.int32), "high": np.zeros(500, np.int32), "v": np.arange(500), "point": pa.array([b"0123456789"] * 500, pa.binary())}
    )
    parts = list(countjoin.whole_shards(iter(table.to_batches(max_chunksize=17))))
    assert sum(p.num_rows for p in parts) == 500
    seen = [set(p.column("sig").to_pylist()) for p in parts]
    assert all(not a & b for a, b in itertools.combinations(seen, 2))
    assert [v for p in parts for v in p.column("v").to_pylist()] == list(range(500))
