"""Periodic runs, whitening and certified packing."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from commentscope.llm import certified_packing as cp
from commentscope.llm import ntt, periodic_runs, queries, whitening
from commentscope.llm.word_tokens import encode_words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- periodic runs --------------------------------------------------------------------------

def plain_runs(x):
    best, n = {}, len(x)
    for d in range(1, n // 4 + 1):
        k = 0
        while k < n - d:
            j = k
            while j < n - d and x[j] == x[j + d]:
                j += 1
            if j > k and j + d - k >= max(6, 4 * d):
                best.setdefault((k, j + d), d)
            k = j + 1
    return sorted((s, e - s, d) for (s, e), d in best.items())


def plain_row(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), math.floor(1000 * best[1] / best[2]) if best else None,
            sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("prime", ntt.PRIMES)
@pytest.mark.parametrize("width", [1, 2, 8, 64])
def test_correlation_is_exact(prime, width):
    draw = np.random.default_rng(width)
    block = draw.integers(0, prime[0], (width, 3)).astype(np.uint64)
    window = draw.integers(0, prime[0], (2 * width, 3)).astype(np.uint64)
    got = ntt.correlation(block, window, *prime)
    for r in range(3):
        for d in range(width):
            assert int(got[d, r]) == sum(int(block[t, r]) * int(window[d + t, r]) for t in range(width)) % prime[0]


words = st.lists(st.integers(0, 2), max_size=40)
repeated = st.builds(lambda a, u, k, b: a + u * k + b, words, words, st.integers(1, 8), words)
nested = st.builds(lambda u, m, v, k: (u * m + v) * k, st.lists(st.integers(0, 1), min_size=1, max_size=4), st.integers(1, 9), words, st.integers(1, 6))


@settings(max_examples=150, deadline=None)
@given(st.lists(words | repeated | nested, min_size=1, max_size=5))
def test_runs_match_plain_search(texts):
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    got = periodic_runs.find_runs(np.array(sum(texts, []), np.int64), bounds)
    want = sorted((int(bounds[i]) + s, int(bounds[i]) + s + l, q) for i, t in enumerate(texts) for s, l, q in plain_runs(t))
    assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def test_large_alphabet_takes_more_primes():
    period = 3000
    ids = np.concatenate([np.arange(20_000, 20_000 + 500), np.tile(np.arange(period) * 6, 5), [1]]).astype(np.int64)
    assert periodic_runs.find_runs(ids, np.array([0, len(ids)])).tolist() == [[500, 500 + 5 * period, period]]


def test_million_words_of_one_kind_and_of_nested_runs():
    one = np.zeros(300_000, np.int64)
    assert periodic_runs.find_runs(one, np.array([0, len(one)])).tolist() == [[0, 300_000, 1]]
    nested_ = np.tile(np.r_[np.zeros(100, np.int64), 1], 2000)
    got = periodic_runs.find_runs(nested_, np.array([0, len(nested_)]))
    assert len(got) == 2001 and [0, len(nested_), 101] in got.tolist()


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@pytest.fixture(scope="module")
def run_rows():
    draw = random.Random(2)
    texts = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "ab ab  ab\tab ab ab ab", "é é é é é é x", "x " * 4000 + "y " * 30 + "x y " * 50]
    texts += [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 300))) for _ in range(60)]
    texts += [" ".join(["p q r s t u v"] * k) for k in (3, 4, 9)]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, "z " * 9, None, None), (None, None, None, None), (-5, "z " * 60, None, None)]


def test_run_digests_match_plain_version(spark, run_rows):
    docs = spark.createDataFrame(run_rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    got = periodic_runs.digest(periodic_runs.collapse_runs(docs, plant=True)).select(*RUN_COLUMNS).collect()
    assert Counter(map(tuple, got)) == Counter(plain_row(r[0], r[1]) for r in run_rows)
    assert sum(r["n_runs"] > 0 for r in got) > 10
    plain = periodic_runs.digest(periodic_runs.collapse_runs(docs)).select(*RUN_COLUMNS).collect()
    assert Counter(map(tuple, plain)) == Counter(plain_row(r[0], r[1], False) for r in run_rows)


def test_collapse_runs_of_other_columns_and_empty_tables(spark, docs, empty, rows):
    got = periodic_runs.collapse_runs(docs).collect()
    assert len(got) == len(rows)
    x = next(r for r in got if r["n_words"] == 300 and r["runs"])
    assert [tuple(r) for r in x["runs"]] == [(0, 300, 1)] and x["collapsed"] == "x"
    assert periodic_runs.digest(periodic_runs.collapse_runs(empty, plant=True)).count() == 0


def test_op11_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_block_convolution_runs"](spark, sf_dir).select(*RUN_COLUMNS).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"] for r in texts if len(r["text"] or "") < 6000}
    assert len(got) == len(texts) and len(short) > 100
    assert {tuple(r) for r in got if r["doc_id"] in short} == {plain_row(r["doc_id"], r["text"]) for r in texts if r["doc_id"] in short}


# ---- whitening ------------------------------------------------------------------------------

def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41), np.r_[[5.0] * 10, [3.0] * 10, [1.0] * 20], np.r_[[5.0] * 6, 5 - 1e-9, 5 - 1e-7, np.ones(20)], 10.0 ** -np.arange(40),
    np.r_[np.ones(3), np.zeros(20)], 1 + np.arange(40) * 1e-4, np.r_[3.0], np.r_[2.0, -1.0, -7.0]])
def test_eigenpairs(values):
    a = spectrum(values)
    a = (a + a.T) / 2
    w, v = whitening.eigenpairs(a, 32)
    want = np.sort(values)[::-1][:32]
    np.testing.assert_allclose(w, want, atol=1e-13 * abs(values).max() * len(values))
    np.testing.assert_allclose(v.T @ v, np.eye(len(want)), atol=1e-12)
    assert np.abs(a @ v - v * w).max() <= 1e-12 * abs(values).max() * len(values)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-4, 4), min_size=1, max_size=9), st.floats(-5, 5), st.integers(0, 99))
def test_inertia_counts_eigenvalues(values, shift, seed):
    a = spectrum(np.array(values, float), seed)
    if min(abs(v - shift) for v in values) > 1e-9:
        assert whitening.below((a + a.T) / 2, shift) == sum(v < shift for v in values)


def test_inertia_with_zero_diagonal():
    a = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]])
    assert whitening.below(a, 0.0) == 1 and whitening.below(np.zeros((4, 4)), 0.0) == 0


def test_whitening_matches_numpy(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 40)) * draw.uniform(0.1, 9, 40) + 50
    good = [(i if i % 50 else None, r.tolist(), "e") for i, r in enumerate(x)]
    good += [good[3], good[3]]
    bad = [(900, None, "e"), (901, [float("nan")] * 40, "e"), (902, [None] + [1.0] * 39, "e"), (903, [float("inf")] * 40, "e"), (904, [1.0] * 39, "e"),
           (905, [], "e"), (906, [1e30] * 40, "e")]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, whitened string").repartition(3)
    got = whitening.whiten(df).collect()
    whole = np.floor(64 * np.array([r[1] for r in good])).astype(np.int64) + 1_000_000
    n, s = len(whole), whole.sum(axis=0)
    covariance = np.cov((whole - s / n).T, bias=True)
    w, q = np.linalg.eigh(covariance)
    w, q = w[::-1][:32], q[:, ::-1][:, :32]
    z = (whole - s / n) @ q / np.sqrt(w)
    deviation = ((n * whole - s) ** 2).sum(axis=1)
    assert len(got) == 32 * n
    by_row = defaultdict(list)
    for i, r in enumerate(good):
        by_row[r[0], int(deviation[i])].append(i)
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == Counter({k: len(v) for k, v in by_row.items()})
    sign = {}
    for r in got:
        k = r["component"] - 1
        want = z[by_row[r["vec_id"], r["deviation"]][0], k]
        if abs(want) > 0.01:
            assert sign.setdefault(k, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
        assert abs(r["whitened"]) == pytest.approx(abs(want), abs=1e-7)
        assert r["n"] == n and r["explained"] == pytest.approx(w[k] / np.trace(covariance), rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_of_few_and_tied_and_huge_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    run = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert run([]) == [] and run([(1, None)]) == []
    one = run([(1, [1.0, 2.0])])
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    # a square: both eigenvalues equal; a constant third entry has eigenvalue zero
    square = run([(i, [a, b, 7.0]) for i, (a, b) in enumerate([(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)])])
    z = np.array([[r["whitened"] for r in square if r["vec_id"] == i and r["component"] < 3] for i in range(4)])
    np.testing.assert_allclose(z.T @ z / 4, np.eye(2), atol=1e-12)
    assert {r["whitened"] for r in square if r["component"] == 3} == {None}
    assert all(r["explained"] == pytest.approx(0.5 if r["component"] < 3 else 0.0) for r in square)
    huge = run([(i, [float(i) * 1e14, 1.0]) for i in range(3)])
    assert all(r["deviation"] is None or r["deviation"] == 0 for r in huge) and len(huge) == 6


# ---- certified packing ----------------------------------------------------------------------

def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def fewest(lengths, capacity):
    """The fewest bins, by search over all placements."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= lengths[i]:
                j = rooms.index(r)
                place(i + 1, rooms[:j] + [r - lengths[i]] + rooms[j + 1:])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 40), st.data())
def test_best_fit_and_bound(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), min_size=1, max_size=60))
    counts = np.bincount(lengths, minlength=capacity + 1)
    runs, bins = cp.best_fit_decreasing(counts, capacity)
    assert bins == plain_best_fit(lengths, capacity)
    bin_, offset = cp._places(runs)
    length = np.concatenate([[r.length] * (r.last - r.first) for r in runs])
    assert length.tolist() == sorted(lengths, reverse=True)
    for b in range(bins):
        own = sorted(zip(offset[bin_ == b].tolist(), length[bin_ == b].tolist()))
        assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])][:-1].tolist() and sum(n for _, n in own) <= capacity
    assert -(-sum(lengths) // capacity) <= cp.lower_bound(counts, capacity) <= bins


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 20), st.data())
def test_bound_is_never_above_the_fewest(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), min_size=1, max_size=8))
    assert cp.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity) <= fewest(lengths, capacity)


def test_word_ids_are_those_of_whole_texts():
    whole = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(6)
    parts = ["a", "B", "é", "é", "́", " ", "  ", "\n", "\t", " ", " ", "'s", "'T", "'", "I'll", "1", "２", ".", " .", "...", "<|endoftext|>", "<|", "|>", "Σ", "ς", "İ", "ﬁ",
             "中", "😀", "\x1c", "\x85", "　", "word", "The", "#", "-", "_", "‍", "K", "Å", "<", ">", "|", "it's", "!"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(20_000)] + ["x" * 5000, "中" * 3000, "don't stop. " * 5000]
    want = whole.encode_batch(texts, add_special_tokens=False)
    assert all(g.tolist() == w.ids for g, w in zip(encode_words(texts, VOCABULARY), want))


def check_packing(got, texts, capacity):
    whole = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for doc, text in texts:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start:start + capacity]
            want[doc, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])][:-1].tolist() and sum(n for _, n in own) <= capacity
    assert {r["n_sequences"] for r in got} == {len(sequences)} and got[0]["lower_bound"] <= len(sequences)
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 100, 4096])
def test_certified_packing(spark, docs, rows, empty, capacity):
    got = cp.pack(docs, VOCABULARY, capacity=capacity).collect()
    check_packing(got, [(r[0], r[1]) for r in rows], capacity)
    assert cp.pack(empty, VOCABULARY, capacity=capacity).count() == 0


def test_blocks_exchange_documents_until_the_bound(spark):
    draw = random.Random(8)
    texts = [(i, "a " * draw.choice([20, 33, 33, 40, 51, 5, 70])) for i in range(700)]
    texts += [(None, "a " * 33)] * 300  # a hot length
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    got = cp.pack(docs, VOCABULARY, capacity=100).collect()
    used = check_packing(got, texts, 100)
    lengths = [len((t or "").split()) + 1 for _, t in texts]
    assert used <= plain_best_fit(lengths, 100) and any(r["sequence_id"] < 0 for r in got)


def test_op13_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_certified_packing"](spark, sf_dir).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_packing(got, texts, 4096)
