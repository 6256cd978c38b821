"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def plain(words, least=24, times=3):
    """(start, length, period) of all runs, every period tried."""
    numbers = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = {}
    for q in range(1, len(a) // times + 1):
        steps = np.diff(np.concatenate(([0], (a[:-q] == a[q:]).astype(int), [0])))
        for i, j in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)):
            if j - i + q >= max(least, times * q):
                found.setdefault((int(i), int(j - i + q)), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rnd, n):
    k, out = rnd.choice([1, 2, 3, 6]), []
    while len(out) < n:
        w = [f"w{rnd.randrange(k)}" for _ in range(rnd.randint(1, 14))] * rnd.randint(1, 8)
        if rnd.random() < 0.5:
            w = (w + [f"x{rnd.randrange(k)}"]) * rnd.randint(1, 5)
        out += w[:rnd.randint(1, len(w))]
    return out[:n]


def test_texts_of_a_batch_equal_the_plain_search():
    rnd = random.Random(11)
    docs = [repetitive(rnd, rnd.randint(0, 400)) for _ in range(300)]
    texts = [rnd.choice([" ", "\n ", "\t"]).join(w) + rnd.choice(["", " "]) for w in docs] + [None, "", " \x0b\n"]
    out = periodic_runs.collapse_batch(pa.array(texts)).to_pylist()
    total = 0
    for words, got in zip([*docs, [], [], []], out, strict=True):
        want = plain(words)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
        assert got["collapsed"] == collapsed(words, want)
        total += len(want)
    assert total > 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80), st.integers(3, 12), st.integers(3, 4))
def test_short_runs_of_few_symbols(symbols, least, times):
    _, dense = np.unique(np.array(symbols, np.int64), return_inverse=True)
    got = [tuple(map(int, r)) for r in periodic_runs.find(dense.astype(np.int64), len(symbols), least, times)]
    assert got == plain(symbols, least, times)


@pytest.mark.parametrize("words", [["a"] * 200_000, [f"v{i % 3000}" for i in range(120_000)], [f"u{i}" for i in range(100_000)],
                                   ["a", "b"] * 60_000 + ["c"] + ["b", "a"] * 60_000])
def test_very_long_texts(words):
    (got,) = periodic_runs.collapse_batch(pa.array([" ".join(words)])).to_pylist()
    runs = [(r["start"], r["length"], r["period"]) for r in got["runs"]]
    want = {200_000: [(0, 200_000, 1)], 120_000: [(0, 120_000, 3000)], 100_000: [],
            240_001: [(0, 120_000, 2), (120_001, 120_000, 2)]}[len(words)]
    assert runs == want and got["collapsed"] == collapsed(words, want)


def test_wavelet_tree_counts_and_selects():
    rnd = np.random.default_rng(2)
    values = rnd.permutation(300)
    tree = periodic_runs.WaveletTree(values)
    for _ in range(200):
        a, b = sorted(rnd.integers(0, 301, 2).tolist())
        x = int(rnd.integers(0, 301))
        inside = np.sort(values[a:b])
        one = lambda v: np.array([v], np.int32)
        assert tree.below(one(a), one(b), np.array([x]))[0] == (inside < x).sum()
        if a < b:
            k = int(rnd.integers(0, b - a))
            assert tree.smallest(one(a), one(b), np.array([k]))[0] == inside[k]


def test_suffix_array_ranks():
    rnd = np.random.default_rng(3)
    symbols = rnd.integers(0, 3, 200)
    blocks = periodic_runs.Blocks(np.unique(symbols, return_inverse=True)[1].astype(np.int64), 5)
    for level in range(5):
        width = 1 << level
        whole = [tuple(symbols[i:i + width]) for i in range(200 - width + 1)]
        for i in range(0, len(whole), 7):
            for j in range(0, len(whole), 5):
                assert (whole[i] == whole[j]) == (blocks.ranks[level][i] == blocks.ranks[level][j])


def test_query_equals_the_plain_search_on_planted_documents(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", r.text or "") if x]
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        want[r.doc_id] = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                          hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                          hashlib.sha256(collapsed(w, runs).encode()).hexdigest())
    got = queries.op12_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert sum(w[0] > 0 for w in want.values()) > 10


def test_rows_and_columns_stay(spark):
    docs = spark.createDataFrame([(None, None, "r"), (1, "a " * 30, "r"), (1, "a " * 30, "r")], "id long, `a.b` string, runs string")
    out = docs.withColumn("t", periodic_runs.collapse(F.col("`a.b`")))
    rows = sorted(((r.id, r["t"]["collapsed"], len(r["t"]["runs"])) for r in out.collect()), key=str)
    assert rows == [(1, "a", 1), (1, "a", 1), (None, "", 0)]
    assert out.limit(0).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.collapse(F.col("x"), times=2)
