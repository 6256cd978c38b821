"""Collocations against a plain count of all phrases, with few slots, few shards, and edge cases."""

import random
import re
from collections import Counter

import pytest

from casebook.llm import collocations

MARKS = "[.,;:!?\n\x0b\x0c\r]"


def plain(rows, least, longest=5, top=2000):
    f, n, out = {}, Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        counts = f.setdefault(lang, Counter())
        for piece in re.split(MARKS, low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            counts.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * a >= 100 * often.get(p[i:j], 1 << 60)}
        ranked = []
        for p, a in often.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(9)
    phrases = [" ".join(f"p{i}x{j}" for j in range(rnd.randint(2, 7))) for i in range(25)]
    rows = []
    for _ in range(500):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts.append(rnd.choice(phrases) if rnd.random() < 0.4 else f"W{rnd.randrange(60)}")
            parts.append(rnd.choice([" ", " ", "\t", ", ", ".", "\n", " \x0b"]))
        rows.append(("".join(parts), rnd.choice(["en", "en", "en", "de", None])))
    rows += [("a a a a a a a a a", "en")] * 20 + [(None, "en"), ("", None), (" ,. ", "xx"), ("é É  x É", "fr")]
    return rows


def _mined(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "text string, lang string")
    return sorted(tuple(r) for r in collocations.mine(docs, **kw).collect())


@pytest.mark.parametrize("kw", [
    dict(min_count=6), dict(min_count=2, shards=2, top=40), dict(min_count=5, n_slots=64, shards=3, longest=4)])
def test_equals_a_plain_count(spark, corpus, kw):
    got = _mined(spark, corpus, **kw)
    assert got and got == plain(corpus, kw["min_count"], kw.get("longest", 5), kw.get("top", 2000))


def test_small_batches_and_one_partition_per_row(spark, corpus):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old, held = spark.conf.get(key), collocations.HELD
    spark.conf.set(key, "7")
    try:
        docs = spark.createDataFrame(corpus, "text string, lang string").repartition(5)
        got = sorted(tuple(r) for r in collocations.mine(docs, min_count=8, shards=3).collect())
    finally:
        spark.conf.set(key, old)
    assert got == plain(corpus, 8)


def test_exact_products_beyond_64_bits(spark):
    big = 10 ** 12
    df = spark.createDataFrame([(7 * 10 ** 11, big, [9 * 10 ** 11, 7 * 10 ** 11], [8 * 10 ** 11, 7 * 10 ** 11])],
                               "n long, total long, heads array<long>, tails array<long>")
    r = df.select(collocations._lowest_cut(2).alias("c")).first().c
    assert r.score == 1000 * 7 * 10 ** 11 * big // (9 * 10 ** 11 * 8 * 10 ** 11) and r.cut == 1


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([("x y x y x y", "en", 1, 2)], "`te.xt` string, la string, n int, score int")
    got = [tuple(r) for r in collocations.mine(docs, "te.xt", "la", min_count=3, shards=2).collect()]
    assert got == plain([("x y x y x y", "en")], 3)
    assert collocations.mine(docs.limit(0), "te.xt", "la", shards=2).collect() == []
    with pytest.raises(ValueError):
        collocations.mine(docs, "te.xt", "la", n_slots=100)
