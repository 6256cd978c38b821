"""Toxicity, mixing and nearest neighbours: held-out accuracy, brute force and edge cases."""

import math
import re
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import hnsw, mixing, toxicity

# ---------------------------------------------------------------------- toxicity
INSULTS = ["blorgface", "snivelrat", "grumbtoad"]


def _corpus(spark, n=1500):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rnd.choice('bcdfgh')}{rnd.choice('aeiou')}{rnd.randrange(90)}" for _ in range(40)]
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words[rnd.randrange(40)] = "you " + rnd.choice(INSULTS) + rnd.choice(["", "!", "ish"])
        rows.append((i, " ".join(words), "src", i))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, score string, toxic long"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


@pytest.fixture(scope="module")
def corpus(spark):
    return _corpus(spark)


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_held_out_accuracy(corpus, model):
    docs, labels = corpus
    got = toxicity.scored(docs, model).select("row.doc_id", "score").join(labels, "doc_id").withColumn(
        "fold", toxicity.fold(F.col("doc_id"))).where("fold = 0").collect()
    assert len(got) > 200
    right = sum((r.score >= 0.5) == bool(r.toxic) for r in got)
    assert right / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_labels_are_never_learnt(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in toxicity.score(docs, flipped).collect()}
    assert one == two


def test_clean_documents_stay_whole(spark, corpus, model, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: model)
    odd = spark.createDataFrame([(None, None, "a", 1), (None, "", "a", 1), (7777, "calm words " * 60_000, "a", 1)], docs.schema)
    kept = toxicity.clean_documents(docs.unionAll(odd).unionAll(odd), labels)
    assert kept.columns == docs.columns
    rows = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert rows[None] == 4 and rows[7777] == 2
    assert sum(i % 6 == 0 for i in rows if i not in (None, 7777)) < 15
    assert sum(i % 6 != 0 for i in rows if i not in (None, 7777)) > 1230


def test_without_labels_nothing_is_rejected(spark, corpus):
    docs, labels = corpus
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        got = toxicity.score(docs.limit(5), few).collect()
        assert [r.score for r in got] == [0.0] * 5 and not any(r.predicted for r in got)
    assert toxicity.score(docs.limit(0), labels).collect() == []


def test_features_see_the_whole_text_and_masked_words():
    machine = toxicity._automaton({"idiot": 5.0})
    f = dict(zip(toxicity.FEATURES, toxicity.features_of("word " * 100_000 + "YOU IDIOT!!!", machine), strict=True))
    assert f["hits"] > 0 and f["near_second_person"] > 0 and f["exclamations"] > 0
    masked = dict(zip(toxicity.FEATURES, toxicity.features_of("such an 1d10t and i.d.i.o.t", machine), strict=True))
    assert masked["masked_hits"] == 2 or masked["masked_hits"] == 1
    assert toxicity.features_of(None, machine) == toxicity.features_of("", machine)


def test_texts_that_open_alike_teach_their_own_terms(spark):
    head = "this notice opens every single document of the one hot source "
    toxic = [f"{head} part{i} you are a blorgface" for i in range(6)]
    clean = [f"calm words number{i} of a quiet text" for i in range(200)] + [f"{head} entry{i} is calm" for i in range(200)]
    rows = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in clean], "text string, toxic int")
    learnt = toxicity.learn_lexicon(rows, 100)
    assert any("blorgface".startswith(t) for t in learnt)
    assert toxicity.learn_lexicon(rows.repartition(7).unionAll(rows), 100) == learnt  # copies and row order change nothing


# ------------------------------------------------------------------------ mixing
def _sources(spark, sizes, words=30):
    rows = [(i * 1000 + k, " ".join(f"t{k}x{j}" for j in range(words)), s, 1)
            for i, (s, n) in enumerate(sizes.items()) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")


def _brute_exponent(tokens, budget, target, most):
    n = sum(tokens)
    p = [x / n for x in tokens]

    def weights(t):
        z = sum(x ** t for x in p)
        return [x ** t / z for x in p]

    def entropy(t):
        return -sum(w * math.log(w) for w in weights(t))

    def repeats(t):
        return max(w * budget / x for w, x in zip(weights(t), tokens, strict=True))

    def bisect(ok, rising):
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            if ok(mid) != rising:
                low = mid
            else:
                high = mid
        return high if rising else low

    t = 1.0 if entropy(1.0) >= target * math.log(len(p)) else bisect(lambda x: entropy(x) >= target * math.log(len(p)), False)
    return t if repeats(t) <= most else bisect(lambda x: repeats(x) <= most, True)


@pytest.mark.parametrize("target, most", [(0.9, 100.0), (0.999, 100.0), (0.999, 2.5), (0.5, 4.0)])
def test_exponent_equals_plain_bisection(spark, target, most):
    tokens = [90_000, 20_000, 3_000, 500]
    sources = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(tokens)], "source string, tokens long")
    got = mixing.exponent(sources, sum(tokens), target, most)
    assert got == pytest.approx(_brute_exponent(tokens, sum(tokens), target, most), abs=1e-7)


@pytest.fixture(scope="module")
def mixed(spark):
    docs = _sources(spark, {"big": 600, "mid": 90, "small": 20})
    old, mixing.MIN_BLOCK_TOKENS = mixing.MIN_BLOCK_TOKENS, 600
    try:
        out = mixing.realise(docs, target_entropy=0.97, max_repeats=6.0).collect()
        plan = mixing.plan(docs, "doc_id", "text", "source", target_entropy=0.97, max_repeats=6.0).collect()
    finally:
        mixing.MIN_BLOCK_TOKENS = old
    return docs, out, plan


def test_budgets_are_met_to_a_document(mixed):
    _, out, plan = mixed
    budget = {r.plan_source: r.budget for r in plan}
    tokens = Counter()
    for r in out:
        tokens[r.source] += r.n_tokens
    assert sum(r for r in {r.plan_source: r.weight for r in plan}.values()) == pytest.approx(1.0)
    for s, b in budget.items():
        assert b - 30 < tokens[s] <= b


def test_epochs_are_whole_permutations_but_the_last(mixed):
    docs, out, _ = mixed
    size = Counter(r.source for r in docs.collect())
    seen = {}
    for r in out:
        seen.setdefault((r.source, r.epoch), []).append(r)
    for (source, epoch), rows in seen.items():
        assert len({r.doc_id for r in rows}) == len(rows) <= size[source]
        if (source, epoch + 1) in seen:
            assert len(rows) == size[source]
    # the last epoch stops inside one block: every block before it in the permutation is whole
    whole = Counter((r.source, r.block) for r in seen[("big", 0)]) if ("big", 1) in seen else None
    last = max(e for s, e in seen if s == "small")
    blocks = Counter(r.block for r in seen[("small", last)])
    assert blocks and (whole is None or whole)


def test_mixed_documents_keep_columns_and_match(spark, mixed):
    docs, out, _ = mixed
    old, mixing.MIN_BLOCK_TOKENS = mixing.MIN_BLOCK_TOKENS, 600
    try:
        rows = mixing.mixed_documents(docs, target_entropy=0.97, max_repeats=6.0)
        assert rows.columns == docs.columns
        assert Counter(r.doc_id for r in rows.collect()) == Counter(r.doc_id for r in out)
    finally:
        mixing.MIN_BLOCK_TOKENS = old


def test_equal_rows_fill_the_budget_to_a_document(spark):
    same = [(1, "a b c d e f g h i j", s, k) for s in ("x", None) for k in range(300)]
    other = [(100 + k, f"t{k} " * 10, s, k) for s in ("x", None) for k in range(600)]
    docs = spark.createDataFrame(same + other, "doc_id long, text string, source string, lang int").repartition(5)
    half = {"budget": 9_000, "target_entropy": 0.5}
    for seed in (1, 2, 3, 4):  # the equal rows lie before, behind and on the end of the budget
        out = mixing.realise(docs, seed=seed, **half).collect()
        plan = mixing.plan(docs, "doc_id", "text", "source", seed=seed, **half).collect()
        spent = Counter()
        for r in out:
            spent[r.source] += r.n_tokens
        assert {r.plan_source: r.budget for r in plan} == {"x": 4_500, None: 4_500}
        assert all(4_490 < spent[s] <= 4_500 for s in ("x", None)), (seed, spent)
        assert max(Counter((r.source, r.doc_id) for r in out if r.doc_id != 1).values()) == 1
    rows = mixing.mixed_documents(docs, seed=seed, **half)
    assert rows.columns == docs.columns
    assert Counter((r.source, r.doc_id) for r in rows.collect()) == Counter((r.source, r.doc_id) for r in out)
    # only equal rows, in one source that is sampled below one epoch
    only = docs.filter("doc_id = 1 AND source = 'x'")
    assert len(mixing.realise(only, budget=1_234).collect()) == 123


def test_mixing_of_nulls_empty_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, None, 0), (2, "", "e", 0), (3, "a b c", "x", 0), (3, "a b c", "x", 0), (None, "d e f", None, 0)],
                                 "doc_id long, text string, source string, block int")
    out = mixing.realise(docs).collect()
    assert Counter((r.doc_id, r.source) for r in out if not r.n_tokens)[(2, "e")] == 1
    assert mixing.realise(docs.limit(0)).collect() == []
    only = docs.where("source = 'e'")
    assert [r.doc_id for r in mixing.realise(only).collect()] == [2]
    one = _sources(spark, {"only": 7})
    assert sorted(r.doc_id for r in mixing.realise(one).collect()) == list(range(7))


def test_no_source_loses_a_token_at_exponent_one(spark):
    rnd = np.random.default_rng(8)
    for _ in range(6):
        counts = rnd.integers(1, 10**9, 20)
        total = int(counts.sum())
        rows = spark.createDataFrame([(f"s{i}", int(n), float(n / total)) for i, n in enumerate(counts)], "s string, tokens long, weight double")
        assert all(r.tokens == r.b for r in rows.withColumn("b", mixing._own_budget(1.0, total, total)).collect())
        half = rows.withColumn("b", mixing._own_budget(1.0, total // 2, total)).collect()
        assert all(r.b == r.tokens * (total // 2) // total for r in half)


def test_a_whole_budget_keeps_every_document(spark):
    docs = _sources(spark, {"big": 300, "mid": 60, "small": 9})
    out = mixing.realise(docs, budget=mixing.WHOLE, target_entropy=0.97, max_repeats=5.0).collect()
    seen = Counter((r.source, r.doc_id) for r in out)
    assert len(seen) == 369 and all(n == 1 for (s, _), n in seen.items() if s == "big")
    tokens = Counter()
    for r in out:
        tokens[r.source] += r.n_tokens
    counts = [9000, 1800, 270]
    t = mixing.exponent(spark.createDataFrame(list(zip("bms", counts)), "source string, tokens long"), None, 0.97, 5.0)
    assert 0 < t < 1
    for source, n in zip(("big", "mid", "small"), counts):
        want = 9000 * (n / 9000) ** t
        assert want - 31 <= tokens[source] <= want + 1
    assert max(seen.values()) <= 6  # five repeats at most, the last of them in part


def test_registered_mixture_meets_its_plain_budgets(spark):
    from casebook.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    words = Counter()
    longest = 0
    for r in docs:
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w])
        words[r.lang] += n
        longest = max(longest, n)
    total = sum(words.values())
    t = _brute_exponent(list(words.values()), total, mixing.TARGET_ENTROPY, mixing.MAX_REPEATS)
    norm = sum((n / total) ** t for n in words.values())
    out = queries.op6_mixing(spark, "/root/testdata/sf0.001").collect()
    spent, epochs = Counter(), Counter()
    for r in out:
        spent[r.lang] += r.n_tokens
        epochs[r.lang] = max(epochs[r.lang], r.epoch)
    assert 0 < t < 1 and max(epochs.values()) >= 1  # small languages repeat
    size = Counter(r.lang for r in docs)
    assert any(0 < sum(r.lang == s and r.epoch == e for r in out) < size[s] for s, e in epochs.items())  # an epoch in part
    for lang, n in words.items():
        budget = (n / total) ** t / norm * total
        assert budget - longest - 1 <= spent[lang] <= budget + 1


# -------------------------------------------------------------- nearest neighbours
def _nearest(ids, data, every, k):
    out = {}
    for i, x in zip(ids, data, strict=True):
        if i % every == 0:
            far = np.sqrt(((data - x) ** 2).sum(axis=1))
            out[i] = sorted((float(d), j) for d, j in zip(far, ids, strict=True) if j != i)[:k]
    return out


def test_recall_against_brute_force_over_shards(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(1500, 24)).astype(np.float32)
    ids = list(range(1500))
    rows = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, data, strict=True)], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in hnsw.nearest(rows, every=25, shard_rows=400).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = _nearest(ids, data.astype(np.float64), 25, 10)
    assert set(got) == set(want)
    hit = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        hit += len({m[1] for m in mine} & {j for _, j in best})
        exact = dict((j, d) for d, j in best)
        for _, j, s in mine:
            if j in exact:
                assert s == pytest.approx(exact[j], abs=1e-12)
    assert hit / (10 * len(want)) >= 0.95


@pytest.mark.parametrize("change", [lambda x: x + 1e4, lambda x: x * 1e20, lambda x: x * 1e-25,
                                    lambda x: np.where(np.arange(len(x))[:, None] % 2 == 0, x, 1e6 + x)])
def test_recall_far_from_the_origin_and_at_any_scale(spark, change):
    rng = np.random.default_rng(4)
    data = change(rng.normal(size=(900, 16)))
    ids = list(range(900))
    rows = spark.createDataFrame([(i, v.tolist(), i) for i, v in zip(ids, data, strict=True)], "vec_id long, embedding array<double>, `rank.x` int")
    got = {}
    for r in hnsw.nearest(rows, every=30, shard_rows=300).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = _nearest(ids, data, 30, 10)
    assert sum(len(got[q] & {j for _, j in best}) for q, best in want.items()) >= 0.95 * 10 * len(want)


def test_many_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 400)] + [(500, [1.0, 3.0]), (600, [0.0, 0.0]), (700, [nan, 1.0]), (800, [inf, 1.0]),
                                                      (900, None), (None, [1.0, 2.0]), (1000, [1.0, None]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 300, 500}
    assert [v for v, _ in got[0]] == list(range(1, 11))
    assert [v for v, _ in got[100]] == list(range(10))
    assert got[500] == [(i, 1.0) for i in range(10)]


def test_an_id_with_many_vectors_takes_one_place(spark):
    rows = [(0, [0.0, 1.0])] + [(1, [0.001 * j, 1.0]) for j in range(1, 301)] + [(10 + i, [1.0 + i, 1.0]) for i in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in hnsw.nearest(df).orderBy("rank").collect()]
    assert [(rank, i) for _, rank, i, _ in got] == [(1, 1), *((n + 2, 10 + n) for n in range(9))]
    assert got[0][3] == pytest.approx(0.001)


def test_fewer_candidates_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [5.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in hnsw.nearest(df).collect()] == [(0, 1, 1, 1.0)]
    assert hnsw.nearest(df.limit(0)).collect() == []
