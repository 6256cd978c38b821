"""Secret scan against a plain regex scan and a plain battery, and its edge cases."""

import math
import random
import re
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from casebook.llm import secret_scan
from casebook.llm.common import prefix_sums

STATED = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def plain(text):
    return sorted((m.start(), k, m.end()) for k, (pattern, group, least) in enumerate(STATED.values())
                  for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least)


RND = random.Random(5)
HEX40 = "".join(RND.choice("0123456789abcdef") for _ in range(40))
B64 = "".join(RND.choice(secret_scan.ENCODINGS["base64"]) for _ in range(64))
TEXTS = [
    None, "", "no secret here", "token=short", "token = 'long_enough.value='", "PassWord:\"abcdefgh\" API_KEY=xyzxyzxyz apikey = 12345678",
    "secret=token=abcdefgh1", "é\U0001f600 token = " + HEX40 + " é", f"xAKIA{'A1' * 6}x AKIA{'B2' * 5} AKIAAKIA{'C' * 12}",
    "a" * 31, "a" * 32, "g" + "0f" * 16 + "g" + "0f" * 15, "token: \n abcdefgh", "token='' secret==abcdefgh",
    " ".join(f"password={i:08d}" for i in range(700)), "\n".join([HEX40] * 300) + "\x0b", "token token=abcdefgh=",
]


def test_base_spans_equal_a_plain_scan(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "`the id` long, `te.xt` string, spans string")
    got = {r["the id"]: r.spans for r in secret_scan.scan(docs, "the id", "te.xt").collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        base = [(s.start, secret_scan.KINDS.index(s.kind), s.end) for s in got[i] if s.kind != "random"]
        assert base == plain(text), (i, text and text[:60])
        assert [(s.start, secret_scan.KINDS.index(s.kind)) for s in got[i]] == sorted(
            (s.start, secret_scan.KINDS.index(s.kind)) for s in got[i])


def brute_battery(token):
    encoding = next((k for k, a in secret_scan.ENCODINGS.items() if set(token) <= set(a)), None)
    if encoding is None:
        return None
    a = secret_scan.ENCODINGS[encoding]
    n, m, v = len(token), len(a), [a.index(c) for c in token]
    squares = sum(token.count(c) ** 2 for c in a)
    limit = NormalDist().inv_cdf(1 - secret_scan.ALPHA / 6)
    narrow = 2 / (9 * (m - 1))
    tests = [((max(m / n * squares - n, 0) / (m - 1)) ** (1 / 3) - (1 - narrow)) / math.sqrt(narrow)]
    halves = [2 * x >= m for x in v]
    ones = sum(halves)
    turns = 2 * ones * (n - ones) / n
    tests.append((1 + sum(x != y for x, y in zip(halves, halves[1:])) - 1 - turns) / math.sqrt(turns * (turns - 1) / (n - 1))
                 if turns > 1 else math.inf)
    mean = sum(v) / n
    spread = sum((x - mean) ** 2 for x in v)
    tests.append((sum((x - mean) * (y - mean) for x, y in zip(v, v[1:])) / spread + 1 / n) * math.sqrt(n) if spread else math.inf)
    inside, two, three = secret_scan.text_model(a)
    pairs = n * (n - 1) / 2
    z = (pairs * two - (squares - n) / 2 - 0.5) / math.sqrt(pairs * two * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two))
    tail = max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)
    return encoding, all(abs(t) <= limit for t in tests), n * math.log10(inside) + math.log10(tail)


def test_the_battery_equals_a_plain_one(spark):
    tokens = [HEX40, B64, HEX40.upper(), "0123456789abcdef" * 4, "ab" * 20 + "1", "thequickbrownfoxjumps0verthelazydog",
              "AAAAAAAAAAAAAAAAAAAAAAAAA2", "A-Z_a-z_0-9_path-to-some-file1", "a+b-c1" * 5]
    tokens += ["".join(RND.choice(a) for _ in range(n)) for a in secret_scan.ENCODINGS.values() for n in (20, 33, 80)]
    rows = spark.createDataFrame([(i, [(5, 5 + len(t), t)]) for i, t in enumerate(tokens)],
                                 "id long, c array<struct<start:long,end:long,found:string>>")
    got = {r.id: r.b for r in rows.select("id", secret_scan.battery(F.col("c")).alias("b")).collect()}
    for i, token in enumerate(tokens):
        want = brute_battery(token)
        if want is None:
            assert got[i] == []
            continue
        (b,) = got[i]
        assert (b.start, b.end, b.encoding, b.random) == (5, 5 + len(token), *want[:2]), token
        assert b.log10_p == pytest.approx(want[2], rel=1e-3, abs=1e-4), token


def test_random_tokens_are_found_and_ordinary_long_words_are_not(spark):
    words = ["https/example-com/path/to/file1", "getUserNameFromContextFactory2", "internationalization_of_the_2nd_kind",
             "aaaaaaaaaaaaaaaaaaaaaaaa1", "0123456789abcdef0123456789abcdef0123456789abcdef", "2020-01-02-report-of-the-year-final-v2"]
    rows = [(i, f"see {w} there") for i, w in enumerate(words)]
    secrets = ["".join(RND.choice(secret_scan.ENCODINGS["base62"]) for _ in range(48)) + "==" for _ in range(30)]
    rows += [(100 + i, f"key {s} end") for i, s in enumerate(secrets)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(s.kind == "random" for i in range(len(words)) for s in got[i])
    hits = [i for i in range(30) if any((s.kind, s.start, s.end) == ("random", 4, 4 + len(secrets[i])) for s in got[100 + i])]
    assert len(hits) >= 28  # three tests at 0.001 in all reject a random one now and then


def test_false_discovery_threshold():
    assert secret_scan.threshold({}, 0.01) is None
    assert secret_scan.threshold({0: 100}, 0.01) is None
    assert secret_scan.threshold({0: 10, 30: 90}, 0.01) == 30
    assert secret_scan.threshold({0: 999_990, 40: 10}, 0.01) is None  # few among very many may be luck
    assert secret_scan.threshold({0: 999_990, 80: 10}, 0.01) == 80


def test_repeated_rows_no_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "token=abcdefgh", 1)] * 2, "doc_id long, text string, kind int")
    got = secret_scan.scan(docs).collect()
    assert [[(s.start, s.end, s.kind) for s in r.spans] for r in got] == [[(0, 14, "assign")]] * 2
    assert secret_scan.scan(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1300])
def test_prefix_sums(spark, n):
    numbers = list(range(1, n + 1))
    df = spark.createDataFrame([(numbers,)], "v array<long>")
    assert prefix_sums(df, "v", "s").first().s == [sum(numbers[:i]) for i in range(n)]
