"""Secret scan: fixed patterns, and a randomness battery over tokens in an encoding.

Patterns.  ``assign``, ``access`` and ``hex`` are leftmost non-overlapping matches of
their regular expression; matches that are too short are dropped afterwards.

Battery.  A candidate is a run of ``[A-Za-z0-9+/_-]`` of 20 or more characters with a
letter and a digit (``=`` padding behind it belongs to the span, not to the tests).  Its
encoding is the smallest alphabet of ``ENCODINGS`` that holds it; a run in none is no
candidate.  Its symbols are tested for what random ones would do:

* chi-squared uniformity over the alphabet (Wilson-Hilferty normal value),
* the number of runs above and below the middle of the alphabet,
* the serial correlation of neighbouring symbols.

A candidate that any test rejects (two-sided, ``ALPHA`` over the three) is no secret.

False discovery.  Short texts pass such tests by luck, so each candidate has a p-value
under "ordinary text": the chance that letters and digits at their usual frequencies stay
inside the alphabet for the whole length and repeat as rarely as here (number of equal
pairs of symbols, with its exact mean and variance at that length).  Benjamini-Hochberg
over all candidates of the input, on a table of p-values by tenths of a decimal power,
gives the threshold at ``fdr``; a span is reported if it is below and no test rejected it.

Everything is DataFrame functions; the scan is one narrow pass, its small result is
written to the checkpoint folder, and only the table of p-values (at most ``BINS`` rows)
reaches the driver.

Defined results: null and empty texts have no span; positions are code points, end
exclusive; kinds may overlap each other; repeated rows are alike; an empty table gives
an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised, prefix_sums, quoted

#: kind: pattern, group whose length counts, least length.  Fixed values.  The least length of
#: ``access`` and ``hex`` is in the pattern, which finds the same: their matches are whole runs.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: Patterns that find a text with a match long enough, to spare the others the search.
LIKELY = {
    "assign": r"(?i:passw|secret|token|api_?key)",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
}
KINDS = [*PATTERNS, "random"]

LEAST = 20
CANDIDATE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{%d})(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])"
             r"[A-Za-z0-9+/_-]+={0,2}" % LEAST)

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: Alphabets, smallest first; the symbols in order of their value.
ENCODINGS = {
    "hex": DIGITS + LOWER[:6], "HEX": DIGITS + UPPER[:6], "base32": UPPER + "234567",
    "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER, "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
#: Letters of English text in per mille, a to z.  Fixed values.
LETTERS = [82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1]
DIGIT_SHARE, CAPITAL_SHARE = 0.10, 0.05

ALPHA = 0.001
FDR = 0.05
#: p-values are counted by tenths of a decimal power, down to 10 ** -(BINS / 10).
BINS = 600


def text_model(alphabet: str) -> tuple[float, float, float]:
    """Ordinary text against an alphabet: share of symbols inside, sums of their squares and cubes there."""
    both = UPPER[0] in alphabet and LOWER[0] in alphabet
    share = {}
    for i, weight in enumerate(LETTERS):
        p = (1 - DIGIT_SHARE) * weight / sum(LETTERS)
        small, large = (1 - CAPITAL_SHARE, CAPITAL_SHARE) if both else (float(LOWER[0] in alphabet), float(UPPER[0] in alphabet))
        share[LOWER[i]], share[UPPER[i]] = p * small, p * large
    share |= {d: DIGIT_SHARE / 10 for d in DIGITS}
    inside = [p for symbol, p in share.items() if symbol in alphabet]
    total = sum(inside)
    return total, sum((p / total) ** 2 for p in inside), sum((p / total) ** 3 for p in inside)


def _spans(docs: DataFrame, name: str, pattern: str, likely: str) -> DataFrame:
    """Column ``name``: array of (start, end, found), by the lengths of what lies between the matches."""
    text, none = F.col("text"), F.array().cast("array<string>")
    has = text.rlike(likely)
    between, found = f"between_{name}", f"found_{name}"
    docs = docs.withColumns({
        between: F.when(has, F.split(text, pattern, -1)).otherwise(none),
        found: F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)})
    docs = docs.withColumn(f"long_{name}", F.transform(
        found, lambda m, i: (F.length(m) + F.length(F.get(F.col(between), i))).cast("long")))
    docs = prefix_sums(docs, f"long_{name}", f"before_{name}")
    return docs.withColumn(name, F.transform(found, lambda m, i: F.struct(
        (F.get(F.col(f"before_{name}"), i) + F.length(F.get(F.col(between), i))).alias("start"),
        (F.get(F.col(f"before_{name}"), i) + F.length(F.get(F.col(between), i)) + F.length(m)).alias("end"),
        m.alias("found")))).drop(between, found, f"long_{name}", f"before_{name}")


def _same(c: Column, *names: str) -> list[Column]:
    return [c[name].alias(name) for name in names]


def _pick(encoding: Column, values: dict) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(encoding == name, F.lit(value)).otherwise(out)
    return out


def _encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, alphabet in reversed(ENCODINGS.items()):
        out = F.when(token.rlike("^[" + alphabet.replace("-", r"\-") + "]+$"), name).otherwise(out)
    return out


def _upper_tail_log10(z: Column) -> Column:
    """log10 of the normal upper tail (Abramowitz and Stegun 7.1.26, fixed values)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    far = F.log10(poly / 2) - x * x * math.log10(math.e)
    return F.when(z >= 0, far).otherwise(F.log10(1 - F.pow(F.lit(10.0), far)))


def battery(candidates: Column) -> Column:
    """Array of (start, end, encoding, random, log10_p) from an array of (start, end, found)."""
    known = F.transform(candidates, lambda c: F.struct(
        *_same(c, "start", "end"), F.rtrim(c["found"], F.lit("=")).alias("token"), _encoding(F.rtrim(c["found"], F.lit("="))).alias("encoding")))
    known = F.filter(known, lambda c: c["encoding"].isNotNull())
    known = F.transform(known, lambda c: F.struct(
        *_same(c, "start", "end", "token", "encoding"), F.length(c["token"]).cast("double").alias("n"),
        _pick(c["encoding"], ENCODINGS).alias("alphabet")))
    known = F.transform(known, lambda c: F.struct(
        *_same(c, "start", "end", "encoding", "n"), F.length(c["alphabet"]).cast("double").alias("m"),
        F.aggregate(F.split(c["alphabet"], ""), F.lit(0.0), lambda total, s: total + F.pow(
            c["n"] - F.length(F.replace(c["token"], s, F.lit(""))), F.lit(2.0))).alias("squares"),
        _halves(c).alias("halves"),
        F.transform(F.split(c["token"], ""), lambda s: F.call_function("instr", c["alphabet"], s).cast("double")).alias("v")))
    known = F.transform(known, lambda c: F.struct(
        *_same(c, "start", "end", "encoding", "n", "m", "squares", "v"),
        F.length(F.replace(c["halves"], F.lit("0"), F.lit(""))).cast("double").alias("ones"),
        (1 + (2 * c["n"] - F.length(F.replace(c["halves"], F.lit("01"), F.lit("")))
              - F.length(F.replace(c["halves"], F.lit("10"), F.lit("")))) / 2).alias("runs"),
        (F.aggregate(c["v"], F.lit(0.0), lambda total, x: total + x) / c["n"]).alias("mean")))
    known = F.transform(known, lambda c: F.struct(
        *_same(c, "start", "end", "encoding", "n", "m", "squares", "runs"),
        (2 * c["ones"] * (c["n"] - c["ones"]) / c["n"]).alias("turns"),
        F.aggregate(c["v"], F.lit(0.0), lambda total, x: total + (x - c["mean"]) * (x - c["mean"])).alias("spread"),
        F.aggregate(F.zip_with(c["v"], F.slice(c["v"], 2, F.size(c["v"])), lambda a, b: (a - c["mean"]) * (b - c["mean"])),
                    F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0))).alias("next")))
    return F.transform(known, _judged)


def _halves(c: Column) -> Column:
    """The token with 0 for symbols of the alphabet's lower half and 1 for the others."""
    marks = {name: "".join("01"[2 * i >= len(a)] for i in range(len(a))) for name, a in ENCODINGS.items()}
    return F.call_function("translate", c["token"], c["alphabet"], _pick(c["encoding"], marks))


def _judged(c: Column) -> Column:
    n, m = c["n"], c["m"]
    limit = NormalDist().inv_cdf(1 - ALPHA / 6)  # three tests, two tails each
    chi = m / n * c["squares"] - n
    narrow = 2 / (9 * (m - 1))
    uniform = (F.pow(F.greatest(chi, F.lit(0.0)) / (m - 1), F.lit(1 / 3)) - (1 - narrow)) / F.sqrt(narrow)
    runs = F.when(c["turns"] > 1, (c["runs"] - 1 - c["turns"]) / F.sqrt(c["turns"] * (c["turns"] - 1) / (n - 1)))
    serial = F.when(c["spread"] > 0, (c["next"] / c["spread"] + 1 / n) * F.sqrt(n))
    ok = [F.coalesce(F.abs(z) <= limit, F.lit(False)) for z in (uniform, runs, serial)]
    models = {name: text_model(a) for name, a in ENCODINGS.items()}
    inside, two, three = (_pick(c["encoding"], {k: v[i] for k, v in models.items()}) for i in range(3))
    pairs, equal = n * (n - 1) / 2, (c["squares"] - n) / 2
    variance = pairs * two * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two)
    log10_p = n * F.log10(inside) + _upper_tail_log10((pairs * two - equal - 0.5) / F.sqrt(variance))
    return F.struct(*_same(c, "start", "end", "encoding"), (ok[0] & ok[1] & ok[2]).alias("random"), log10_p.alias("log10_p"))


def _long_enough(kind: str, order: int) -> Column:
    pattern, group, least = PATTERNS[kind]
    kept = F.filter(kind, lambda s: F.length(F.regexp_extract(s["found"], pattern, group)) >= least)
    return F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end")))


def threshold(counts: dict[int, int], fdr: float) -> int | None:
    """Benjamini-Hochberg on p-values at most 10 ** -(bin / 10): the first bin that is reported, if any."""
    total, above, first = sum(counts.values()), 0, None
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if 10 ** (-b / 10) <= fdr * above / total:
            first = b
    return first


def _bin(log10_p: Column) -> Column:
    return F.least(F.floor(-10 * log10_p), F.lit(BINS)).cast("int")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id_col, spans): array of (start, end, kind) by start, then kind as in ``KINDS``."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    for kind, (pattern, _, _) in PATTERNS.items():
        rows = _spans(rows, kind, pattern, LIKELY[kind])
    rows = _spans(rows, "random", CANDIDATE, CANDIDATE).drop("text")
    base = [_long_enough(kind, order) for order, kind in enumerate(PATTERNS)]
    rows = materialised(rows.select("id", F.concat(*base).alias("base"), battery(F.col("random")).alias("candidates")))
    p = rows.select(F.explode("candidates").alias("c")).groupBy(_bin(F.col("c.log10_p")).alias("bin")).count()
    first = threshold({r["bin"]: r["count"] for r in p.collect()}, fdr)
    found = F.transform(F.filter("candidates", lambda c: c["random"] & (_bin(c["log10_p"]) >= F.lit(first).cast("int"))),
                        lambda c: F.struct(
                            c["start"].alias("start"), F.lit(len(PATTERNS)).alias("kind"), c["end"].alias("end")))
    spans = F.array_sort(F.concat("base", found))
    return rows.select(F.col("id").alias(id_col), F.transform(spans, lambda s: F.struct(
        *_same(s, "start", "end"), F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"))).alias("spans"))
