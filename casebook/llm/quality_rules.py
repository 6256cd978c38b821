"""Quality rules per document with a verdict per host (native).

Each text gets counts (words, their characters, symbols, repeated lines,
words inside repeated three-word windows) and a rule verdict.  Failures are
summed by host, each host's rate is shrunk towards the corpus rate with a
beta prior fitted to the host rates (method of moments), and the host verdict
is joined back to its documents.

Defined results
---------------
* null text: no words, every count 0, so it fails the word minimum;
* null host: the null host is a host like any other (null-safe join);
* repeated rows: each row is scored and counted on its own;
* one host, or hosts with equal rates: the prior cannot be told from the data,
  every host takes the corpus rate, and none exceeds its limit unless that rate is over 0.8;
* empty table: empty result;
* extra columns, also such as clash with the result names: ignored by
  ``score`` and returned untouched by ``kept_documents``.

A three-word window is compared by a chained 64-bit hash of its words inside
one text only; for a text of 20,000 words the chance of one false match is
about 1e-11.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, materialised, small_side, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when its shrunk failure rate is beyond what the prior lets hosts vary by: so many
#: standard deviations above the corpus rate, but never below or above these rates.
DEVIATIONS = 2.0
MIN_HOST_RATE, MAX_HOST_RATE = 0.5, 0.8
#: The prior weighs at least so many documents: one failure does not condemn a host.
MIN_PRIOR = 2.0


def _repeat_words(w: Column, n: Column, grams: Column) -> Column:
    """Words covered by windows that occur twice or more (first included).

    Windows are sorted with their positions; equal neighbours are repeats.
    Texts without a repeat, told by a hash set, skip the sort.
    """
    tagged = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(rows: Column) -> Column:
        # pairs of neighbours with one hash: both positions are in a repeat
        last = F.slice(rows, 1, F.size(rows) - 1)
        pairs = F.zip_with(last, F.slice(rows, 2, F.size(rows) - 1), lambda a, b: F.when(
            a["g"] == b["g"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
        hits = F.flatten(F.filter(pairs, lambda p: p.isNotNull()))
        return F.size(F.array_distinct(hits))

    # the lambda names the sorted array once, so it is not sorted per use
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
        F.element_at(F.transform(F.array(tagged), covered), 1)).cast("long")


def rule_counts(docs: DataFrame, text: str, keep: list[Column], only_verdict: bool = False) -> DataFrame:
    """``keep`` columns plus the counts and ``base_failed`` of every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(*keep, t.alias("__t")).withColumn("__w", words(F.col("__t")))
    w, n = F.col("__w"), F.size("__w")
    grams = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("__g", grams)
    lines = F.filter(F.split("__t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counts = {"n_words": n.cast("long"), "n_repeat_words": _repeat_words(w, n, F.col("__g"))}
    if not only_verdict:
        step = step.withColumn("__l", lines)
        counts |= {
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.regexp_count("__t", F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        }
    names = [c for c in step.columns if not c.startswith("__")]
    step = step.select(*names, *[v.alias(k) for k, v in counts.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return step.withColumn("base_failed", failed)


def host_rates(rows: DataFrame, host: str = "host", deviations: float = DEVIATIONS,
               rates: tuple[float, float] = (MIN_HOST_RATE, MAX_HOST_RATE)) -> DataFrame:
    """(host, n, fails, rate, most): failure rates shrunk by an empirical beta prior, and the limit.

    With host rates p of mean m and variance v (weighted by documents), the
    prior holds k = m(1-m)/v - 1 documents (MIN_PRIOR at least), m of them failed;
    a host's rate is (fails + k m) / (n + k).  k is unbounded for v = 0: then the
    rate is m.  The limit is m plus ``deviations`` standard deviations of the prior,
    sqrt(m(1-m) / (k+1)), within ``rates``: a host falls when most of its documents fail, and
    more than hosts of this corpus differ by.
    """
    hosts = materialised(rows.groupBy(host).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("fails")))
    p = F.col("fails") / F.col("n")
    total = hosts.agg(F.sum("fails").alias("fails"), F.sum("n").alias("n"),
                      F.sum(F.col("n") * p * p).alias("squares")).first()
    if not total["n"]:
        return hosts.withColumns({"rate": F.lit(None).cast("double"), "most": F.lit(rates[1])})
    mean = total["fails"] / total["n"]
    variance = total["squares"] / total["n"] - mean * mean
    low, high = rates
    if variance <= 1e-12:
        return hosts.withColumns({"rate": F.lit(mean), "most": F.lit(min(max(mean, low), high))})
    k = max(mean * (1 - mean) / variance - 1, MIN_PRIOR)
    most = min(max(mean + deviations * math.sqrt(mean * (1 - mean) / (k + 1)), low), high)
    return hosts.withColumns({"rate": (F.col("fails") + k * mean) / (F.col("n") + k), "most": F.lit(most)})


def rejected_hosts(rows: DataFrame, deviations: float = DEVIATIONS,
                   rates: tuple[float, float] = (MIN_HOST_RATE, MAX_HOST_RATE)) -> DataFrame:
    """(bad_host): the hosts whose shrunk failure rate exceeds the limit."""
    return materialised(host_rates(rows, "host", deviations, rates).filter(F.col("rate") > F.col("most"))
                        .select(F.col("host").alias("bad_host")))


def _without(rows: DataFrame, bad: DataFrame, host: Column) -> tuple[DataFrame, Column]:
    """``rows`` joined to the rejected hosts, and the condition "not rejected"."""
    side = small_side(bad.withColumn("__bad", F.lit(True)),
                      F.coalesce(F.length("bad_host"), F.lit(0)) * 4 + 32)
    return rows.join(side, host.eqNullSafe(F.col("bad_host")), "left"), F.col("__bad").isNull()


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          deviations: float = DEVIATIONS, rates: tuple[float, float] = (MIN_HOST_RATE, MAX_HOST_RATE)) -> DataFrame:
    """doc_id, the five counts, base_failed, host_rejected, kept; one row per row."""
    rows = materialised(rule_counts(docs, text, [
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host")]))
    joined, fine = _without(rows, rejected_hosts(rows, deviations, rates), F.col("host"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & fine).alias("kept"), (~fine).alias("host_rejected"))


def kept_documents(docs: DataFrame, text: str = "text", host: str = "source",
                   deviations: float = DEVIATIONS,
                   rates: tuple[float, float] = (MIN_HOST_RATE, MAX_HOST_RATE)) -> DataFrame:
    """The rows of ``docs``, all columns, that pass their own and their host's verdict.

    The verdict is computed twice (once for the host table, once while
    filtering) so that texts are never shuffled or written to scratch.
    """
    rows = rule_counts(docs, text, [F.col(host).alias("host")], only_verdict=True)
    bad = rejected_hosts(rows, deviations, rates)
    whole = docs.select(F.struct("*").alias("row"), F.col(text).alias("body"), F.col(host).alias("host"))
    scored = rule_counts(whole, "body", [F.col("row"), F.col("host")], only_verdict=True)
    # a generator between counts and filter: pushed through the projections, the
    # predicate would carry the word split into the per-window lambda
    passed = scored.select(F.inline(F.array(F.struct("row", "host", "base_failed")))).filter(~F.col("base_failed"))
    joined, fine = _without(passed, bad, F.col("host"))
    return joined.filter(fine).select("row.*")
