"""Temperature mixing of sources, realised as budgeted block permutations.

Weights.  A source with token share p gets weight p^t / sum p^t.  Flattening
(smaller t) raises the entropy of the weights and the repetition of small
sources; both are monotone in t, so t in [0, 1] is bisected: the largest t
whose weights reach ``target_entropy`` (a share of log(number of sources)), then
raised where needed to the smallest t that keeps every source within
``max_repeats`` passes of its tokens.  One Spark aggregate evaluates 63 inner
points, which is six halvings.

The budget is a number of tokens, by default those of the input, so that a source whose weight is
below its share is sampled below one epoch; with ``WHOLE`` it is as many as give the source that
is flattened most, the largest, its one epoch, and smaller ones more.

Realisation.  A source's budget is floor(weight * budget) tokens: at exponent 1 in whole
numbers, else in doubles, where a product within 1e-12 of the next whole number is that.  Its
documents lie in blocks by a hash of id and text; an epoch is a permutation of
the blocks by a hash of (seed, epoch, source, block).  Whole epochs repeat every
document; in the last epoch blocks are taken in permuted order while they fit,
then documents of the next block by their hash while they fit, and of equal rows
as many as fit.  The plan is one
row per (source, block), so a hot source is spread over its blocks, and texts
are not shuffled while the plan's measured size allows a broadcast.

Defined results
---------------
* tokens are the words ``[^\\x20\\x09-\\x0D]+``; null and empty texts have none: they
  cost nothing and come once per epoch of their block;
* a null source is a source like any other;
* repeated rows are alike in hash; where the last epoch ends among them, as many as
  fit are taken (how many is defined, which of them is not), so it ends within one
  document of the budget; documents that tie on the hash are counted at the longest;
* a source without any token: weight zero, its documents come once (in epoch 0);
* empty table: empty result;
* extra columns are ignored by ``realise`` and returned untouched by
  ``mixed_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialised, small_side, words

SEED = 20
TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
#: Blocks of all sources together, beside one per source; bounds the plan table.
MAX_BLOCKS = 1 << 16
MIN_BLOCK_TOKENS = 20_000
#: A budget in which the largest source comes once: every document is in the mixture.
WHOLE = "whole"
GRID = 64
ROUNDS = 5


def _place(doc_id: Column, text: Column, seed: int) -> Column:
    """The hash that deals a document to its block and orders it there."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For every exponent t: sum p^t and sum p^t log p, in one pass over the sources."""
    p = F.col("share")
    row = shares.agg(*[x for t in exponents for x in (
        F.sum(F.pow(p, F.lit(t))), F.sum(F.pow(p, F.lit(t)) * F.log(p)))]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]


def _bisect(shares: DataFrame, fine: Callable[[float, float, float], bool], rising: bool) -> float:
    """The border in [0, 1] of the exponents that are ``fine`` (all above it if ``rising``, else all below)."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        inner = [low + (high - low) * i / GRID for i in range(1, GRID)]
        ok = [fine(t, z, s) for t, (z, s) in zip(inner, _sums(shares, inner), strict=True)]
        n = sum(ok)  # monotone: the fine ones are the upper or the lower part
        edge = len(inner) - n if rising else n
        points = [low, *inner, high]
        low, high = points[edge], points[edge + 1]
    return round(high if rising else low, 9)


def exponent(sources: DataFrame, budget: float | None, target_entropy: float = TARGET_ENTROPY,
             max_repeats: float = MAX_REPEATS) -> float:
    """The temperature exponent for ``sources`` (source, tokens); budget None: WHOLE."""
    total = sources.agg(F.sum("tokens").alias("n"), F.min("tokens").alias("low"), F.max("tokens").alias("high"),
                        F.count("*").alias("k")).first()
    if not total["n"] or total["k"] < 2:
        return 1.0
    shares = sources.select((F.col("tokens") / F.lit(total["n"])).alias("share"))
    least = total["low"] / total["n"]
    goal = target_entropy * math.log(total["k"])

    def spread(t: float, z: float, s: float) -> bool:
        return math.log(z) - t * s / z >= goal

    def within(t: float, z: float, s: float) -> bool:
        if budget is None:  # the largest source once, so the smallest (its share of it) ** (t - 1) times
            return (total["low"] / total["high"]) ** (t - 1) <= max_repeats
        return least ** (t - 1) / z * budget / total["n"] <= max_repeats

    (z, s), = _sums(shares, [1.0])
    t = 1.0 if spread(1.0, z, s) else _bisect(shares, spread, rising=False)
    (z, s), = _sums(shares, [t])
    return t if within(t, z, s) else _bisect(shares, within, rising=True)


def _own_budget(t: float, budget: int, total: int) -> Column:
    """Whole tokens of a source (columns tokens, weight) of all the ``budget``."""
    if t == 1.0:  # the share of all tokens, in whole numbers: nothing is lost to rounding
        product = F.col("tokens").cast("decimal(19,0)") * F.lit(budget).cast("decimal(19,0)")
        return F.call_function("div", product, F.lit(max(total, 1)).cast("decimal(19,0)")).cast("long")
    exact = F.col("weight") * F.lit(float(budget))
    return F.floor(exact * (1 + 1e-12)).cast("long")


def plan(docs: DataFrame, doc_id: str, text: str, source: str, budget: int | str | None = None,
         target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per (source, block): epochs, whether the last epoch takes the block, its cut.

    Columns: plan_source, blocks (of the source), plan_block, epochs (whole ones),
    taken (the last epoch holds the whole block), cut (or its documents with a hash
    up to this; null for none), tie and share (and so many of the rows with that
    hash; null for none), weight, budget.
    """
    narrow = materialised(docs.select(
        F.col(source).alias("source"), _place(F.col(doc_id), F.col(text), seed).alias("u"),
        F.size(words(F.col(text))).cast("long").alias("tokens")))
    sources = materialised(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    with_tokens = sources.filter("tokens > 0")
    total = with_tokens.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    t = exponent(with_tokens, None if budget == WHOLE else budget, target_entropy, max_repeats)
    norm = _sums(with_tokens.select((F.col("tokens") / F.lit(max(total, 1))).alias("share")), [t])[0][0] or 1.0
    whole = budget == WHOLE
    if whole:
        largest = with_tokens.agg(F.max("tokens")).first()[0] or 0
        budget = math.ceil(total * (largest / max(total, 1)) ** (1 - t) * norm)
    per_block = max(MIN_BLOCK_TOKENS, math.ceil(total / MAX_BLOCKS))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / max(total, 1), F.lit(t)) / norm).otherwise(0.0)
    dealt = sources.withColumn("weight", weight).withColumn("budget", F.greatest(_own_budget(t, budget, total), F.col("tokens") if whole else F.lit(0))).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("long")
    ).withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens"))).withColumn(
        "blocks", F.greatest(F.ceil(F.col("tokens") / per_block), F.lit(1)).cast("long"))
    dealt = materialised(dealt.withColumnRenamed("source", "s").drop("tokens"))

    side = small_side(dealt, F.coalesce(F.length("s"), F.lit(0)) * 4 + 64)
    rows = narrow.join(side, F.col("source").eqNullSafe(F.col("s"))).select(
        "s", "u", "tokens", "weight", "budget", "epochs", "rest", "blocks",
        F.pmod("u", "blocks").alias("block"))
    by_source = ["s", "weight", "budget", "epochs", "rest", "blocks"]
    blocks = rows.groupBy(*by_source, "block").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("s").orderBy(block_key(F.col("epochs"), F.col("s"), F.col("block"), seed), "block")
    blocks = materialised(blocks.withColumn("upto", F.sum("tokens").over(
        order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("upto") - F.col("tokens")))
    # the block in which the last epoch ends: its documents one by one, by hash
    edge = blocks.filter("before < rest and upto > rest").select(
        F.col("s").alias("e"), F.col("block").alias("eb"), (F.col("rest") - F.col("before")).alias("left"))
    edge = small_side(materialised(edge), F.coalesce(F.length("e"), F.lit(0)) * 4 + 32)
    ending = rows.join(edge, F.col("s").eqNullSafe(F.col("e")) & (F.col("block") == F.col("eb")))
    # equal rows count together, so the window sees a hash once however often it is repeated
    alike = ending.groupBy("e", "eb", "left", "u").agg(F.sum("tokens").alias("tokens"), F.max("tokens").alias("most"))
    running = F.sum("tokens").over(Window.partitionBy("e", "eb").orderBy("u").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    fits = F.col("run") <= F.col("left")
    share = F.floor((F.col("left") - F.col("run") + F.col("tokens")) / F.col("most")).cast("long")
    cuts = alike.withColumn("run", running).groupBy("e", "eb").agg(
        F.max(F.when(fits, F.col("u"))).alias("cut"),
        F.min(F.when(~fits, F.struct("u", share.alias("share")))).alias("next"))
    some = F.col("next.share") > 0
    cuts = cuts.withColumn("tie", F.when(some, F.col("next.u"))).withColumn("share", F.when(some, F.col("next.share")))
    joined = blocks.join(cuts, F.col("s").eqNullSafe(F.col("e")) & (F.col("block") == F.col("eb")), "left")
    return materialised(joined.select(
        F.col("s").alias("plan_source"), F.col("blocks").alias("plan_blocks"), F.col("block").alias("plan_block"),
        F.col("epochs").alias("epochs"), F.coalesce(F.col("rest") > 0, F.lit(False)).__and__(
            F.col("upto") <= F.col("rest")).alias("taken"), "cut", "tie", "share", "weight", "budget"))


def block_key(epoch: Column, source: Column, block: Column, seed: int = SEED) -> Column:
    """The place of a block in the permutation of an epoch."""
    return F.xxhash64(F.lit(seed), epoch.cast("long"), source, block.cast("long"))


def _some_of_equal(tied: DataFrame) -> DataFrame:
    """``tied`` (source, u, share, ...) with ``chosen``: true for ``share`` rows of every (source, u).

    Equal rows cannot be told apart, so they are numbered where they are stored: every
    stored partition takes its quota, and no task holds more than a partition's rows.
    """
    stored = materialised(tied.withColumn("at", F.monotonically_increasing_id())).withColumn(
        "part", F.shiftright("at", 33))
    before = Window.partitionBy("source", "u").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quotas = stored.groupBy("source", "u", "part", "share").agg(F.count("*").alias("n")).select(
        F.col("source").alias("qs"), F.col("u").alias("qu"), F.col("part").alias("qp"),
        (F.col("share") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("quota"))
    quotas = small_side(materialised(quotas), F.coalesce(F.length("qs"), F.lit(0)) * 4 + 48)
    place = F.row_number().over(Window.partitionBy("source", "u", "part").orderBy("at"))
    numbered = stored.withColumn("place", place).join(quotas, F.col("source").eqNullSafe(F.col("qs")) & (
        F.col("u") == F.col("qu")) & (F.col("part") == F.col("qp")))
    return numbered.withColumn("chosen", F.col("place") <= F.col("quota")).drop(
        "at", "part", "place", "qs", "qu", "qp", "quota")


def _emitted(rows: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """``rows`` (source, u, ...) once per copy, with epoch and block."""
    counts = blocks.select("plan_source", "plan_blocks").distinct()
    per_source = small_side(materialised(counts), F.coalesce(F.length("plan_source"), F.lit(0)) * 4 + 32)
    dealt = rows.join(per_source, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source").withColumn(
        "block", F.pmod("u", "plan_blocks")).drop("plan_blocks")
    side = small_side(blocks.drop("plan_blocks", "weight", "budget"),
                      F.coalesce(F.length("plan_source"), F.lit(0)) * 4 + 64)
    dealt = dealt.join(side, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("block") == F.col("plan_block")))
    chosen = F.col("taken") | F.coalesce(F.col("u") <= F.col("cut"), F.lit(False))
    if blocks.filter("tie IS NOT NULL").isEmpty():
        dealt = dealt.withColumn("chosen", chosen)
    else:
        tied = F.coalesce(F.col("u") == F.col("tie"), F.lit(False))
        dealt = dealt.filter(~tied).withColumn("chosen", chosen).unionByName(_some_of_equal(dealt.filter(tied)))
    copies = F.col("epochs") + F.col("chosen").cast("long")
    return dealt.withColumn("copies", copies).filter("copies > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def realise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            budget: int | str | None = None, target_entropy: float = TARGET_ENTROPY,
            max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, block_key: one row per copy in the mixture.

    Ordered by (epoch, block_key, block) within a source, the rows are its block
    permutations.
    """
    blocks = plan(docs, doc_id, text, source, budget, target_entropy, max_repeats, seed)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       _place(F.col(doc_id), F.col(text), seed).alias("u"),
                       F.size(words(F.col(text))).cast("long").alias("n_tokens"))
    return _emitted(rows, blocks, seed).select(
        "doc_id", "source", "n_tokens", "epoch", "block",
        block_key(F.col("epoch"), F.col("source"), F.col("block"), seed).alias("block_key"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    budget: int | str | None = None, target_entropy: float = TARGET_ENTROPY,
                    max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixture: the rows of ``docs``, all columns, as often as it holds them."""
    blocks = plan(docs, doc_id, text, source, budget, target_entropy, max_repeats, seed)
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"),
                       _place(F.col(doc_id), F.col(text), seed).alias("u"))
    return _emitted(rows, blocks, seed).select("row.*")
