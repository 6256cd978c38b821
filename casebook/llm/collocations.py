"""Collocations by dynamic itemset counting: phrases of all lengths in cyclic shard scans.

Texts are lower-cased (A-Z), split at marks into pieces and those into words; a phrase is up
to ``longest`` neighbouring words of one piece, in one language.  The words' 64-bit ids (of
language and word) are written once, in ``shards`` shards, to a table in the shared
checkpoint folder, with each task's dictionary of words beside them.

Counting.  The scans go round the shards.  Words are active from the first scan; a longer
phrase becomes active as soon as both its subphrases, one word shorter, have reached
``min_count`` in what has been scanned of them, and is counted from then on for exactly one
full cycle of shards, whatever has become active meanwhile: its count is then complete.  A
phrase that occurs ``min_count`` times has subphrases that do, so none is missed.

What has been reached is told to the tasks by a table of ``SLOTS`` bytes, indexed by phrase
hash, that holds the scan after which a slot was set: its size is fixed, whatever the data.
Two phrases in one slot may activate a phrase too early; that costs counting and changes no
result, since the window follows from the table alone and phrases below ``min_count``
are dropped at the end.  Tasks count in arrays and send sums; a phrase is the pair of its
first part (all but the last word) and last part (all but the first) by id.

Scores join every candidate to its two parts, length by length, which hands on the counts of
all its beginnings and endings.  A candidate that lies in a longer one as frequent as itself lies
in one that is one word longer, so that join finds it too.  All arithmetic is decimal.

Ids are 64-bit hashes: among 1e8 distinct words about 3e-4 collisions are expected.

Defined results: null and empty texts hold no word; a null language is ``und``; repeated rows
count each; ties in rank go by score, count, then phrase in byte order; an empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from .common import drop_scratch, materialised, prepare_workers, quoted, scratch_table, shuffles_given_back, small_side
from .word_arrays import FACTOR, Sums, classes, cut, lowering, mixed, paired

MARKS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SHARDS = 4
#: Bytes of the table that tells tasks what has been reached, a power of two.
SLOTS = 1 << 24
NEVER = 255
#: Phrases of a length that a task holds before it sends their sums, and places of the words it has sent.
HELD = 1 << 19
KNOWN = 1 << 20
#: The written shards and sums are hashes that repeat: worth a better codec than the default.
CODEC = "zstd"

WRITTEN = "shard int, lang string, n_words long, ids binary, pieces binary, new_ids array<long>, new_words array<string>"
COUNTED = "k int, front long, back long, since int, n long"


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _cut_texts(shards: int):
    """Rows (one per batch and language): ids of words, lengths of pieces, words not yet sent by the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, table, lower = TaskContext.get().partitionId(), classes(BLANKS, MARKS), lowering()
        sent = np.zeros(KNOWN, np.uint64)  # an id that was sent, by its low bits; one that is displaced is sent again
        for number, batch in enumerate(batches):
            langs = batch.column("lang").dictionary_encode()
            which = np.asarray(langs.indices)
            rows = {name: [] for name in ("lang", "n_words", "ids", "pieces", "new_ids", "new_words")}
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                words = cut(batch.column("text").filter(pa.array(which == code)), table, lower)
                if not len(words.starts):
                    continue
                seed = np.uint64(int.from_bytes(lang.encode("utf-8"), "little") * FACTOR % (1 << 64))
                ids = mixed(words.hashes ^ mixed(np.array([seed + np.uint64(1)], np.uint64)))
                unsent = np.flatnonzero(sent[(ids & np.uint64(KNOWN - 1)).astype(np.int64)] != ids)
                new, at = np.unique(ids[unsent], return_index=True)
                at = unsent[at]
                sent[(new & np.uint64(KNOWN - 1)).astype(np.int64)] = new
                ends = np.flatnonzero(np.diff(words.piece, append=words.piece[-1] + 1))
                rows["lang"].append(lang)
                rows["n_words"].append(len(ids))
                rows["ids"].append(_bytes(ids))
                rows["pieces"].append(_bytes(np.diff(ends, prepend=-1).astype(np.int32)))
                rows["new_ids"].append(new.view(np.int64))
                text = words.raw.tobytes()
                rows["new_words"].append([text[a:b].decode("utf-8") for a, b in zip(
                    words.starts[at].tolist(), words.ends[at].tolist(), strict=True)])
            n = len(rows["lang"])
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([(task + number) % shards] * n, pa.int32()), pa.array(rows["lang"], pa.string()),
                    pa.array(rows["n_words"], pa.int64()), pa.array(rows["ids"], pa.binary()),
                    pa.array(rows["pieces"], pa.binary()), pa.array(rows["new_ids"], pa.list_(pa.int64())),
                    pa.array(rows["new_words"], pa.list_(pa.string()))],
                    ["shard", "lang", "n_words", "ids", "pieces", "new_ids", "new_words"])

    return run


def _count_shard(told: Broadcast, scan: int, shards: int, longest: int):
    """Sums of the phrases that are active in this scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.frombuffer(told.value, np.uint8)
        sums = [Sums() for _ in range(longest)]

        def sent(k: int) -> pa.RecordBatch:
            front, back, since, n = sums[k - 1].taken()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), k, np.int32)), pa.array(front.view(np.int64)), pa.array(back.view(np.int64)),
                 pa.array(since.astype(np.int32)), pa.array(n.astype(np.int64))], ["k", "front", "back", "since", "n"])

        for batch in batches:
            for ids, pieces in zip(batch.column("ids"), batch.column("pieces"), strict=True):
                ids = np.frombuffer(ids.as_buffer(), np.uint64)
                left = np.frombuffer(pieces.as_buffer(), np.int32)
                # words from here to the end of the piece
                left = np.repeat(np.cumsum(left), left) - np.arange(len(ids))
                at = np.arange(len(ids))
                if scan < shards:
                    sums[0].add(ids, ids, np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint8))
                since = slots[(ids & np.uint64(len(slots) - 1)).astype(np.int64)]
                for k in range(2, longest + 1):
                    # neighbours in ``at`` that are neighbours in the piece, both reached before this scan
                    near = np.flatnonzero((since[:-1] <= scan) & (since[1:] <= scan)
                                          & (at[1:] == at[:-1] + 1) & (left[at[:-1]] >= k))
                    front, back = ids[near], ids[near + 1]
                    active = np.maximum(since[near], since[near + 1])
                    ids, at = paired(front, back), at[near]
                    now = active.astype(np.int64) + shards > scan  # its cycle is not over
                    sums[k - 1].add(ids[now], front[now], back[now], active[now])
                    if k < longest:
                        since = np.maximum(slots[(ids & np.uint64(len(slots) - 1)).astype(np.int64)], active)
            for k, s in enumerate(sums, 1):
                if s.held > HELD:
                    yield sent(k)
        for k, s in enumerate(sums, 1):
            if s.held:
                yield sent(k)

    return run


def _new_slots(told: Broadcast):
    """The slots of reached phrases that are not set yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.frombuffer(told.value, np.uint8)
        for batch in batches:
            slot = np.unique(_ids(batch) & np.uint64(len(slots) - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot[slots[slot] == NEVER].astype(np.int32))], ["slot"])

    return run


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    k, front, back = (np.asarray(batch.column(c)) for c in ("k", "front", "back"))
    front, back = front.view(np.uint64), back.view(np.uint64)
    return np.where(k == 1, front, paired(front, back))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array(_ids(batch).view(np.int64)), *(batch.column(c) for c in ("k", "front", "back", "n"))],
            ["id", "k", "front", "back", "n"])


def count_phrases(spark: SparkSession, written: str, folder: str, min_count: int, longest: int, shards: int,
                  n_slots: int) -> str:
    """Path of (k, front, back, since, n): every phrase that occurs ``min_count`` times or more, with its count.

    ``since`` is the scan in which a phrase became active.  Every scan writes the sums so far
    of the phrases whose cycle is not over, and of those that have been reached.
    """
    slots = np.full(n_slots, NEVER, np.uint8)
    last, scan, state = 0, 0, None
    while scan < last + shards:
        if scan >= NEVER:
            raise ValueError("the cycles of this many shards do not fit the table; use fewer")
        told = spark.sparkContext.broadcast(slots.tobytes())
        shard = spark.read.schema(WRITTEN).parquet(written).filter(F.col("shard") == scan % shards).select("ids", "pieces")
        sums = shard.mapInArrow(_count_shard(told, scan, shards, longest), COUNTED)
        if state is not None:
            sums = sums.unionByName(spark.read.schema(COUNTED).parquet(state))
        sums = sums.groupBy("k", "front", "back", "since").agg(F.sum("n").alias("n"))
        needed = (F.col("since") + shards > scan + 1) | (F.col("n") >= min_count)
        state, gone = f"{folder}/scan-{scan}", state
        sums.filter(needed).write.option("compression", CODEC).parquet(state)
        if gone:
            drop_scratch(spark, gone)
        reached = spark.read.schema(COUNTED).parquet(state).filter((F.col("n") >= min_count) & (F.col("k") < longest))
        new = reached.mapInArrow(_new_slots(told), "slot int").distinct().toArrow()["slot"].to_numpy()
        told.destroy()
        scan += 1
        if len(new):
            slots[new] = last = scan
    return state


def _levels(phrases: DataFrame, words: DataFrame, longest: int) -> list[DataFrame]:
    """For each length, (id, lang, total, n, phrase, last, heads, tails): texts, and the counts of all beginnings and endings."""
    known = phrases.filter("k = 1").join(words, "id").select(
        "id", "lang", "total", "n", F.col("word").alias("phrase"), F.col("word").alias("last"),
        F.array("n").alias("heads"), F.array("n").alias("tails"))
    levels = [known]
    for k in range(2, longest + 1):
        front = known.select(F.col("id").alias("front"), "lang", "total", F.col("phrase").alias("begin"), "heads")
        back = known.select(F.col("id").alias("back"), "last", "tails")
        known = phrases.filter(F.col("k") == k).join(front, "front").join(back, "back").select(
            "id", "lang", "total", "n", F.concat_ws(" ", "begin", "last").alias("phrase"), "last",
            F.concat("heads", F.array("n")).alias("heads"), F.concat("tails", F.array("n")).alias("tails"))
        if k < longest:
            known = materialised(known)
        levels.append(known)
    return levels


def _lowest_cut(k: int) -> Column:
    """struct<score, cut, l, r> of the lowest-scoring cut of a phrase of ``k`` words, the first of equals."""
    wide = "decimal(38,0)"

    def scored(j: int) -> Column:
        left, right = F.get("heads", F.lit(j - 1)), F.get("tails", F.lit(k - j - 1))
        score = F.call_function("div", F.col("n").cast("decimal(19,0)") * F.col("total").cast("decimal(19,0)") * F.lit(1000).cast("decimal(4,0)"),
                                (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast(wide))
        return F.struct(score.alias("score"), F.lit(j).alias("cut"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*map(scored, range(1, k))))


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
         top: int = TOP, shards: int = SHARDS, n_slots: int = SLOTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    if n_slots & (n_slots - 1):
        raise ValueError("the number of slots is a power of two")
    spark = docs.sparkSession
    prepare_workers()
    written, folder = scratch_table(spark), scratch_table(spark)
    with shuffles_given_back(spark):
        rows = docs.select(F.coalesce(F.col(quoted(lang)), F.lit("und")).alias("lang"),
                           F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
        rows.mapInArrow(_cut_texts(shards), WRITTEN).write.option("compression", CODEC).partitionBy("shard").parquet(written)
        state = count_phrases(spark, written, folder, min_count, longest, shards, n_slots)
        counted = spark.read.schema(COUNTED).parquet(state).filter(F.col("n") >= min_count)
        phrases = materialised(counted.mapInArrow(_named, "id long, k int, front long, back long, n long"))
        batches = spark.read.schema(WRITTEN).parquet(written)
        totals = batches.groupBy("lang").agg(F.sum("n_words").alias("total"))
        reached = small_side(phrases.filter("k = 1").select("id"), 8)
        words = batches.select("lang", F.inline(F.arrays_zip(F.col("new_ids").alias("id"), F.col("new_words").alias("word"))))
        words = words.groupBy("id").agg(F.min("lang").alias("lang"), F.min("word").alias("word")).join(reached, "id")
        levels = _levels(phrases, materialised(words.join(totals, "lang")), longest)
        # the most frequent candidate that is longer by a word
        longer = phrases.filter("k > 1").select(F.explode(F.array("front", "back")).alias("id"), "n").groupBy("id").agg(
            F.max("n").alias("most"))
        scored = [level.withColumn("cut", _lowest_cut(k)).drop("heads", "tails") for k, level in enumerate(levels[1:], 2)]
        kept = reduce(DataFrame.unionByName, scored).join(longer, "id", "left").filter(
            F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("n")))
        first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = kept.select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
        ranked = ranked.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
        result = materialised(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    drop_scratch(spark, written)
    drop_scratch(spark, folder)
    return result
