"""Stupid-backoff language-model scores, computed relationally.

The corpus is its own training text (words ``[^\\x20\\x09-\\x0D]+`` in lower case).  A count table
per order holds every n-gram that occurs ``min_count`` times or more (order one: every word).
A word is scored at the highest order n whose n-gram with the words before it is in its table,
S = c(n-gram) / c(its first n - 1 words), or c(word) / words at order one, times ``alpha`` for every
order it was backed off; the first words of a text begin at the order that their context allows.
Logarithms are summed per document.

What an n-gram adds to a document does not depend on where it stands: being found at order n
changes a word's score by

    log c(g) - log c(front of g) - log c(back of g) + log c(middle of g) - log alpha

(front: all but the last word, back: all but the first, middle: without both), since its
back is then found one order lower.  So every table gets this value once per n-gram, by joins with
the tables one and two orders lower, and a document's score is the sum of the
values of its n-grams: one join of n-grams to values for all orders, however deep they back off.

* Hot n-grams make up more than 1 / HOT of the corpus; there are at most HOT of them per order, so
  their counts and values may be broadcast.
* Counting.  Tasks hash words and n-grams of a batch in arrays, sum them, and send them packed by
  hash partition, where they are summed again.  An n-gram is only counted if both its parts
  are in the table below, told by a table of bits of fixed size (a false hit costs counting
  and is dropped by its count or by a join).  What a hot part adds to its value is known there;
  only other parts are joined.
* Scoring.  Hot n-grams are summed where the text is read; all others are sent packed, by hash
  partition, to the values of that partition, so no n-gram brings more than a 1 / HOT part of the
  corpus to a task.
* Disk.  Scoring is done in ``SLICES`` by hash partition; every order and slice ends in a table in
  the shared checkpoint folder and gives its shuffle files back.

n-grams are compared by 64-bit hashes: among 1e8 distinct ones about 3e-4 collisions are expected.
n-grams above order one that occur fewer than ``min_count`` times are left out of the tables, which
is what makes a score back off.

Defined results: null and empty texts have no word, score null; rows that share an id
(also the null id) are scored as one document; an empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, drop_scratch, materialised, prepare_workers, quoted, scratch_table, settings, shuffles_given_back
from .word_arrays import classes, cut, paired

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2
SLICES = 2
#: At most so many n-grams of an order are broadcast: some 30 MB of each order, however large the corpus.
HOT = 1_000_000
#: Bits of the table that tells which n-grams have been counted often enough, a power of two.
BITS = 1 << 27
#: n-grams that one hash partition is meant for; more partitions for more words.
PER_PARTITION = 1_000_000
#: n-grams that a task holds before it sends their sums.
HELD = 1 << 20
#: Tables by n-gram are shuffled at every size; a side whose partitions all stay below the
#: threshold is hashed and not sorted.
JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}
#: Hashes and values hardly repeat, so no dictionary is tried for them.
PARQUET = {"compression": "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in ("id", "front", "back", "value")}

PACKED = "part int, front binary, back binary, n binary"
COUNTED = "id long, front long, back long, n long, back_n long, value double, places binary"
SENT = "part int, docs binary, sizes binary, ids binary, own binary"
PARTIAL = "bucket int, sums binary"
SUMS = "key long, n_words long, n_backoff long, log_score double"


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    """Hash partitions are ranges of ids, so ids in order are in order of partition."""
    return ((ids >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _part_column(ids: Column, parts: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(ids, 32) * F.lit(parts).cast("long"), 32).cast("int")


def _has(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = (ids & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


class Hot(NamedTuple):
    """Ids in order, and columns beside them."""

    ids: np.ndarray
    first: np.ndarray  #: number of the first id of each range of ids; there are two to four ranges an id
    columns: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, rows: pa.Table, *columns: str) -> Hot:
        ids = np.asarray(rows.column("id")).view(np.uint64)
        by_id = np.argsort(ids)
        ids, bits = ids[by_id], (2 * len(ids) + 1).bit_length()
        edges = np.searchsorted(ids >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        return cls(ids, edges.astype(np.int32), tuple(np.asarray(rows.column(c))[by_id] for c in columns))

    def find(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id, -1 for those that are not here."""
        place = (ids >> np.uint64(65 - len(self.first).bit_length())).astype(np.int64)
        at, out = self.first[place], np.full(len(ids), -1, np.int32)
        left = self.first[place + 1] - at
        todo = np.flatnonzero(left)
        while len(todo):
            here = self.ids[at[todo]] == ids[todo]
            out[todo[here]] = at[todo[here]]
            todo = todo[~here]
            at[todo] += 1
            left[todo] -= 1
            todo = todo[left[todo] > 0]
        return out


def _grams(texts: pa.Array, order: int, bits: np.ndarray | None):
    """The words of a batch, then (k, ids, front, back, text) of the n-grams of each order that may be in a table."""
    words = cut(texts, classes(BLANKS))
    ids, at = words.hashes, np.arange(len(words.hashes))
    yield words
    yield 1, ids, ids, np.zeros(len(ids), np.uint64), words.text
    for k in range(2, order + 1):
        known = _has(bits, ids)
        near = np.flatnonzero(known[:-1] & known[1:] & (at[1:] == at[:-1] + 1) & (words.text[at[1:]] == words.text[at[:-1]]))
        front, back, at = ids[near], ids[near + 1], at[near + 1]
        ids = paired(front, back)
        yield k, ids, front, back, words.text[at]


def _count(order: int, told: Broadcast | None, parts: int):
    """Packed sums of the n-grams of one order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if told is None else np.frombuffer(told.value, np.uint8)
        held: list[tuple[np.ndarray, ...]] = []

        def sent() -> pa.RecordBatch:
            ids, front, back = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            by_id = np.argsort(ids)
            ids = ids[by_id]
            firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            one, n = by_id[firsts], np.diff(firsts, append=len(ids)).astype(np.int32)
            cuts = np.concatenate(([0], np.cumsum(np.bincount(_part(ids[firsts], parts), minlength=parts))))
            some = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[
                pa.array([_bytes(c[cuts[p]:cuts[p + 1]]) for p in some], pa.binary()) for c in (front[one], back[one], n)]],
                ["part", "front", "back", "n"])

        for batch in batches:
            *_, (k, ids, front, back, _) = _grams(batch.column("text"), order, bits)
            if len(ids):
                held.append((ids, front, back))
            if sum(len(x[0]) for x in held) > HELD:
                yield sent()
        if held:
            yield sent()

    return run


def _joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _summed(order: int, least: int, told_least: int, below: Broadcast | None, log_alpha: float):
    """The n-grams of one hash partition that occur ``least`` times or more; what hot parts add to their
    values is added, and those parts are null.  The first row has the places in the bit table of
    those that occur ``told_least`` times."""

    def run(group: pa.Table) -> pa.Table:
        front, back, n = (_joined(group.column(c), t) for c, t in (("front", np.uint64), ("back", np.uint64), ("n", np.int32)))
        ids = front if order == 1 else paired(front, back)
        by_id = np.argsort(ids)
        ids = ids[by_id]
        firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        n = np.add.reduceat(n[by_id].astype(np.int64), firsts)
        often = n >= least
        one, ids, n = by_id[firsts[often]], ids[firsts[often]], n[often]
        front, back = front[one], back[one]
        value, back_n, no_front, no_back = np.zeros(len(ids)), np.zeros(len(ids), np.int64), False, False
        if below is not None:
            hot_n, hot_back_n = below.value.columns
            in_front, in_back = below.value.find(front), below.value.find(back)
            no_front, no_back = in_front >= 0, in_back >= 0
            f, b = in_front[no_front], in_back[no_back]
            value = np.log(n) - log_alpha
            value[no_front] += np.log(hot_back_n[f]) - np.log(hot_n[f])
            value[no_back] -= np.log(hot_n[b])
            back_n[no_back] = hot_n[b]
        no_front, no_back = (np.broadcast_to(x, len(ids)) for x in (no_front, no_back))
        told = ids[n >= told_least]
        return pa.table({
            "id": pa.array(ids.view(np.int64)), "front": pa.array(front.view(np.int64), mask=no_front),
            "back": pa.array(back.view(np.int64), mask=no_back), "n": pa.array(n), "back_n": pa.array(back_n), "value": pa.array(value),
            "places": pa.array([_bytes((told & np.uint64(BITS - 1)).astype(np.uint32)), *[None] * (len(ids) - 1)][:len(ids)], pa.binary())})

    return run


def _set_bits(n_bits: int):
    """The blocks of a bit table that a task's places touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(max(n_bits >> 3, 1 << BLOCK), np.uint8)
        for batch in batches:
            for places in batch.column("places"):
                place = np.frombuffer(places.as_py(), np.uint32)
                for bit in range(8):  # the same bit in all, so a byte that comes twice gets the same value
                    bits[place[place & 7 == bit] >> 3] |= 1 << bit
        blocks = bits.reshape(-1, 1 << BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([blocks[b].tobytes() for b in some], pa.binary())], ["block", "content"])

    return run


#: Bytes of the bit table that one row holds, as a power of two.
BLOCK = 16


def _block_of(group: pa.Table) -> pa.Table:
    contents = np.stack([np.frombuffer(x, np.uint8) for x in group.column("content").to_pylist()])
    return pa.table({"block": group.column("block").slice(0, 1), "content": pa.array(
        [np.bitwise_or.reduce(contents, axis=0).tobytes()], pa.binary())})


def _bit_table(places: DataFrame, n_bits: int) -> np.ndarray:
    """The bits of all places: at most ``n_bits`` / 8 bytes on the driver, whatever the data."""
    touched = places.mapInArrow(_set_bits(n_bits), "block int, content binary")
    blocks = touched.groupBy("block").applyInArrow(_block_of, "block int, content binary")
    out = np.zeros(max(n_bits >> 3, 1 << BLOCK), np.uint8)
    for row in blocks.collect():
        out[row["block"] << BLOCK:(row["block"] + 1) << BLOCK] = np.frombuffer(row["content"], np.uint8)
    return out[:n_bits >> 3]


class Model:
    """Count tables and values of a corpus, in scratch tables of the shared checkpoint folder."""

    def __init__(self, docs: DataFrame, order: int, alpha: float, min_count: int):
        self.spark: SparkSession = docs.sparkSession
        self.docs, self.order, self.alpha, self.min_count = docs, order, alpha, min_count
        self.scratch: list[str] = []
        self.told: Broadcast | None = None
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        words = self.counted(1, 1, None)
        self.tell(words)
        self.total = words.agg(F.sum("n")).first()[0] or 0
        self.parts = max(self.parts, -(-self.total // PER_PARTITION))
        # id, how often, how often without its first word (order one: all words), value
        rows = words.select("id", "n", F.lit(self.total).cast("long").alias("back_n"),
                            (F.log(F.col("n")) - F.lit(math.log(max(self.total, 1)))).alias("value"))
        self.values, self.hot = [], []
        self.add(1, rows)
        for k in range(2, order + 1):
            rows = self.level(k, rows)
            self.add(k, rows)

    def add(self, k: int, rows: DataFrame) -> None:
        """Values of an order, and its hot n-grams: at most HOT, all others are left to their partitions."""
        self.values.append(rows.select("id", "value", F.lit(k).alias("k")))
        self.hot_rows = rows.filter(F.col("n") * HOT > self.total).toArrow()
        self.hot.append(Hot.of(self.hot_rows, "value"))

    def kept(self, df: DataFrame) -> DataFrame:
        self.scratch.append(scratch_table(self.spark))
        df.write.options(**PARQUET).parquet(self.scratch[-1])
        return self.spark.read.schema(df.schema).parquet(self.scratch[-1])

    def tell(self, counts: DataFrame) -> None:
        """Add n-grams to the bits that tasks know; a bit may stand for n-grams of several orders."""
        new = _bit_table(counts.filter(F.col("places").isNotNull()).select("places"), BITS)
        if self.told is not None:
            new |= np.frombuffer(self.told.value, np.uint8)
            self.told.destroy()
        self.told = self.spark.sparkContext.broadcast(new.tobytes())

    def counted(self, k: int, least: int, below: Broadcast | None) -> DataFrame:
        packed = self.docs.select("text").mapInArrow(_count(k, self.told, self.parts), PACKED)
        return self.kept(packed.groupBy("part").applyInArrow(_summed(k, least, self.min_count, below, math.log(self.alpha)), COUNTED))

    def level(self, k: int, below: DataFrame) -> DataFrame:
        """(id, n, back_n, value) of order ``k``; ``below`` has those of the order below."""
        hot = self.spark.sparkContext.broadcast(Hot.of(self.hot_rows, "n", "back_n"))
        counts = self.counted(k, self.min_count, hot)
        hot.destroy()
        self.tell(counts)
        counts = counts.drop("places")
        front = below.select(F.col("id").alias("front"), F.col("n").alias("front_n"), F.col("back_n").alias("middle_n"))
        value = F.col("value") + (F.log("middle_n") - F.log("front_n"))
        fronts = self.kept(counts.filter(F.col("front").isNotNull()).join(front, "front").select(
            "id", "back", "n", "back_n", value.alias("value")))
        fronts = fronts.unionByName(counts.filter(F.col("front").isNull()).drop("front"))
        back = below.select(F.col("id").alias("back"), F.col("n").alias("found_n"))
        value = F.col("value") - F.log("found_n")
        backs = fronts.filter(F.col("back").isNotNull()).join(back, "back").select(
            "id", "n", F.col("found_n").alias("back_n"), value.alias("value"))
        out = self.kept(fronts.filter(F.col("back").isNull()).drop("back").unionByName(backs))
        for path in self.scratch[-3:-1]:
            drop_scratch(self.spark, path)
        del self.scratch[-3:-1]
        return out

    def drop(self) -> None:
        for path in self.scratch:
            drop_scratch(self.spark, path)


#: What a batch knows of its documents itself.
OWN = np.dtype([("key", np.int64), ("n_words", np.int64), ("n_backoff", np.int64), ("log_score", np.float64)])


def _send(told: Broadcast | None, hot: Broadcast, order: int, log_alpha: float, parts: int, slices: int, part: int):
    """Packed n-grams of documents by hash partition; what is known here is summed and goes along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if told is None else np.frombuffer(told.value, np.uint8)
        for number, batch in enumerate(batches):
            keys = np.asarray(batch.column("key"))
            words, *grams = _grams(batch.column("text"), order, bits)
            length = np.bincount(words.text, minlength=len(keys))
            # steps down to order one that the words of a text have: 0, 1, ... order - 1, order - 1, ...
            low = np.minimum(length, order - 1)
            steps = low * (low - 1) // 2 + (length - low) * (order - 1)
            if part:  # the first slice counts words and steps
                length, steps = np.zeros_like(length), np.zeros_like(steps)
            score, found = steps * log_alpha, np.zeros(len(keys), np.int64)
            ids, owner = [], []
            for k, own, _, _, text in grams:
                if slices > 1:
                    mine = _part(own, parts) % slices == part
                    own, text = own[mine], text[mine]
                at = hot.value[k - 1].find(own)
                here = at >= 0
                values, = hot.value[k - 1].columns
                score = score + np.bincount(text[here], values[at[here]], len(keys))
                if k > 1:
                    found += np.bincount(text[here], minlength=len(keys))
                there = ~here if k == 1 else ~here & _has(bits, own)
                ids.append(own[there])
                owner.append(text[there])
            rows = _packets(np.concatenate(ids), np.concatenate(owner), keys, parts)
            if len(keys):
                own = np.zeros(len(keys), OWN)
                own["key"], own["n_words"], own["n_backoff"], own["log_score"] = keys, length, steps - found, score
                rows.append((number % parts, None, None, None, own.tobytes()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("part", "docs", "sizes", "ids", "own"), r, strict=True)) for r in rows], SENT_ARROW)

    return run


SENT_ARROW = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("docs", "sizes", "ids", "own"))])


def _packets(ids: np.ndarray, owner: np.ndarray, keys: np.ndarray, parts: int) -> list[tuple]:
    """(part, keys of documents, how many ids each, ids, None) for every hash partition that has some."""
    where = _part(ids, parts)
    order = np.argsort(where * max(len(keys), 1) + owner)
    ids, owner = ids[order], owner[order]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(where, minlength=parts))))
    out = []
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        mine = owner[cuts[p]:cuts[p + 1]]
        firsts = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
        sizes = np.diff(firsts, append=len(mine)).astype(np.int32)
        out.append((p, _bytes(keys[mine[firsts]]), _bytes(sizes), _bytes(ids[cuts[p]:cuts[p + 1]]), None))
    return out


def _scored(parts: int):
    """What the n-grams of one hash partition add to their documents, packed by bucket of documents."""

    def run(sent: pa.Table, values: pa.Table) -> pa.Table:
        docs, sizes, ids = (_joined(sent.column(c).drop_null(), t) for c, t in (
            ("docs", np.int64), ("sizes", np.int32), ("ids", np.uint64)))
        known = np.asarray(values.column("id")).view(np.uint64) if len(values) else np.zeros(0, np.uint64)
        by_id = np.argsort(known)
        known = known[by_id]
        at = np.minimum(np.searchsorted(known, ids), max(len(known) - 1, 0))
        hit = known[at] == ids if len(known) else np.zeros(len(ids), bool)
        at, owner = by_id[at[hit]], np.repeat(np.arange(len(docs)), sizes)[hit]
        value, k = (np.asarray(values.column(c)) for c in ("value", "k"))
        some = np.flatnonzero(np.bincount(owner, minlength=len(docs)))
        sums = np.zeros(len(some), OWN)
        sums["key"], sums["log_score"] = docs[some], np.bincount(owner, value[at], len(docs))[some]
        sums["n_backoff"] = -np.bincount(owner[k[at] > 1], minlength=len(docs))[some]
        sums = np.concatenate((_joined(sent.column("own").drop_null(), OWN), sums))
        bucket = _part(sums["key"].view(np.uint64), parts)
        order = np.argsort(bucket, kind="stable")
        sums, cuts = sums[order], np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=parts))))
        full = np.flatnonzero(np.diff(cuts))
        return pa.table({"bucket": pa.array(full.astype(np.int32)),
                         "sums": pa.array([sums[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary())})

    return run


def _added(group: pa.Table) -> pa.Table:
    """The sums of a bucket's documents."""
    sums = _joined(group.column("sums"), OWN)
    keys, at = np.unique(sums["key"], return_inverse=True)
    out = {"key": pa.array(keys)}
    for name in ("n_words", "n_backoff", "log_score"):
        column = np.bincount(at, sums[name], len(keys))  # whole numbers stay exact in doubles up to 2 ** 53
        out[name] = pa.array(column if name == "log_score" else column.astype(np.int64))
    return pa.table(out)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
          alpha: float = ALPHA, min_count: int = MIN_COUNT, slices: int = SLICES) -> DataFrame:
    """(doc_id, n_words, n_backoff, log_score, mean_log_score), one row per id; n_backoff counts steps."""
    spark = docs.sparkSession
    prepare_workers()
    identity = F.col(quoted(doc_id))
    rows = docs.select(F.xxhash64(identity).alias("key"), F.lower(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("text"))
    with shuffles_given_back(spark), settings(spark, JOINS):
        model = Model(rows, order, alpha, min_count)
        hot = spark.sparkContext.broadcast(model.hot)
        every = None
        for part in range(slices):
            sent = rows.mapInArrow(_send(model.told, hot, order, math.log(alpha), model.parts, slices, part), SENT)
            values = None
            for v in model.values:
                own = v.select(_part_column(F.col("id"), model.parts).alias("part"), "id", "value", "k")
                values = own if values is None else values.unionByName(own)
            values = values.filter(F.pmod("part", F.lit(slices)) == part)
            partial = sent.groupBy("part").cogroup(values.groupBy("part")).applyInArrow(_scored(model.parts), PARTIAL)
            sums = materialised(partial.groupBy("bucket").applyInArrow(_added, SUMS))
            every = sums if every is None else every.unionByName(sums)
        every = materialised(every.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_words", "n_backoff", "log_score")]))
    model.drop()
    return docs.select(identity.alias("doc_id")).distinct().join(every, F.xxhash64("doc_id") == F.col("key"), "left").select(
        "doc_id", F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"),
        F.coalesce("n_backoff", F.lit(0).cast("long")).alias("n_backoff"),
        F.when(F.col("n_words") > 0, F.col("log_score")).alias("log_score"),
        F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))
