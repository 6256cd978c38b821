"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of
its word shingles.  Two fingerprints link when they differ in at most
``max_bits`` of 64 bits; the result is the component of every document.

Search.  With ``s`` segments and at most ``2s - 1`` differing bits some segment
holds at most one of them, so four bits need three segments (plain pigeonhole
needs five, whose keys are far shorter).  Every distinct fingerprint is indexed
once per bit: the key is the segment of that bit with the bit left out
(a one-wildcard variant).  Two fingerprints with a segment that differs in at
most one bit share a key, so an equality join finds every link; the bit count
of the xor verifies it inside the join.

Groups of many close copies would link pair by pair.  They are first tied
together by stars: in every key, each member is verified against the key's
smallest and largest fingerprint.  Those come from a partial aggregate and are joined
to the members, so a key that holds a large group is split over tasks.  The last join then runs only between members
outside the key's most frequent component and members of another component, so it
compares no pair inside a large group, emits links between components alone,
and loses none of them.

Defined results
---------------
* null and empty texts, and texts of blanks: no shingle, fingerprint zero, linked
  like any other;
* fewer words than a shingle: the whole sequence is the one shingle;
* repeated rows: one result row per input row; the component is by fingerprint;
* null id: never a component's name unless all ids of the component are null
  (then the component id is null); such rows stay in the result;
* ties: the component id is its smallest id; the document kept is the row with
  the smallest id, of rows that share it the one with the smallest row hash;
* empty table: empty result; extra columns, of any name and type, are ignored by
  ``components`` and returned untouched by ``deduplicated`` (two maps with the same entries in
  another order count as different rows).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from .common import materialised, prepare_workers, quoted, small_side
from .graph import connected

BITS = 64
SEED = 42


def fingerprint_of(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)),
                             dtype=np.uint64, count=len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for block in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[block:block + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint column (signed 64-bit), Arrow batches."""
    prepare_workers()

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return simhash(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and bit: its one-wildcard segment variant ``key``."""
    masks = [((1 << n) - 1) << a & ~(1 << bit) for a, n in segments(max_bits) for bit in range(a, a + n)]
    first = [a for a, n in segments(max_bits) for _ in range(n)]
    table = F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(_signed(m)).alias("mask"), F.lit(a).alias("a"))
                      for bit, (m, a) in enumerate(zip(masks, first, strict=True))])
    rest = F.col("fp").bitwiseAND(F.col("v.mask"))
    # the bit number takes the top six bits of the key; a segment of more than 58 bits is not cut further
    key = F.xxhash64("v.bit", rest) if max(n for _, n in segments(max_bits)) > 57 else F.call_function(
        "shiftleft", F.col("v.bit").cast("long"), F.lit(58)).bitwiseOR(
        F.call_function("shiftrightunsigned", rest, F.col("v.a")))
    return fps.withColumn("v", F.explode(table)).withColumn("key", key).drop("v")


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def fingerprint_components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, label): the component of every distinct fingerprint in ``fps``."""
    # as many tasks as shuffles have, since every row becomes one per bit
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = materialised(fps.select("fp").distinct().repartition(spread, "fp"))
    # what a key needs of all its members comes from partial aggregates, joined to the index as a table of
    # its own, so a key with many members is split like any hot key of a join
    index = variants(fps, max_bits)
    ends = _by_key(index.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo < hi"))
    stars = F.filter(F.array("lo", "hi"), lambda x: (x != F.col("fp")) & _near(x, F.col("fp"), max_bits))
    star = index.join(ends, F.col("key") == F.col("k"), "left").select(
        F.col("fp").alias("a"), F.explode(stars).alias("b")).distinct()
    tied = materialised(connected(fps.select(F.col("fp").alias("node")), star).select(
        F.col("node").alias("fp"), "label").repartition(spread, "fp"))

    # of two components in a key one at least is not the key's most frequent: those members meet all
    index = variants(tied, max_bits)
    counts = index.groupBy("key", "label").agg(F.count("*").alias("n"))
    usual = _by_key(counts.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count("*").alias("kinds"))
                    .filter("kinds > 1").drop("kinds"))
    other = F.coalesce("most", "label") != F.col("label")  # of a key with one component there is no ``most``
    left = index.join(usual, F.col("key") == F.col("k"), "left").filter(other).select(
        "key", F.col("fp").alias("f"), F.col("label").alias("l"))
    right = index.select(F.col("key").alias("k"), F.col("fp").alias("g"), F.col("label").alias("m"))
    across = left.join(right, (F.col("key") == F.col("k")) & (F.col("l") != F.col("m"))
                       & _near(F.col("f"), F.col("g"), max_bits)).select(
        F.least("l", "m").alias("a"), F.greatest("l", "m").alias("b")).distinct()
    merged = materialised(connected(tied.select(F.col("label").alias("node")).distinct(), across).select(
        F.col("node").alias("l"), F.col("label").alias("final")))
    return tied.join(small_side(merged, 16), F.col("label") == F.col("l")).select("fp", F.col("final").alias("label"))


def _by_key(rows: DataFrame) -> DataFrame:
    """A table with one row per ``key`` (as ``k``), to be joined to a key's members.

    It grows with the input, so it is never broadcast; as a table of its own it leaves a hot key to be split.
    """
    return materialised(rows.withColumnRenamed("key", "k"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    rows = materialised(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")))
    nodes = materialised(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = materialised(fingerprint_components(nodes, max_bits))
    named = materialised(nodes.join(labels, "fp").groupBy(F.col("label").alias("l")).agg(F.min("first_id").alias("component_id")))
    lookup = labels.join(small_side(named, 24), F.col("label") == F.col("l")).select("fp", "component_id")
    return rows.join(lookup, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _unhashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _unhashable(kind.elementType)
    if isinstance(kind, StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def row_hash(docs: DataFrame) -> Column:
    """A 64-bit hash of a row, whatever its columns are called; maps and variants count by their JSON."""
    columns = []
    for field in docs.schema.fields:
        c = F.col(quoted(field.name))
        columns.append(F.to_json(F.struct(c.alias("c"))) if _unhashable(field.dataType) else c)
    return F.xxhash64(*columns)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without near-duplicates: of every component one row, all columns.

    Only (id, row hash, fingerprint) is written and shuffled; the texts meet the
    rows to drop in an anti-join, broadcast while those are few bytes.
    """
    row_key = [F.col(doc_id).alias("id"), row_hash(docs).alias("h")]
    rows = materialised(docs.select(*row_key, fingerprint(F.col(text), shingle).alias("fp")))
    labels = materialised(fingerprint_components(rows, max_bits))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    keys = rows.groupBy("id", "h", "fp").agg(F.count("*").alias("n")).join(labels, "fp")
    keys = materialised(keys.select("label", "n", order.alias("k")))
    winners = materialised(keys.groupBy(F.col("label").alias("l")).agg(F.min("k").alias("best")))
    judged = materialised(keys.join(small_side(winners, 48), F.col("label") == F.col("l")).select(
        F.col("k.id").alias("drop_id"), F.col("k.h").alias("drop_h"), "n",
        (F.col("k") == F.col("best")).alias("wins")))

    whole = docs.select(F.struct("*").alias("row"), *row_key)

    def among(side: DataFrame, how: str) -> DataFrame:
        side = small_side(side.select("drop_id", "drop_h"), 48)
        return whole.join(side, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("h") == F.col("drop_h")), how)

    kept = among(judged.filter("not wins or n > 1"), "left_anti").select("row.*")
    repeated = judged.filter("wins and n > 1")  # a winner that stands there several times, alike in all columns
    if not repeated.isEmpty():
        once = among(repeated, "left_semi").groupBy("id", "h").agg(F.first("row").alias("row"))
        kept = kept.unionByName(once.select("row.*"))
    return kept
