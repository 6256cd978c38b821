"""Rank-1 selection without a window over raw rows.

``DENSE_RANK() OVER (PARTITION BY g ORDER BY k) = 1`` keeps the rows whose
``k`` equals the group's minimum.  Written as a grouped ``min`` joined back on
``(g, k)`` it needs no sort of the group: the aggregate is partial on the map
side, so a customer holding a third of all rows costs one row per map task,
and the join back is keyed on ``(g, k)``, which spreads a hot ``g`` over its
distinct ``k`` values (AQE splits what is still skewed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.expr import quoted
from casebook.session import checkpoint_dir


def extreme_with_ties(df: DataFrame, by: Sequence[str], key: str, largest: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is the min (or max) of their ``by`` group.

    Same rows as ``dense_rank() == 1`` (and ``rank() == 1``) over
    ``partitionBy(by).orderBy(key)`` for non-NULL keys; a NULL group value is
    its own group.  NULL keys never qualify, since ``min``/``max`` skip them.
    """
    agg = F.max(key) if largest else F.min(key)
    best = df.groupBy(*by).agg(agg.alias("_best")).select(
        *[F.col(c).alias(f"_g_{c}") for c in by], "_best"
    )
    # a NULL group is a group too (as a window partition is); its key must match
    cond = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by] + [F.col(key) == F.col("_best")]
    return df.join(best, on=cond, how="inner").drop(*[f"_g_{c}" for c in by], "_best")


def top_n(df: DataFrame, n: int, order: Sequence, tiebreak: Sequence = ()) -> DataFrame:
    """Global top-``n`` rows; planned as ``TakeOrderedAndProject`` (a per-task
    heap of ``n`` rows, then one merge), so no full sort of the input."""
    return df.orderBy(*order, *tiebreak).limit(n)


def _postgres_order(keys: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_first(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys]


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` sorted as PostgreSQL's ORDER BY sorts: ``"name"`` ascending with
    NULLs last, ``"-name"`` descending with NULLs first.  A distributed range
    sort; operators return unsorted rows unless a caller asks."""
    return df.orderBy(*_postgres_order(keys))


def with_positions(df: DataFrame, *keys: str, out: str = "position") -> DataFrame:
    """``df`` plus each row's place (from 1) in the order of ``ordered(df, *keys)``.

    ``ROW_NUMBER() OVER (ORDER BY ...)`` would bring all rows to one task.  Here they are dealt by
    ranges of the keys and sorted inside each range; a row's number within its range, plus the
    number of rows in the ranges before, is its place.  The sorted rows are written
    once to the session's checkpoint folder, as both the numbers and the counts must see the
    same ranges; the counts, one per range, go through the driver.

    Keys should make rows distinct (add a tie-break): rows that tie are numbered in any
    order, and they share a range, which only further keys can split.  Runs jobs when
    called; an empty table gives no rows.
    """
    if checkpoint_dir(df.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    order = _postgres_order(keys)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()).checkpoint()
    # the id is the number of the partition, then 33 bits for the row inside it
    part, row = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.cast("int").alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    before, offsets = 0, []
    for r in sorted(counts):
        offsets.append((r["_part"], before))
        before += r["_n"]
    first = df.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    # one row per range of the sort: at most spark.sql.shuffle.partitions
    numbered = placed.withColumn("_part", part.cast("int")).join(F.broadcast(first), "_part")
    return numbered.select(*[F.col(quoted(c)) for c in df.columns], (F.col("_before") + row + 1).alias(out))


def packed_order_key(df: DataFrame, date_col: str, int_col: str):
    """``(date_col, int_col)`` as one ``decimal(38,0)`` with the same order:
    ``days * 10^20 + (int_col + 2^63)``.

    ``max_by(x, struct(...))`` keeps a struct in its buffer, which only the
    sort-based aggregate can hold, so every map task would sort its input;
    a decimal buffer fits the hash aggregate.  Returns None when the column
    types do not allow the packing (then use the struct).
    """
    from decimal import Decimal

    from pyspark.sql.types import DateType, IntegerType, LongType, ShortType

    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if not isinstance(types.get(date_col), DateType):
        return None
    if not isinstance(types.get(int_col), (LongType, IntegerType, ShortType)):
        return None
    days = F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date")).cast("decimal(38,0)")
    low = F.col(int_col).cast("decimal(38,0)") + F.lit(Decimal(2 ** 63))
    return (days * F.lit(Decimal(10 ** 20)) + low).cast("decimal(38,0)")
