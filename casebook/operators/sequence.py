"""``LEAD`` within a group that stays balanced when one group is huge.

``lead(v).over(Window.partitionBy(g).orderBy(k))`` sends every row of a group to
one task; a customer with a third of all rows would be sorted and scanned by a
single core.  Here a group is cut into chunks that keep the order - by default
the calendar months of its first order column - and the next row is taken by a
window inside (group, chunk).  Only a chunk's last row needs a row from
elsewhere: the first row of the group's next chunk.  Those first rows are one per
(group, chunk), so the second window runs over a group's months, not its rows.

Groups and chunks are matched null-safe: the NULL group is a group, as in
``LEAD``, and rows with a NULL first order column form its first chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK, _HAS_NEXT, _HEAD = "_chunk", "_has_next", "_head"


def month_chunk(first_order: str) -> Column:
    """The default chunk of a date or timestamp column: its calendar month."""
    return F.trunc(F.col(first_order), "MM")


def next_in_group(df: DataFrame, group: str, order: Sequence[str], value: str, out: str = "next_value",
                  chunk: Column | None = None) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the next row of the same ``group`` in
    ``order`` (NULL for a group's last row), like ``LEAD(value)``.

    ``order`` should make rows unique within a group (add a tie-break);
    otherwise rows with equal keys are taken in an arbitrary order, as by
    ``LEAD``.  ``chunk`` is the grain at which a group may be split: a
    non-decreasing function of ``order[0]`` (NULL for NULL), by default its
    month.  It never depends on the size of the data.
    """
    rows = df.withColumn(_CHUNK, month_chunk(order[0]) if chunk is None else chunk)
    inside = Window.partitionBy(group, _CHUNK).orderBy(*order)
    rows = rows.withColumns({
        out: F.lead(value).over(inside),
        _HAS_NEXT: F.lead(F.lit(True)).over(inside),
    })
    # the first row of every chunk, handed to the chunk before it
    first = df.withColumn(_CHUNK, month_chunk(order[0]) if chunk is None else chunk).groupBy(group, _CHUNK).agg(
        F.min(F.struct(*order, F.struct(F.col(value).alias("v")).alias("_value"))).alias("_first"))
    following = first.select(
        F.col(group).alias("_g"), F.col(_CHUNK).alias("_c"),
        F.lead("_first._value").over(Window.partitionBy(group).orderBy(_CHUNK)).alias(_HEAD))
    joined = rows.join(
        following, F.col(group).eqNullSafe(F.col("_g")) & F.col(_CHUNK).eqNullSafe(F.col("_c")), "left")
    return joined.withColumn(
        out, F.when(F.col(_HAS_NEXT), F.col(out)).otherwise(F.col(f"{_HEAD}.v"))
    ).drop(_CHUNK, _HAS_NEXT, _HEAD, "_g", "_c")
