"""Column expressions that keep PostgreSQL answers on Spark.

Every helper returns a ``Column`` built from Spark's own functions, so it is
evaluated inside whole-stage code generation; none of them is a UDF.  Each one
exists because the obvious Spark spelling gives a *different* answer without
raising (integer division, ``to_char`` patterns, week numbers, rounding of
doubles, the minute field of an interval).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from casebook.schemas import MEASURE_DIGITS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# text cleaning
# --------------------------------------------------------------------------
def null_if(c: str | Column, *sentinels: str) -> Column:
    """NULL when the value is one of ``sentinels``, else the value.

    A NULL input stays NULL.
    """
    c = col(c)
    return F.when(c.isin(*sentinels), F.lit(None).cast("string")).otherwise(c)


def trim_chars(c: str | Column, chars: str) -> Column:
    """``TRIM(BOTH chars FROM c)``: strips any of ``chars`` from both ends."""
    return F.btrim(col(c), F.lit(chars))


def strip_unit(c: str | Column, rules: list[tuple[str, str, str]],
               sentinels: tuple[str, ...] = ("null", "")) -> Column:
    """Sentinels to NULL, then the first matching unit rule trims its chars.

    ``rules`` are ``(match, pattern, chars)`` with ``match`` one of
    ``'suffix'`` (``LIKE '%pattern'``) or ``'contains'`` (``LIKE '%pattern%'``).
    """
    c = col(c)
    out = F.when(c.isin(*sentinels), F.lit(None).cast("string"))
    for match, pattern, chars in rules:
        test = c.endswith(pattern) if match == "suffix" else c.contains(pattern)
        out = out.when(test, trim_chars(c, chars))
    return out.otherwise(c)


# --------------------------------------------------------------------------
# dates and times
# --------------------------------------------------------------------------
def week_of_year_blocks(d: str | Column) -> Column:
    """``to_char(d, 'WW')``: week 1 is 1-7 January, then 7-day blocks; no year."""
    return (F.floor((F.dayofyear(col(d)) - 1) / 7) + 1).cast("bigint")


def year_range(d: str | Column, year: int, after: bool = False) -> Column:
    """``year(d) = year`` (or ``> year``) as a half-open range on the raw column.

    A range keeps the predicate a plain comparison, so it reaches the Parquet
    scan as a pushed filter; ``year(d) = y`` would not.
    """
    d = col(d)
    start = F.lit(_dt.date(year, 1, 1))
    end = F.lit(_dt.date(year + 1, 1, 1))
    if after:
        return d >= end
    return (d >= start) & (d < end)


# English day names as TO_CHAR(..., 'Day') prints them,
# indexed by Spark's dayofweek (1 = Sunday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(ts: str | Column, pad: bool = True) -> Column:
    """``TO_CHAR(ts, 'Day')``: English day name, blank-padded to 9 characters.

    Spark's own ``to_char`` reads ``'Day'`` as a number format and returns
    garbage; ``date_format`` goes through the session time zone.  The name is
    looked up from the day of the week of the date, which no zone changes.
    """
    name = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.dayofweek(col(ts).cast("date")))
    return F.rpad(name, 9, " ") if pad else name


def minutes_between(start: str | Column, end: str | Column, mode: str = "field") -> Column:
    """Minutes from ``start`` to ``end`` as ``bigint``.

    ``mode='field'`` is ``DATE_PART('minute', end - start)``: the minute
    *field* of the interval, which wraps at 60 and drops hours and days.
    ``mode='total'`` is the whole elapsed minutes (truncated).
    """
    start, end = col(start), col(end)
    # the difference of two timestamp_ntz values is a day-time interval: no
    # session time zone (and no daylight-saving gap) enters the arithmetic,
    # which ``timestampdiff`` would bring in
    if mode == "field":
        return F.extract(F.lit("MINUTE"), end - start).cast("bigint")
    if mode == "total":
        return (end - start).cast("interval minute").cast("bigint")
    raise ValueError(f"mode must be 'field' or 'total', not {mode!r}")


def days_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` for dates, in days (Spark's ``-`` would give an interval)."""
    return F.datediff(col(end), col(start)).cast("bigint")


# --------------------------------------------------------------------------
# arithmetic with PostgreSQL rounding
# --------------------------------------------------------------------------
def _div(a: Column, b: Column) -> Column:
    """Integer quotient, truncated.  ``div`` on integers held as decimals is
    exact, where ``/`` rounds the quotient to six digits first.  NULL for b = 0."""
    whole = F.when(b != 0, b)
    return F.call_function("div", a.cast("decimal(38,0)"), whole.cast("decimal(38,0)"))


def int_div(a: str | Column, b: str | Column) -> Column:
    """PostgreSQL ``int / int``: integer division truncating toward zero.

    Spark's ``/`` on integers returns a double (``7 / 2 = 3.5``).  NULL when
    ``b`` is 0 (Spark raises under ANSI, PostgreSQL raises too).
    """
    return _div(col(a), col(b)).cast("bigint")


def round_ratio(num: str | Column, den: str | Column, digits: int = 0) -> Column:
    """``ROUND(num / den, digits)`` for integer ``num``/``den``, half away from zero.

    Computed in integers - ``(2*|num|*10^d + |den|) div (2*|den|)`` - so it is
    exact: rounding an average held as a double (``avg`` of integers in Spark)
    can land on the wrong side of .5.  Returns ``decimal(18, digits)``, or
    ``bigint`` when ``digits == 0``.  NULL when ``den`` is 0 or NULL.
    """
    num, den = col(num).cast("decimal(38,0)"), col(den).cast("decimal(38,0)")
    scale = 10 ** digits
    mag = _div(F.abs(num) * (2 * scale) + F.abs(den), F.abs(den) * 2)
    signed = F.when((num < 0) != (den < 0), -mag).otherwise(mag)
    if digits == 0:
        return signed.cast("bigint")
    # scale is a power of ten up to 10^6, so six digits hold the quotient
    return (signed.cast("decimal(32,0)") / F.lit(scale)).cast(DecimalType(18, digits))


def scaled(c: str | Column, digits: int = MEASURE_DIGITS) -> Column:
    """A decimal with up to ``digits`` decimals as an exact integer (x * 10^digits)."""
    return (col(c) * F.lit(10 ** digits)).cast("decimal(38,0)")


def strict_cast(c: str | Column, to: DataType, lenient: bool = False) -> Column:
    """The value as ``to``; text that is no such value raises, as ``::`` does in
    PostgreSQL, whatever the session's ANSI setting.  ``lenient`` gives NULL."""
    c = col(c)
    value = c.try_cast(to)
    if lenient:
        return value
    bad = F.raise_error(F.concat(F.lit(f"not a {to.simpleString()}: "), c)).cast(to)
    return F.when(c.isNotNull() & value.isNull(), bad).otherwise(value)


def count_distinct(c: str | Column, approx_rsd: float | None = None) -> Column:
    """``COUNT(DISTINCT c)`` as ``bigint``: exact by default (a two-level
    aggregate whose first level shuffles every distinct key); with
    ``approx_rsd`` a HyperLogLog++ sketch of that relative standard deviation,
    merged map-side, so only one small sketch per task is shuffled."""
    c = col(c)
    if approx_rsd is None:
        return F.countDistinct(c).cast("bigint")
    return F.approx_count_distinct(c, approx_rsd).cast("bigint")


def quoted(name: str) -> str:
    """A column name as ``F.col`` reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
