"""Subscription lifecycle: journeys, churn, plan after trial, state as of a
date, time to conversion, transitions.

Inputs: ``subscriptions(customer_id, plan_id, start_date[, tiebreak])`` - an
event log - and ``plans(plan_id, plan_name, price)``, a fixed five-row
dimension (Spark broadcasts it by its known size; no hint needed).

Percentages are "of all customers": a scalar subquery
(``DataFrame.scalar()``), evaluated once, as in the reference - never a
cross join.  Per-customer questions are grouped aggregates (``max_by``,
conditional ``min``/``count``) rather than windows wherever the semantics
allow, so a hot customer is combined map-side; the window that remains (row
2 after trial) is bounded by ``WindowGroupLimit``, the next-row question
(transitions) holds a customer's days, not rows, and the histogram of days counts
pairs from running sums over days.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.expr import count_distinct, days_between, int_div, round_ratio, year_range
from casebook.operators.distinct import count_ids
from casebook.operators.ranking import packed_order_key
from casebook.operators.sequence import next_in_group


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _all_customers(subs: DataFrame) -> Column:
    """``(SELECT COUNT(DISTINCT customer_id) FROM subscriptions)``."""
    return subs.select(F.countDistinct("customer_id")).scalar()


def _order_cols(order: str, tiebreak: str | None) -> list[Column]:
    if order == "plan_id":
        cols = [F.col("plan_id")]
    elif order == "start_date":
        cols = [F.col("start_date"), F.col("plan_id")]
    else:
        raise ValueError("order must be 'plan_id' or 'start_date'")
    if tiebreak:
        cols.append(F.col(tiebreak))
    return cols


# S0 -------------------------------------------------------------------------
def journey(subs: DataFrame, plans: DataFrame, customers: Sequence | DataFrame | None = None) -> DataFrame:
    """Plan history (customer, plan, start date) of the chosen customers -
    a list of ids, a DataFrame of ``customer_id`` (semi-join), or all."""
    rows = subs.join(plans.select("plan_id"), on="plan_id")
    if isinstance(customers, DataFrame):
        rows = rows.join(customers.select("customer_id"), on="customer_id", how="left_semi")
    elif customers is not None:
        rows = rows.where(F.col("customer_id").isin(list(customers)))
    return rows.select("customer_id", "plan_id", "start_date")


# S1 -------------------------------------------------------------------------
def customer_count(subs: DataFrame, approx_rsd: float | None = None, dense_ids: bool = False) -> DataFrame:
    """``COUNT(DISTINCT customer_id)``; ``dense_ids`` counts by mergeable bitmaps (``operators.distinct``)."""
    if dense_ids:
        return count_ids(subs, "customer_id", "unique_customers")
    return subs.agg(count_distinct("customer_id", approx_rsd).alias("unique_customers"))


# S2 -------------------------------------------------------------------------
def starts_by_month(subs: DataFrame, plan: int = 0, grain: str = "month_number") -> DataFrame:
    """Starts of ``plan`` per month.  ``grain='month_number'`` groups by the
    month number of any year, as the reference does; ``'month_start'`` by the
    first day of each month, as its question asks."""
    if grain == "month_number":
        key = F.month("start_date").cast("bigint")
    elif grain == "month_start":
        key = F.trunc("start_date", "MM")
    else:
        raise ValueError("grain must be 'month_number' or 'month_start'")
    return subs.where(F.col("plan_id") == plan).groupBy(key.alias("month")).agg(F.count(F.lit(1)).alias("count"))


# S3 -------------------------------------------------------------------------
def starts_after_year(subs: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    """Events per plan with a start date after ``year``.  The year test is a
    date range, so it is pushed to the scan."""
    rows = subs.where(year_range("start_date", year, after=True)).join(plans, on="plan_id")
    return rows.groupBy("plan_id", "plan_name").agg(F.count(F.lit(1)).alias("count"))


# S4 -------------------------------------------------------------------------
def churn_rate(subs: DataFrame, plan: int = 4, digits: int = 1) -> DataFrame:
    """Rows of the churn plan and their share of all customers, ROUND ``digits``
    (a true ratio).  Counts rows, which equals customers while a customer
    churns once (Q-15)."""
    both = subs.agg(F.count_if(F.col("plan_id") == plan).alias("churn_count"),
                    F.countDistinct("customer_id").alias("_all"))
    return both.select(
        "churn_count", round_ratio(F.col("churn_count") * 100, F.col("_all"), digits).alias("churn_percent"))


# S5 / S6 --------------------------------------------------------------------
def nth_plan(subs: DataFrame, n: int = 2, order: str = "plan_id", tiebreak: str | None = None) -> DataFrame:
    """The ``n``-th row of each customer (``ROW_NUMBER() = n``).

    ``order='plan_id'`` reproduces the reference, which ranks by plan id and
    assumes the first row is the trial (Q-14); ``'start_date'`` ranks by date
    (plan id, then ``tiebreak``, break ties).  Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so at most ``n`` rows per
    customer and map task are shuffled and sorted.
    """
    w = Window.partitionBy("customer_id").orderBy(*_order_cols(order, tiebreak))
    return subs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == n).drop("_rn")


def churn_after_trial(subs: DataFrame, plan: int = 4, order: str = "plan_id",
                      tiebreak: str | None = None) -> DataFrame:
    """Customers whose second plan is churn: count and share, ROUND 0."""
    second = nth_plan(subs, 2, order, tiebreak)
    n = second.where(F.col("plan_id") == plan).agg(F.count(F.lit(1)).alias("customer_churn"))
    return n.select(
        "customer_churn",
        round_ratio(F.col("customer_churn") * 100, _all_customers(subs), 0).alias("churn_percent"),
    )


def _percentage(part: Column, whole: Column, exact_pct: bool) -> Column:
    """Truncated integer percentage, or with ``exact_pct`` rounded to two digits."""
    return round_ratio(part * 100, whole, 2) if exact_pct else int_div(part * 100, whole)


def plan_after_trial(subs: DataFrame, plans: DataFrame, order: str = "plan_id",
                     tiebreak: str | None = None, exact_pct: bool = False) -> DataFrame:
    """Plan taken second, per plan: customers and their truncated percentage
    of all customers (integer division, as the reference), or with
    ``exact_pct`` the percentage rounded to two digits."""
    second = nth_plan(subs, 2, order, tiebreak)
    counts = second.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customer_count"))
    return counts.join(plans, on="plan_id").select(
        "plan_id", "plan_name", "customer_count",
        _percentage(F.col("customer_count"), _all_customers(subs), exact_pct).alias("percentage"),
    )


# S7 -------------------------------------------------------------------------
def latest_as_of(subs: DataFrame, cutoff, tiebreak: str | None = None, method: str = "aggregate") -> DataFrame:
    """Each customer's last plan with ``start_date <= cutoff``.

    The reference takes ``ROW_NUMBER() ... ORDER BY start_date DESC = 1``;
    ties on a date are broken by ``tiebreak`` (largest last), else plan id.
    ``method='aggregate'`` is one ``max_by`` per customer - a hash aggregate,
    partial on the map side, no sort (date and tie-break packed into one
    decimal key); ``'window'`` is the row-number form, kept for comparison.
    """
    rows = subs.where(F.col("start_date") <= F.lit(_as_date(cutoff)))
    keys = [F.col("start_date"), F.col(tiebreak) if tiebreak else F.col("plan_id")]
    if method == "aggregate":
        key = packed_order_key(rows, "start_date", tiebreak or "plan_id")
        key = F.struct(*keys) if key is None else key
        return rows.groupBy("customer_id").agg(F.max_by("plan_id", key).alias("plan_id"))
    if method == "window":
        w = Window.partitionBy("customer_id").orderBy(*[k.desc() for k in keys])
        return (
            rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select("customer_id", "plan_id")
        )
    raise ValueError("method must be 'aggregate' or 'window'")


def state_as_of(subs: DataFrame, plans: DataFrame, cutoff, tiebreak: str | None = None,
                method: str = "aggregate", exact_pct: bool = False) -> DataFrame:
    """Customers per plan as of ``cutoff``, with the truncated percentage of
    all customers (including those who start later); ``exact_pct`` rounds it
    to two digits instead."""
    latest = latest_as_of(subs, cutoff, tiebreak, method)
    counts = latest.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customer_count"))
    return counts.join(plans, on="plan_id").select(
        "plan_id", "plan_name", "customer_count",
        _percentage(F.col("customer_count"), _all_customers(subs), exact_pct).alias("percentage"),
    )


# S8 -------------------------------------------------------------------------
def upgraded_in_year(subs: DataFrame, plan: int = 3, year: int = 2020, approx_rsd: float | None = None,
                     dense_ids: bool = False) -> DataFrame:
    """Customers who took ``plan`` in ``year``; ``dense_ids`` as in ``customer_count``."""
    rows = subs.where((F.col("plan_id") == plan) & year_range("start_date", year))
    if dense_ids:
        return count_ids(rows, "customer_id", "customer_count")
    return rows.agg(count_distinct("customer_id", approx_rsd).alias("customer_count"))


# S9 / S10 -------------------------------------------------------------------
def _day(c: str) -> Column:
    return days_between(F.lit(_dt.date(1970, 1, 1)), F.col(c))


def days_to_plan(subs: DataFrame, from_plan: int = 0, to_plan: int = 3) -> DataFrame:
    """``ROUND(AVG(to_date - from_date))`` over the pairs of the self-join on
    customer, computed without forming the pairs.

    Per customer with ``a`` rows of ``to_plan`` and ``t`` rows of
    ``from_plan``, the join has ``a*t`` pairs whose differences sum to
    ``t*sum(to days) - a*sum(from days)``; one grouped aggregate gives these,
    so a customer with many rows costs one row per map task, not a product.
    """
    p = F.col("plan_id")
    per_customer = subs.where(p.isin(from_plan, to_plan)).groupBy("customer_id").agg(
        F.count(F.when(p == to_plan, 1)).alias("_a"),
        F.count(F.when(p == from_plan, 1)).alias("_t"),
        F.sum(F.when(p == to_plan, _day("start_date"))).alias("_sa"),
        F.sum(F.when(p == from_plan, _day("start_date"))).alias("_st"),
    )
    pairs = per_customer.where((F.col("_a") > 0) & (F.col("_t") > 0)).select(
        (F.col("_a") * F.col("_t")).alias("_pairs"),
        (F.col("_t") * F.col("_sa") - F.col("_a") * F.col("_st")).alias("_diff"),
    )
    return pairs.agg(round_ratio(F.sum("_diff"), F.sum("_pairs"), 0).alias("avg_days"))


def conversion_days(subs: DataFrame, from_plan: int = 0, to_plan: int = 3) -> DataFrame:
    """(customer_id, days, pairs): the days from ``from_plan`` to ``to_plan``
    over the pairs of the self-join on customer.

    Rows are counted per (customer, plan, day) before the join, so it pairs a
    customer's distinct days, and ``pairs`` carries the product of the counts:
    repeated rows add no joined row.  A hot customer is split by AQE."""
    p = F.col("plan_id")
    per_day = subs.where(p.isin(from_plan, to_plan)).groupBy("customer_id", "plan_id", "start_date").agg(
        F.count(F.lit(1)).alias("_n"))
    start = per_day.where(p == from_plan).select("customer_id", F.col("start_date").alias("_from"), F.col("_n").alias("_f"))
    end = per_day.where(p == to_plan).select("customer_id", F.col("start_date").alias("_to"), F.col("_n").alias("_t"))
    return start.join(end, on="customer_id").select(
        "customer_id", days_between("_from", "_to").alias("days"), (F.col("_f") * F.col("_t")).alias("pairs"))


def _probe_counts(subs: DataFrame, from_plan: int, to_plan: int, edges: Sequence[int]) -> DataFrame:
    """One row: ``s0 .. sn`` and ``pairs``; ``s<i>`` is the number of pairs of the self-join
    on customer whose days lie below ``edges[i]``.

    Rows are counted per (customer, plan, day).  A ``from_plan`` day ``t`` asks, for every edge,
    how many ``to_plan`` rows of its customer lie before ``t + edge``: a running sum over the
    customer's sorted days answers, so a customer costs days x edges rows, never days x days.
    """
    p = F.col("plan_id")
    per_day = subs.where(p.isin(from_plan, to_plan) & F.col("start_date").isNotNull() & F.col("customer_id").isNotNull()).groupBy(
        "customer_id", "plan_id", "start_date").agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(None).cast("int")
    event = F.when(p == to_plan, F.array(F.struct(F.col("start_date").alias("_day"), none.alias("_edge"))))
    probes = F.when(p == from_plan, F.array(*[
        F.struct(F.date_add("start_date", e).alias("_day"), F.lit(i).alias("_edge")) for i, e in enumerate(edges)]))
    empty = F.array().cast("array<struct<_day:date,_edge:int>>")
    rows = per_day.select("customer_id", "_n", F.inline(F.concat(F.coalesce(event, empty), F.coalesce(probes, empty))))
    arrived = F.when(F.col("_edge").isNull(), F.col("_n")).otherwise(0)
    # on one day the question comes before the events: strictly earlier ones count
    ordered = Window.partitionBy("customer_id").orderBy("_day", F.col("_edge").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("customer_id").orderBy("_day", F.col("_edge").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    counted = rows.withColumns({"_before": F.sum(arrived).over(ordered), "_all": F.sum(arrived).over(whole)})

    def pairs(value: str, edge: int) -> Column:
        n = (F.col("_n") * F.col(value)).cast("decimal(38,0)")
        return F.coalesce(F.sum(F.when(F.col("_edge") == edge, n)), F.lit(0).cast("decimal(38,0)"))

    return counted.agg(*[pairs("_before", i).alias(f"s{i}") for i in range(len(edges))], pairs("_all", 0).alias("pairs"))


def days_to_plan_histogram(subs: DataFrame, from_plan: int = 0, to_plan: int = 3,
                           lo: int = 0, hi: int = 360, n: int = 12) -> DataFrame:
    """Pairs per ``WIDTH_BUCKET(days, lo, hi, n)`` with the reference's
    ``'a - b days'`` label.  Buckets are half-open ([0,30), [30,60), ...);
    days below ``lo`` fall in bucket 0 and from ``hi`` on in bucket ``n+1``,
    labelled by the same arithmetic.  Only occupied buckets appear.  The range
    must divide evenly, as the label prints whole days.  No pair is formed, see
    ``_probe_counts``."""
    if n < 1 or hi <= lo or (hi - lo) % n:
        raise ValueError(f"{n} buckets do not divide {lo} to {hi} days evenly")
    width = (hi - lo) // n
    edges = [lo + i * width for i in range(n + 1)]
    below = _probe_counts(subs, from_plan, to_plan, edges)
    sums = [F.lit(0), *[F.col(f"s{i}") for i in range(n + 1)], F.col("pairs")]
    buckets = F.array(*[F.struct(
        F.lit(f"{lo + (b - 1) * width} - {lo + b * width} days").alias("breakdown"),
        (sums[b + 1] - sums[b]).cast("bigint").alias("customers")) for b in range(n + 2)])
    return below.select(F.inline(buckets)).where("customers > 0")


# S11 ------------------------------------------------------------------------
def transitions(subs: DataFrame, from_plan: int = 2, to_plan: int = 1, year: int | None = 2020,
                filter_first: bool = True, tiebreak: str | None = None, method: str = "days") -> DataFrame:
    """Rows of ``from_plan`` whose next row (by date, then ``tiebreak``) is
    ``to_plan`` - ``LEAD(plan_id)`` per customer.

    ``filter_first=True`` keeps only ``year``'s rows *before* taking the next
    row, as the reference does, so a December -> January change is missed
    (Q-18); ``False`` takes the next row over all history and then counts the
    ``from_plan`` rows that start in ``year``.

    ``method='days'`` (default): equal rows collapse with a count before the shuffle, the
    next row is taken inside each (customer, day), and a day hands on its first and last plan
    and its hits; the window over days holds one row per day of a customer, whatever the rows.
    ``'chunk'`` gives every row its next one by ``sequence.next_in_group``; ``'window'`` is the
    plain ``lead`` window, which sorts each customer's whole history in one task.
    """
    rows = subs
    if year is not None and filter_first:
        rows = rows.where(year_range("start_date", year))
    order = ["start_date", tiebreak or "plan_id"]
    in_year = F.lit(True) if year is None or filter_first else year_range("start_date", year)
    if method == "days":
        return _transitions_by_day(rows, from_plan, to_plan, tiebreak or "plan_id", in_year)
    if method == "chunk":
        cols = list(dict.fromkeys(["customer_id", "plan_id", *order]))
        nxt = next_in_group(rows.select(*cols), "customer_id", order, "plan_id", out="_next")
    elif method == "window":
        w = Window.partitionBy("customer_id").orderBy(*order)
        nxt = rows.withColumn("_next", F.lead("plan_id").over(w))
    else:
        raise ValueError("method must be 'days', 'chunk' or 'window'")
    hit = (F.col("plan_id") == from_plan) & (F.col("_next") == to_plan) & in_year
    return nxt.where(hit).agg(F.count(F.lit(1)).alias("customer_count"))


def _transitions_by_day(rows: DataFrame, from_plan: int, to_plan: int, tiebreak: str, in_year: Column) -> DataFrame:
    keys = list(dict.fromkeys(["customer_id", "start_date", tiebreak, "plan_id"]))
    distinct = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    day = Window.partitionBy("customer_id", "start_date").orderBy(tiebreak, "plan_id")
    inside = distinct.withColumn("_next", F.struct(F.lead("plan_id").over(day).alias("p")))
    leaves = F.col("plan_id") == from_plan
    # of n equal rows, n - 1 are followed by themselves
    hits = F.when(leaves & (F.col("_next.p") == to_plan), 1).otherwise(0) + F.when(
        leaves & F.lit(from_plan == to_plan), F.col("_n") - 1).otherwise(0)
    place = F.struct(tiebreak, F.col("plan_id").alias("_p"))
    days = inside.groupBy("customer_id", "start_date").agg(
        F.sum(hits).alias("_hits"), F.min(place).alias("_first"), F.max(place).alias("_last"))
    following = F.lead("_first._p").over(Window.partitionBy("customer_id").orderBy("start_date"))
    days = days.withColumn("_after", following)
    crossing = F.when((F.col("_last._p") == from_plan) & (F.col("_after") == to_plan), 1).otherwise(0)
    total = F.sum(F.when(in_year, F.col("_hits") + crossing).otherwise(0))
    return days.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("customer_count"))
