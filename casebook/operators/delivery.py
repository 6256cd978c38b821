"""Delivery operations: cleaning of text columns, order and runner metrics.

Inputs (raw, as loaded): ``customer_orders(order_id, customer_id, pizza_id,
exclusions, extras, order_time)`` - one row per pizza - and
``runner_orders(order_id, runner_id, pickup_time, distance, duration,
cancellation)`` - one row per order, payload columns as text.

Cleaning is a narrow projection (no shuffle).  The metrics join the two facts
on ``order_id``; where a metric needs only per-order facts of
``customer_orders`` the pizza rows are aggregated per order *before* the join,
so the join shuffles at most one row per order and time instead of one per
pizza; where it needs more (``sum_over_delivered``), pizza rows stream through
the join.  The reference treats "delivered" three ways (no cancellation,
a pickup time, a duration); each operator keeps its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from casebook.functions.expr import (
    count_distinct,
    int_div,
    minutes_between,
    null_if,
    round_ratio,
    scaled,
    strict_cast,
    strip_unit,
    week_of_year_blocks,
    weekday_name,
)
from casebook.operators.distinct import count_ids
from casebook.operators.ranking import top_n
from casebook.schemas import MEASURE, MEASURE_DIGITS

# The text forms the reference cleans away, per column.
LIST_SENTINELS = ("null", "")
PICKUP_SENTINELS = ("null",)
MEASURE_SENTINELS = ("null", "")
CANCELLATION_SENTINELS = ("null", "", "NaN")
# (LIKE form, pattern, characters trimmed from both ends), first match wins
DISTANCE_UNITS = [("suffix", "km", "km")]
DURATION_UNITS = [("contains", "mins", "mins"), ("suffix", "minute", "minute"), ("suffix", "minutes", "minutes")]


# C1 -------------------------------------------------------------------------
def clean_customer_orders(co: DataFrame, sentinels: tuple[str, ...] = LIST_SENTINELS) -> DataFrame:
    """exclusions / extras: ``'null'`` and ``''`` become NULL; all else passes."""
    return co.withColumns({
        "exclusions": null_if("exclusions", *sentinels),
        "extras": null_if("extras", *sentinels),
    })


# C2 -------------------------------------------------------------------------
def clean_runner_orders(ro: DataFrame, typed: bool = False, lenient: bool = False) -> DataFrame:
    """The reference's cleaning, text in, text out.

    pickup_time: NULL only for ``'null'``.  distance: NULL for ``'null'``/``''``;
    a trailing ``km`` is trimmed as a character set (``'13.4 km'`` ->
    ``'13.4 '``).  duration: likewise for ``mins`` anywhere, or a trailing
    ``minute`` / ``minutes``.  cancellation: NULL for ``'null'``, ``''``, ``'NaN'``.
    ``typed=True`` also casts: pickup_time to ``timestamp_ntz``, distance and
    duration to ``decimal(38,10)``; text that is neither raises unless ``lenient``.
    """
    out = ro.withColumns({
        "pickup_time": null_if("pickup_time", *PICKUP_SENTINELS),
        "distance": strip_unit("distance", DISTANCE_UNITS, MEASURE_SENTINELS),
        "duration": strip_unit("duration", DURATION_UNITS, MEASURE_SENTINELS),
        "cancellation": null_if("cancellation", *CANCELLATION_SENTINELS),
    })
    return typed_runner_orders(out, lenient) if typed else out


def typed_runner_orders(clean: DataFrame, lenient: bool = False) -> DataFrame:
    """Casts of the cleaned text columns, as the reference's ``::`` casts: bad
    text raises.  ``lenient=True`` gives NULL for it."""
    return clean.withColumns({
        "pickup_time": strict_cast("pickup_time", TimestampNTZType(), lenient),
        "distance": strict_cast("distance", MEASURE, lenient),
        "duration": strict_cast("duration", MEASURE, lenient),
    })


def register_clean_views(customer_orders: DataFrame, runner_orders: DataFrame,
                         names: tuple[str, str] = ("updated_customer_orders", "updated_runner_orders")) -> None:
    """Cleaned tables as temporary views, so questions can also be asked in
    Spark SQL.  Views are lazy: nothing is copied, each query re-plans from
    the raw tables (persist the DataFrames first if many queries share them)."""
    clean_customer_orders(customer_orders).createOrReplaceTempView(names[0])
    clean_runner_orders(runner_orders).createOrReplaceTempView(names[1])


def _delivered(ro: DataFrame) -> DataFrame:
    # "delivered" as in part A: no cancellation
    return ro.where(F.col("cancellation").isNull())


# P1 - P10 -------------------------------------------------------------------
def pizza_count(co: DataFrame) -> DataFrame:
    return co.agg(F.count(F.lit(1)).alias("num_pizza_ordered"))


def order_count(co: DataFrame, approx_rsd: float | None = None, dense_ids: bool = False) -> DataFrame:
    """``COUNT(DISTINCT order_id)``; ``dense_ids`` counts by mergeable bitmaps (``operators.distinct``)."""
    if dense_ids:
        return count_ids(co, "order_id", "order_count")
    return co.agg(count_distinct("order_id", approx_rsd).alias("order_count"))


def delivered_per_runner(ro: DataFrame) -> DataFrame:
    """Orders without a cancellation per runner (runners with none are absent)."""
    return _delivered(ro).groupBy("runner_id").agg(F.count("order_id").alias("order_count"))


def sum_over_delivered(co: DataFrame, ro: DataFrame, keys: list[str], measures: dict) -> DataFrame:
    """Additive ``measures`` of the pizza rows of delivered orders, by ``keys``.

    The pizza rows stream through the sort-merge join on ``order_id``, a hot order split by
    AQE, and only their sums by ``keys`` are held.  Sums per order before the join would hold
    about a row per pizza, in memory that grows with the partition.  Deliveries are
    counted per order first, so an order repeated on both sides is never multiplied out:
    its sums are weighted by that count, which gives the join's totals, duplicates included.
    """
    times = _delivered(ro).groupBy("order_id").agg(F.count(F.lit(1)).alias("_times"))
    sums = co.join(times, on="order_id").groupBy(*keys, "_times").agg(*[m.alias(n) for n, m in measures.items()])
    return sums.groupBy(*keys).agg(*[F.sum(F.col(n) * F.col("_times")).alias(n) for n in measures])


def delivered_by_type(co: DataFrame, ro: DataFrame, names: DataFrame) -> DataFrame:
    """Delivered pizzas per pizza name."""
    per_type = sum_over_delivered(co, ro, ["pizza_id"], {"_n": F.count("pizza_id")})
    # names are joined to one row per pizza type, never to the pizza rows
    return per_type.join(names, on="pizza_id").groupBy("pizza_name").agg(
        F.sum("_n").cast("bigint").alias("pizza_count")
    )


def ordered_by_customer_type(co: DataFrame, names: DataFrame) -> DataFrame:
    """Pizzas *ordered* per customer and pizza name."""
    per_type = co.groupBy("customer_id", "pizza_id").agg(F.count("pizza_id").alias("_n"))
    return per_type.join(names, on="pizza_id").groupBy("customer_id", "pizza_name").agg(
        F.sum("_n").cast("bigint").alias("pizza_count")
    )


def pizzas_per_order(co: DataFrame, ro: DataFrame, top: int | None = None) -> DataFrame:
    """Pizzas per delivered order; every order, or the ``top`` largest
    (ties broken by order id)."""
    per_order = sum_over_delivered(co, ro, ["order_id"], {"pizzas_per_order": F.count("pizza_id")}).select(
        "order_id", F.col("pizzas_per_order").cast("bigint").alias("pizzas_per_order")
    )
    if top is None:
        return per_order
    return top_n(per_order, top, [F.desc("pizzas_per_order")], [F.asc("order_id")])


def change_profile(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Per customer, delivered pizzas with at least one change and with none."""
    exc, ext = F.col("exclusions"), F.col("extras")
    sums = sum_over_delivered(co, ro, ["customer_id"], {
        "at_least_1_change": F.sum(F.when(exc.isNotNull() | ext.isNotNull(), 1).otherwise(0)),
        "no_change": F.sum(F.when(exc.isNull() & ext.isNull(), 1).otherwise(0)),
    })
    return sums.select("customer_id", *[F.col(c).cast("bigint").alias(c) for c in ("at_least_1_change", "no_change")])


def both_changes(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Delivered pizzas with both exclusions and extras (NULL if none delivered)."""
    both = F.col("exclusions").isNotNull() & F.col("extras").isNotNull()
    sums = sum_over_delivered(co, ro, [], {"_b": F.sum(F.when(both, 1).otherwise(0))})
    return sums.select(F.col("_b").cast("bigint").alias("pizza_with_exclusions_extras"))


def orders_by_hour(co: DataFrame) -> DataFrame:
    return co.groupBy(F.hour("order_time").cast("bigint").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("pizza_ordered")
    )


def orders_by_weekday(co: DataFrame, pad: bool = True) -> DataFrame:
    """Pizza rows per day name; names blank-padded to 9 as ``TO_CHAR 'Day'``."""
    return co.groupBy(weekday_name("order_time", pad).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("pizza_ordered")
    )


# R1 - R7 --------------------------------------------------------------------
def signups_per_week(runners: DataFrame, with_year: bool = False) -> DataFrame:
    """Sign-ups per week of year, weeks counted from 1 January.  The year is
    ignored, as the reference does, unless ``with_year`` makes it a key."""
    keys = [week_of_year_blocks("registration_date").alias("week")]
    if with_year:
        keys.insert(0, F.year("registration_date").cast("bigint").alias("year"))
    return runners.groupBy(*keys).agg(F.count("runner_id").alias("runner_signup"))


def _picked_up(ro_typed: DataFrame) -> DataFrame:
    # "delivered" as in part B: a pickup time
    return ro_typed.where(F.col("pickup_time").isNotNull())


def avg_pickup_minutes(co: DataFrame, ro_typed: DataFrame, mode: str = "field") -> DataFrame:
    """Mean minutes from order to pickup per runner, ROUND 2.

    Minutes are taken once per distinct (order, runner, minutes), as the
    reference's ``SELECT DISTINCT``; ``mode='field'`` is its minute field of
    the interval, ``mode='total'`` the elapsed minutes.
    """
    times = co.select("order_id", "order_time").distinct()
    rows = times.join(_picked_up(ro_typed).select("order_id", "runner_id", "pickup_time"), on="order_id")
    per_order = rows.select(
        "order_id", "runner_id", minutes_between("order_time", "pickup_time", mode).alias("pickup_min")
    ).distinct()
    return per_order.groupBy("runner_id").agg(
        round_ratio(F.sum("pickup_min"), F.count("pickup_min"), 2).alias("avg_pickup_min")
    )


def prep_time_by_size(co: DataFrame, ro_typed: DataFrame, mode: str = "field") -> DataFrame:
    """Mean preparation minutes by number of pizzas in the order, ROUND 2.

    Pizzas are counted per (order, order time) before the join; the counts of
    times that give the same minutes are then summed, which is the reference's
    ``GROUP BY order_id, prep_time``.
    """
    per_time = co.groupBy("order_id", "order_time").agg(F.count("pizza_id").alias("_n"))
    rows = per_time.join(_picked_up(ro_typed).select("order_id", "pickup_time"), on="order_id")
    per_order = rows.groupBy(
        "order_id", minutes_between("order_time", "pickup_time", mode).alias("prep_time")
    ).agg(F.sum("_n").alias("pizza_ordered"))
    return per_order.groupBy("pizza_ordered").agg(
        round_ratio(F.sum("prep_time"), F.count("prep_time"), 2).alias("avg_prep_time")
    )


def avg_distance(co: DataFrame, ro_typed: DataFrame, weight: str = "pizza") -> DataFrame:
    """Mean distance per customer, ROUND 2.

    ``weight='pizza'`` averages over pizza rows, as the reference does (an
    order of three pizzas counts three times); ``weight='order'`` counts each
    order once.  Pizzas are counted per (order, customer) before the join.
    """
    per_order = co.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("_n"))
    if weight == "order":
        per_order = per_order.withColumn("_n", F.lit(1).cast("bigint"))
    elif weight != "pizza":
        raise ValueError("weight must be 'pizza' or 'order'")
    rows = per_order.join(_picked_up(ro_typed).select("order_id", "distance"), on="order_id")
    known = F.col("distance").isNotNull()
    return rows.groupBy("customer_id").agg(
        round_ratio(
            F.sum(scaled("distance") * F.col("_n")),
            F.sum(F.when(known, F.col("_n"))).cast("decimal(25,0)") * F.lit(10 ** MEASURE_DIGITS),
            2,
        ).alias("avg_distance")
    )


def duration_spread(ro_typed: DataFrame) -> DataFrame:
    """Longest and shortest duration and their difference, in one pass."""
    d = F.col("duration")
    return _picked_up(ro_typed).agg(
        F.max(d).cast("decimal(18,2)").alias("longest_duration"),
        F.min(d).cast("decimal(18,2)").alias("shortest_duration"),
        (F.max(d) - F.min(d)).cast("decimal(18,2)").alias("diff"),
    )


def delivery_speed(co: DataFrame, ro_clean: DataFrame, factor: int = 60, lenient: bool = False) -> DataFrame:
    """Speed per delivery: distance / duration * ``factor``, ROUND 2.

    Distances are km and durations minutes, so ``factor=60`` gives km/h; the
    reference multiplies by 2 (``factor=2`` reproduces it).  Pizzas are
    counted per (order, order time) first; NULL speed for a zero duration.
    """
    per_order = co.groupBy("order_id", "order_time").agg(F.count("pizza_id").alias("pizza_ordered"))
    # the reference prints the cleaned text and computes on its casts
    ro_both = ro_clean.select(
        "order_id", "runner_id", "distance", "duration",
        strict_cast("pickup_time", TimestampNTZType(), lenient).alias("_pickup"),
        strict_cast("distance", MEASURE, lenient).alias("_d"),
        strict_cast("duration", MEASURE, lenient).alias("_t"),
    )
    rows = per_order.join(ro_both.where(F.col("_pickup").isNotNull()), on="order_id")
    return rows.select(
        "order_id", "runner_id", "distance", "duration", "pizza_ordered",
        round_ratio(scaled("_d") * factor, scaled("_t"), 2).alias("avg_speed"),
    )


def success_rate(ro_clean: DataFrame, exact_pct: bool = False) -> DataFrame:
    """Per runner: orders, orders with a duration, and the integer percentage
    (``100 * delivered / orders`` truncated, as integer division does), or with
    ``exact_pct`` the percentage rounded to two digits."""
    part, whole = F.count("duration") * 100, F.count("order_id")
    return ro_clean.groupBy("runner_id").agg(
        F.count("order_id").alias("orders"),
        F.count("duration").alias("delivered"),
        (round_ratio(part, whole, 2) if exact_pct else int_div(part, whole)).alias("percent_delivered"),
    )
