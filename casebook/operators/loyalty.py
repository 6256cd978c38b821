"""Customer loyalty: spend, visits, first / last / favourite items, points.

Inputs: ``sales(customer_id, order_date, product_id)``,
``menu(product_id, product_name, price)``, ``members(customer_id, join_date)``.

Scale notes.  ``sales`` is the fact; ``menu`` and ``members`` grow with the
data too (one row per product / customer), so no join here carries a
broadcast hint: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), and
sort-merge joins it otherwise.  Rank-1 questions are a grouped min/max joined
back (``ranking.extreme_with_ties``), not a window over raw rows, so a customer
with a third of all sales is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.expr import count_distinct
from casebook.operators.ranking import extreme_with_ties, top_n

MONEY_OUT = "decimal(18,2)"


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, on="product_id", how="inner")


def _near_join(rows: DataFrame, members: DataFrame, after: bool) -> DataFrame:
    """``rows`` (already one per customer and day, or customer and item) of members,
    on their side of the join date.  A hot customer brings its days or items to
    this join, not its sales."""
    cond = F.col("order_date") >= F.col("join_date") if after else F.col("order_date") < F.col("join_date")
    return rows.join(members, on="customer_id", how="inner").where(cond)


def _items_on_day(sales: DataFrame, menu: DataFrame, members: DataFrame, after: bool) -> DataFrame:
    """Items of each member's first day from the join date on, or last before it."""
    days = sales.join(menu, on="product_id", how="left_semi").select("customer_id", "order_date").distinct()
    pick = F.min("order_date") if after else F.max("order_date")
    chosen = _near_join(days, members, after).groupBy("customer_id").agg(pick.alias("order_date"))
    # joined on (customer, day), which spreads a customer over its days
    return _priced(sales.join(chosen, on=["customer_id", "order_date"], how="left_semi"), menu).select(
        "customer_id", "order_date", "product_name").distinct()


# L1 -------------------------------------------------------------------------
def spend_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Total spent per customer: ``SUM(price)`` over sales joined to menu."""
    return (
        _priced(sales, menu)
        .groupBy("customer_id")
        .agg(F.sum("price").cast(MONEY_OUT).alias("total_amount"))
    )


# L2 -------------------------------------------------------------------------
def visit_days(sales: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Distinct visit days per customer (exact ``COUNT(DISTINCT order_date)``
    unless ``approx_rsd`` asks for a sketch)."""
    return sales.groupBy("customer_id").agg(count_distinct("order_date", approx_rsd).alias("total_days_visit"))


# L3 -------------------------------------------------------------------------
def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Every item bought on the customer's first day (ties kept, one row per
    (customer, item))."""
    firsts = (
        _priced(sales, menu)
        .groupBy("customer_id", "product_name")
        .agg(F.min("order_date").alias("order_date"))
    )
    return extreme_with_ties(firsts, ["customer_id"], "order_date").select("customer_id", "product_name")


# L4 -------------------------------------------------------------------------
def top_items(sales: DataFrame, menu: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most purchased items overall; ties broken by name.

    Sales are counted per product id first, so the menu join sees at most one
    row per product instead of one per sale."""
    per_product = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    named = per_product.join(menu, on="product_id", how="inner")
    counts = named.groupBy("product_name").agg(
        F.sum(F.when(F.col("product_name").isNotNull(), F.col("_n")).otherwise(0)).cast("bigint").alias("most_purchased")
    )
    return top_n(counts, n, [F.desc("most_purchased")], [F.asc("product_name")])


# L5 -------------------------------------------------------------------------
def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Each customer's most purchased item(s), ties kept."""
    counts = _priced(sales, menu).groupBy("customer_id", "product_name").agg(
        F.count("product_name").alias("order_count")
    )
    return extreme_with_ties(counts, ["customer_id"], "order_count", largest=True).select(
        "customer_id", "product_name", "order_count"
    )


# L6 / L7 --------------------------------------------------------------------
def first_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Item(s) bought on the first day on or after joining; non-members drop out."""
    return _items_on_day(sales, menu, members, after=True)


def last_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Item(s) bought on the last day before joining."""
    return _items_on_day(sales, menu, members, after=False)


# L8 -------------------------------------------------------------------------
def spend_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame, items: str = "distinct") -> DataFrame:
    """Items and amount per member before joining.

    ``items='distinct'`` counts distinct item names, as the reference does;
    ``items='all'`` counts every item bought.  Sales are summed per (customer,
    day) before the member join; an item counts when its first day is before
    the join date, so names meet the members once per (customer, name).
    """
    if items not in ("distinct", "all"):
        raise ValueError("items must be 'distinct' or 'all'")
    priced = _priced(sales, menu)
    per_day = priced.groupBy("customer_id", "order_date").agg(
        F.count("product_name").alias("_n"), F.sum("price").alias("_amount"))
    spent = _near_join(per_day, members, after=False).groupBy("customer_id").agg(
        F.sum("_n").cast("bigint").alias("items_ordered"), F.sum("_amount").cast(MONEY_OUT).alias("total_amount"))
    if items == "all":
        return spent
    first_day = priced.groupBy("customer_id", "product_name").agg(F.min("order_date").alias("order_date"))
    names = _near_join(first_day, members, after=False).groupBy("customer_id").agg(
        F.countDistinct("product_name").cast("bigint").alias("items_ordered"))
    return spent.drop("items_ordered").join(names, on="customer_id").select(
        "customer_id", "items_ordered", "total_amount")


# L9 / L10 -------------------------------------------------------------------
def default_bonus() -> Column:
    """The reference's double-points item: product 1."""
    return F.col("product_id") == 1


def points(sales: DataFrame, menu: DataFrame, bonus: Column | None = None,
           per_dollar: int = 10, multiplier: int = 2) -> DataFrame:
    """Points per customer: ``per_dollar`` per unit of price, times
    ``multiplier`` for items matching ``bonus`` (a predicate on menu columns).
    Points are priced on the menu first, so the rule runs once per item."""
    bonus = default_bonus() if bonus is None else bonus
    rate = F.when(bonus, per_dollar * multiplier).otherwise(per_dollar)
    priced_menu = menu.select("product_id", (F.col("price") * rate).alias("points"))
    return (
        sales.join(priced_menu, on="product_id", how="inner")
        .groupBy("customer_id")
        .agg(F.sum("points").cast(MONEY_OUT).alias("total_points"))
    )


def points_with_bonus(sales: DataFrame, menu: DataFrame, members: DataFrame, bonus: Column | None = None,
                      per_dollar: int = 10, multiplier: int = 2, bonus_days: int = 7,
                      month: int = 1, year: int | None = None) -> DataFrame:
    """Members' points in ``month`` (of any year unless ``year`` is given),
    doubled for ``bonus`` items and for everything in the ``bonus_days`` from
    the join date (join date included, end excluded)."""
    bonus = default_bonus() if bonus is None else bonus
    rows = sales.join(members, on="customer_id", how="inner").join(menu, on="product_id", how="inner")
    d = F.col("order_date")
    in_window = (d >= F.col("join_date")) & (d < F.date_add(F.col("join_date"), bonus_days))
    pts = F.col("price") * F.when(bonus | in_window, per_dollar * multiplier).otherwise(per_dollar)
    cond = F.month(d) == month
    if year is not None:
        cond = cond & (F.year(d) == year)
    return rows.where(cond).groupBy("customer_id").agg(F.sum(pts).cast(MONEY_OUT).alias("points"))


# L11 / L12 ------------------------------------------------------------------
def sales_with_membership(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every sale with item, price and a member flag (Y from the join date on;
    N before it and for customers who never joined)."""
    rows = sales.join(members, on="customer_id", how="left").join(menu, on="product_id", how="inner")
    member = F.when(F.col("order_date") >= F.col("join_date"), F.lit("Y")).otherwise(F.lit("N"))
    return rows.select(
        "customer_id", "order_date", "product_name", F.col("price").cast("decimal(12,2)").alias("price"),
        member.alias("member"),
    )


def ranked_sales(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """``sales_with_membership`` plus ``RANK()`` by date within (customer,
    member) for member rows, NULL for non-member rows.

    A rank is 1 + the number of the group's rows on earlier dates.  Those counts
    come from member sales counted per (customer, date) - the menu only filters,
    by a semi-join - so the window runs over at most one row per calendar day of
    a customer; they are joined to the member rows alone, and the other rows
    are appended as they are.
    """
    flat = sales_with_membership(sales, menu, members)
    since = sales.join(members, on="customer_id").where(F.col("order_date") >= F.col("join_date"))
    counted = since.join(menu.groupBy("product_id").agg(F.count(F.lit(1)).alias("_m")), on="product_id")
    per_day = counted.groupBy("customer_id", "order_date").agg(F.sum("_m").alias("_n"))
    before = Window.partitionBy("customer_id").orderBy("order_date").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_day.select("customer_id", "order_date", (
        F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("bigint").alias("ranking"))
    columns = ["customer_id", "order_date", "product_name", "price", "member", "ranking"]
    member = flat.where(F.col("member") == "Y").join(ranks, on=["customer_id", "order_date"]).select(*columns)
    other = flat.where(F.col("member") == "N").withColumn("ranking", F.lit(None).cast("bigint")).select(*columns)
    return member.unionByName(other)
