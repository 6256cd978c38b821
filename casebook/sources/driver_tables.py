"""Logical inputs of the case studies, derived from the generated star schema.

The three case studies come with tiny inline tables (15 sales rows, 2,650
subscription rows, no delivery rows at all).  To run them at scale every
logical table is *derived by Spark* from the generated TPC-H-like Parquet
tables, so each query's work grows with the data:

==================  ==========================================================
logical table       derivation
==================  ==========================================================
``sales``           one row per lineitem: customer = order's customer,
                    order_date = order date, product = part
``menu``            one row per part: name = ``p_type``, price = retail price
``members``         customers with an urgent order; join date = first one
``customer_orders`` one pizza per lineitem, with messy exclusions / extras
``runner_orders``   one delivery per order, every cleaning trap present
``runners``         one per customer, registered on the first order date
``plans``           the five subscription plans
``subs_log``        one plan event per order (plan = priority digit - 1)
``subscriptions``   first date of each (customer, plan) - unique, as the
                    reference data is
==================  ==========================================================

Everything here is narrow projection or a grouped aggregate; nothing is
collected.  The oracle SQL in ``casebook.plans.oracle_tables`` spells the same
definitions for DuckDB.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from casebook import schemas
from casebook.sources.files import load

# Declared schemas of the generated tables this module reads; ``load`` compares
# them with the files' own, so a missing or retyped column fails.
SOURCE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table; only the columns a query uses are read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SOURCE_SCHEMAS:
        return load(spark, path, StructType.fromDDL(SOURCE_SCHEMAS[name]))
    return spark.read.parquet(path)


# The five subscription plans (id, name, monthly price; churn
# has no price).  They equal the reference's plan table.
PLAN_ROWS = [
    (0, "trial", Decimal("0.00")),
    (1, "basic monthly", Decimal("9.90")),
    (2, "pro monthly", Decimal("19.90")),
    (3, "pro annual", Decimal("199.00")),
    (4, "churn", None),
]

# The two pizzas of the delivery case study, their standard
# toppings (comma-separated topping ids) and the twelve toppings.
PIZZA_NAME_ROWS = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPE_ROWS = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPING_ROWS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]


def _order_time(o: DataFrame) -> F.Column:
    # order date (midnight) + (orderkey mod 1440) minutes
    return F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))


# ---------------------------------------------------------------------------
# loyalty
# ---------------------------------------------------------------------------
def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
    )


def menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_name"),
        F.col("p_retailprice").cast(schemas.MONEY).alias("price"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return (
        o.where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("join_date"))
    )


# ---------------------------------------------------------------------------
# delivery
# ---------------------------------------------------------------------------
def customer_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pizza per lineitem, with the raw exclusions/extras text forms
    (NULL, ``'null'``, ``''``, a single id, a list of ids)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ln = F.col("l_linenumber")
    exclusions = (
        F.when(F.col("l_returnflag") == "N", F.lit("null"))
        .when(F.col("l_returnflag") == "A", F.when(ln % 2 == 0, F.lit("")))
        .otherwise(F.when(ln % 3 == 0, F.lit("2, 6")).otherwise(F.lit("4")))
    )
    extras = (
        F.when(ln % 4 == 0, F.lit(None).cast("string"))
        .when(ln % 4 == 1, F.lit("null"))
        .when(ln % 4 == 2, F.lit(""))
        .otherwise(F.lit("1, 5"))
    )
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("l_partkey") % 2 + 1).cast("int").alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        _order_time(o).alias("order_time"),
        ln.alias("line_no"),
    )


def runner_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order; text columns carry every form the cleaning
    handles (``'null'``, ``''``, ``'NaN'``, unit suffixes with and without a
    blank, bare numbers).  Orders with status F are cancelled."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    cancelled = F.col("o_orderstatus") == "F"
    dist = (5 + k % 37).cast("string")
    mins = (10 + k % 31).cast("string")
    # a timestamp_ntz cast to text is zone-free 'yyyy-MM-dd HH:mm:ss'
    pickup = F.timestamp_add("MINUTE", 5 + k % 90, _order_time(o)).cast("string")
    distance = (
        F.when(k % 5 == 0, F.lit("null"))
        .when(k % 5 == 1, F.lit(""))
        .when(k % 5 == 2, F.concat(dist, F.lit(".5km")))
        .when(k % 5 == 3, F.concat(dist, F.lit(".4 km")))
        .otherwise(dist)
    )
    duration = (
        F.when(k % 6 == 0, F.concat(mins, F.lit("mins")))
        .when(k % 6 == 1, F.concat(mins, F.lit(" mins")))
        .when(k % 6 == 2, F.concat(mins, F.lit(" minute")))
        .when(k % 6 == 3, F.concat(mins, F.lit(" minutes")))
        .when(k % 6 == 4, mins)
        .otherwise(F.lit("null"))
    )
    cancellation = F.when(
        cancelled,
        F.when(k % 2 == 0, F.lit("Restaurant Cancellation")).otherwise(F.lit("Customer Cancellation")),
    ).otherwise(
        F.when(k % 4 == 0, F.lit("NaN")).when(k % 4 == 1, F.lit("")).when(k % 4 == 2, F.lit("null"))
    )
    nul = F.lit("null")
    return o.select(
        k.alias("order_id"),
        (F.expr("o_orderkey div 30") % 100).alias("runner_id"),
        F.when(cancelled, nul).otherwise(pickup).alias("pickup_time"),
        F.when(cancelled, nul).otherwise(distance).alias("distance"),
        F.when(cancelled, nul).otherwise(duration).alias("duration"),
        cancellation.alias("cancellation"),
    )


def runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("runner_id")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("registration_date")
    )


def pizza_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PIZZA_NAME_ROWS, schemas.PIZZA_NAMES)


def pizza_recipes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PIZZA_RECIPE_ROWS, schemas.PIZZA_RECIPES)


def pizza_toppings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PIZZA_TOPPING_ROWS, schemas.PIZZA_TOPPINGS)


# ---------------------------------------------------------------------------
# subscriptions
# ---------------------------------------------------------------------------
def plans(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLAN_ROWS, schemas.PLANS)


def subs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a plan event; ``tiebreak`` orders events of one day."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.col("o_orderkey").alias("tiebreak"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First start date per (customer, plan): unique like the reference data."""
    return (
        subs_log(spark, sf_dir)
        .groupBy("customer_id", "plan_id")
        .agg(F.min("start_date").alias("start_date"))
    )
