"""Declared schemas of the logical tables (never inferred).

Money is ``decimal(12,2)``; the reference declares whole-dollar INTEGER prices
for the diner and ``DECIMAL(5,2)`` for plans.  Identifiers are ``long`` so the
same operators run on the generated fact tables, whose keys are 64-bit.
"""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(12, 2)
# Distances and durations keep every digit of their text up to ten decimals.
MEASURE_DIGITS = 10
MEASURE = DecimalType(38, MEASURE_DIGITS)


def _s(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- loyalty --------------------------------------------------------------
SALES = _s(("customer_id", StringType()), ("order_date", DateType()), ("product_id", LongType()))
MENU = _s(("product_id", LongType()), ("product_name", StringType()), ("price", MONEY))
MEMBERS = _s(("customer_id", StringType()), ("join_date", DateType()))

# --- delivery -------------------------------------------------------------
CUSTOMER_ORDERS = _s(
    ("order_id", LongType()), ("customer_id", LongType()), ("pizza_id", IntegerType()),
    ("exclusions", StringType()), ("extras", StringType()), ("order_time", TimestampNTZType()),
)
RUNNER_ORDERS = _s(
    ("order_id", LongType()), ("runner_id", LongType()), ("pickup_time", StringType()),
    ("distance", StringType()), ("duration", StringType()), ("cancellation", StringType()),
)
RUNNERS = _s(("runner_id", LongType()), ("registration_date", DateType()))
PIZZA_NAMES = _s(("pizza_id", IntegerType()), ("pizza_name", StringType()))
PIZZA_RECIPES = _s(("pizza_id", IntegerType()), ("toppings", StringType()))
PIZZA_TOPPINGS = _s(("topping_id", IntegerType()), ("topping_name", StringType()))

# --- subscriptions --------------------------------------------------------
PLANS = _s(("plan_id", IntegerType()), ("plan_name", StringType()), ("price", DecimalType(5, 2)))
SUBSCRIPTIONS = _s(("customer_id", LongType()), ("plan_id", IntegerType()), ("start_date", DateType()))
