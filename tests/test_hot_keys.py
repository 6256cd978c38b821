"""A customer, or an order, with half of the rows: AQE splits the joins on it."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.operators import delivery as P
from casebook.operators import ingredients as X
from casebook.operators import lifecycle as S
from casebook.operators import loyalty as L
from casebook.plans.inspect import physical_plan

ROWS = 60_000
SMALL = {  # bytes and factors at which this little data counts as skewed
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def small(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def diner(small):
    i = small.range(ROWS, numPartitions=8)
    sales = i.select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 997)).alias("customer_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        (F.col("id") * 7919 % 3001).alias("product_id"))
    menu = small.range(3001).select(F.col("id").alias("product_id"), F.concat(F.lit("item"), "id").alias("product_name"),
                                    F.lit(5).cast("decimal(12,2)").alias("price"))
    members = sales.select("customer_id").distinct().withColumn("join_date", F.lit("2021-05-01").cast("date"))
    return sales, menu, members


@pytest.mark.parametrize("question", [
    L.first_after_join, L.last_before_join, L.spend_before_join,
    lambda *a: L.spend_before_join(*a, items="all")], ids=["l6", "l7", "l8", "l8_all"])
def test_hot_customer_collapses_before_the_member_join(diner, question):
    """Below every join on the customer alone the sales side is aggregated, partially before its shuffle."""
    plan = physical_plan(question(*diner)).split("== Initial Plan ==")[0]
    for part in plan.split("SortMergeJoin [customer_id#")[1:]:
        if not part.split("]", 1)[0].count(","):
            assert "partial_" in part or "HashAggregate(keys=[customer_id" in part


def test_member_join_sees_days_not_sales(diner):
    sales, _, members = diner
    days = sales.where("customer_id = 'hot'").select("customer_id", "order_date").distinct()
    assert L._near_join(days, members, after=True).count() <= 300 < sales.where("customer_id = 'hot'").count()


def test_pairs_of_a_hot_customer_count_right(small):
    i = small.range(2000).select(
        F.lit(1).cast("long").alias("customer_id"), (F.col("id") % 2 * 3).cast("int").alias("plan_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("start_date"))
    assert S.conversion_days(i).agg(F.sum("pairs")).first()[0] == 1000 * 1000


@pytest.fixture(scope="module")
def delivery(small):
    # a hot order whose pizzas differ in customer, time and lists, so that no sum before the join collapses it
    i = small.range(ROWS, numPartitions=8)
    co = i.select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("long").alias("order_id"),
        (F.col("id") % 20011).alias("customer_id"), (F.col("id") % 2 + 1).cast("int").alias("pizza_id"),
        F.when(F.col("id") % 3 == 0, F.concat_ws(", ", F.col("id") % 12 + 1, F.col("id") % 5 + 1)).alias("exclusions"),
        F.lit(None).cast("string").alias("extras"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "order_time"))
    ro = i.select(F.col("id").alias("order_id"), (F.col("id") % 10).alias("runner_id"),
                  F.lit("2021-01-02 00:00:00").alias("pickup_time"), F.lit("10").alias("distance"),
                  F.lit("20").alias("duration"), F.lit(None).cast("string").alias("cancellation"))
    return co, ro


@pytest.mark.parametrize("name", ["p7", "r2", "r3", "r4", "r6", "x9"])
def test_hot_order_is_split(delivery, name):
    co, ro = delivery
    rot = P.typed_runner_orders(ro)
    plan = physical_plan({
        "p7": lambda: P.change_profile(co, ro),
        "r2": lambda: P.avg_pickup_minutes(co, rot, mode="total"),
        "r3": lambda: P.prep_time_by_size(co, rot),
        "r4": lambda: P.avg_distance(co, rot),
        "r6": lambda: P.delivery_speed(co, ro),
        "x9": lambda: X.delivery_facts(co, rot, X.ratings(ro)),
    }[name]())
    assert "skew=true" in plan


@pytest.mark.parametrize("name", ["p4", "p6", "p8", "x7", "x10"])
def test_hot_order_collapses_before_the_join(delivery, name):
    """Measures are summed per order first: of the hot order one row a task and type reaches the join."""
    co, ro = delivery
    plan = physical_plan({
        "p4": lambda: P.delivered_by_type(co, ro, co.sparkSession.createDataFrame([(1, "a"), (2, "b")], "pizza_id int, pizza_name string")),
        "p6": lambda: P.pizzas_per_order(co, ro),
        "p8": lambda: P.both_changes(co, ro),
        "x7": lambda: X.revenue(co, ro),
        "x10": lambda: X.net_after_runner_pay(co, P.typed_runner_orders(ro)),
    }[name]())
    join = plan.index("SortMergeJoin")
    assert "HashAggregate" in plan[join:] and "partial_" in plan[join:]


def _recipes(spark):
    return (spark.createDataFrame([(1, "1, 2"), (2, "3")], "pizza_id int, toppings string"),
            spark.createDataFrame([(i, f"t{i}") for i in range(1, 13)], "topping_id int, topping_name string"))


@pytest.mark.parametrize("name", ["p4", "p7", "x6", "x7"])
def test_memory_holds_no_row_per_pizza(delivery, name):
    """Pizza rows stream through the join: no aggregate keeps them by order and another key, and a hot order is split."""
    co, ro = delivery
    recipes, toppings = _recipes(co.sparkSession)
    plan = physical_plan({
        "p4": lambda: P.delivered_by_type(co, ro, co.sparkSession.createDataFrame([(1, "a"), (2, "b")], "pizza_id int, pizza_name string")),
        "p7": lambda: P.change_profile(co, ro),
        "x6": lambda: X.ingredient_totals(co, ro, recipes, toppings),
        "x7": lambda: X.revenue(co, ro, extra_price=X.EXTRA_PRICE),
    }[name]())
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)
    assert keys and not [k for k in keys if "order_id" in k and "," in k]
    assert "skew=true" in plan


def test_order_repeated_on_both_sides_is_weighted(small):
    i = small.range(3000)
    co = i.select(F.lit(1).cast("long").alias("order_id"), (F.col("id") % 2 + 1).cast("int").alias("pizza_id"),
                  F.lit(None).cast("string").alias("exclusions"),
                  F.when(F.col("id") % 3 == 0, "1, 5").alias("extras"))
    ro = i.select(F.lit(1).cast("long").alias("order_id"), F.lit(None).cast("string").alias("cancellation"))
    recipes, toppings = _recipes(small)
    assert X.revenue(co, ro, extra_price=X.EXTRA_PRICE).collect() == [(Decimal(3000 * (1500 * 12 + 1500 * 10 + 2000)),)]
    got = {r.topping_id: r.quantity for r in X.ingredient_totals(co, ro, recipes, toppings).collect()}
    assert got == {1: 3000 * 2500, 2: 3000 * 1500, 3: 3000 * 1500, 5: 3000 * 1000}
    assert P.sum_over_delivered(co.limit(0), ro, [], {"n": F.count(F.lit(1))}).collect() == [(None,)]
