"""Relations between driver queries on the generated tables (sf0.001)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from casebook.operators import lifecycle as S
from casebook.plans import catalogue as C
from casebook.sources import driver_tables as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda name: qs[name](spark, SF)


def test_change_profile_sums_to_delivered_pizzas(q):
    p7 = q("p7_change_profile").agg(F.sum(F.col("at_least_1_change") + F.col("no_change"))).first()[0]
    p4 = q("p4_delivered_by_type").agg(F.sum("pizza_count")).first()[0]
    p6 = q("p6_pizzas_per_order").agg(F.sum("pizzas_per_order")).first()[0]
    assert p7 == p4 == p6


def test_ingredient_totals_are_summed_lists(q):
    totals = {r.topping_name: r.quantity for r in q("x6_ingredient_totals").collect()}
    # x8 rates every delivered (not cancelled) order exactly once
    delivered = q("x5_ingredient_lists").join(q("x8_ratings").select("order_id"), "order_id")
    summed = {}
    for r in delivered.select("ingredients").collect():
        for item in r.ingredients.split(": ", 1)[1].split(", "):
            m = re.match(r"(\d+)x(.+)", item)
            n, name = (int(m.group(1)), m.group(2)) if m else (1, item)
            summed[name] = summed.get(name, 0) + n
    assert summed == totals


def test_histogram_counts_conversions(spark, q):
    buckets = q("s10_days_histogram").agg(F.sum("customers")).first()[0]
    assert buckets == S.conversion_days(T.subscriptions(spark, SF)).agg(F.sum("pairs")).first()[0]


def test_state_covers_customers_by_cutoff(spark, q):
    total = q("s7_state_as_of").agg(F.sum("customer_count")).first()[0]
    log = T.subs_log(spark, SF)
    assert total == log.where(F.col("start_date") <= F.lit(C.S7_CUTOFF).cast("date")).select("customer_id").distinct().count()


def test_items_all_at_least_distinct(q):
    a = {r.customer_id: r.items_ordered for r in q("l8_all_items").collect()}
    d = {r.customer_id: r.items_ordered for r in q("l8_spend_before_join").collect()}
    assert a.keys() == d.keys() and all(a[c] >= d[c] for c in a)


def test_rank_one_rows_are_first_after_join(q):
    first = q("l12_rank_all").where("ranking = 1").select("customer_id", "order_date", "product_name").distinct()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, q("l6_first_after_join").collect()))
