"""Bitmaps count distinct ids exactly, merge, and shuffle a few kilobytes."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.operators import delivery, lifecycle
from casebook.operators.distinct import cardinality, count_ids, id_bitmaps, merged
from casebook.sources import driver_tables as T

SF = "/root/testdata/sf0.01"
EDGES = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**31, -(2**31), 2**62, -(2**62)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from(EDGES), st.integers(-(2**40), 2**40)), max_size=60))
def test_equals_count_distinct(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert count_ids(df, "id", "n").collect()[0].n == len({i for i in ids if i is not None})


def test_groups_and_merging(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["x", "y", None]), rnd.randrange(3), rnd.choice([None, *range(70_000, 70_400)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, day int, id long")
    want = {g: len({i for a, _, i in data if a == g and i is not None}) for g in ("x", "y", None)}
    days = [id_bitmaps(df.where(F.col("day") == d), "id", ["g"]) for d in range(3)]
    whole = merged(days, ["g"])
    assert {r.g: r.n for r in cardinality(whole, "n", ["g"]).collect()} == want
    # a day loaded twice changes nothing
    assert {r.g: r.n for r in cardinality(merged([whole, days[1]], ["g"]), "n", ["g"]).collect()} == want


def test_operators_agree(spark):
    co, subs = T.customer_orders_raw(spark, SF), T.subscriptions(spark, SF)
    assert delivery.order_count(co, dense_ids=True).collect() == delivery.order_count(co).collect()
    assert lifecycle.customer_count(subs, dense_ids=True).collect() == lifecycle.customer_count(subs).collect()
    assert lifecycle.upgraded_in_year(subs, year=1996, dense_ids=True).collect() == lifecycle.upgraded_in_year(subs, year=1996).collect()
    assert delivery.order_count(co.limit(0), dense_ids=True).collect()[0].order_count == 0
