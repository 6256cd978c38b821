"""Window-free operators equal the window / self-join forms they replace, on
random data where one customer holds about a third of all rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebook import schemas
from casebook.operators import lifecycle as S
from casebook.operators import loyalty as L


@pytest.fixture(scope="module")
def skewed_diner(spark):
    rnd = random.Random(11)
    start = dt.date(2021, 1, 1)
    sales = []
    for i in range(3000):
        c = "HOT" if i % 3 == 0 else f"c{rnd.randrange(40)}"
        sales.append((c, start + dt.timedelta(days=rnd.randrange(60)), rnd.randrange(1, 9)))
    menu = [(p, f"item{p % 5}", Decimal(rnd.randrange(5, 30))) for p in range(1, 9)]
    members = [(f"c{i}", start + dt.timedelta(days=rnd.randrange(60))) for i in range(0, 40, 2)]
    members.append(("HOT", start + dt.timedelta(days=30)))
    return (spark.createDataFrame(sales, schemas.SALES), spark.createDataFrame(menu, schemas.MENU),
            spark.createDataFrame(members, schemas.MEMBERS))


def _dense_first(df, order, cols):
    w = Window.partitionBy("customer_id").orderBy(order)
    return df.withColumn("_r", F.dense_rank().over(w)).where("_r = 1").select(*cols).distinct()


def test_first_items(skewed_diner):
    sales, menu, _ = skewed_diner
    want = _dense_first(sales.join(menu, "product_id"), F.col("order_date"), ["customer_id", "product_name"])
    assert rows(L.first_items(sales, menu)) == rows(want)


def test_favourite_items(skewed_diner):
    sales, menu, _ = skewed_diner
    counts = sales.join(menu, "product_id").groupBy("customer_id", "product_name").agg(
        F.count("product_name").alias("order_count"))
    want = _dense_first(counts, F.col("order_count").desc(), ["customer_id", "product_name", "order_count"])
    assert rows(L.favourite_items(sales, menu)) == rows(want)


@pytest.mark.parametrize("after", [True, False])
def test_around_join_date(skewed_diner, after):
    sales, menu, members = skewed_diner
    rows_ = sales.join(menu, "product_id").join(members, "customer_id")
    if after:
        got = L.first_after_join(sales, menu, members)
        want = _dense_first(rows_.where("order_date >= join_date"), F.col("order_date"),
                            ["customer_id", "order_date", "product_name"])
    else:
        got = L.last_before_join(sales, menu, members)
        want = _dense_first(rows_.where("order_date < join_date"), F.col("order_date").desc(),
                            ["customer_id", "order_date", "product_name"])
    assert rows(got) == rows(want)


def test_ranked_sales(skewed_diner):
    sales, menu, members = skewed_diner
    flat = L.sales_with_membership(sales, menu, members)
    w = Window.partitionBy("customer_id", "member").orderBy("order_date")
    want = flat.withColumn("ranking", F.when(F.col("member") == "N", None).otherwise(F.rank().over(w)))
    assert rows(L.ranked_sales(sales, menu, members)) == rows(want.select(*L.ranked_sales(sales, menu, members).columns))


def test_days_to_plan_equals_self_join(spark):
    rnd = random.Random(5)
    data = []
    for i in range(1500):
        c = 0 if i % 3 == 0 else rnd.randrange(1, 60)
        data.append((c, rnd.choice([0, 0, 3, 1]), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(300))))
    s = spark.createDataFrame(data, schemas.SUBSCRIPTIONS)
    a = s.where("plan_id = 3").select("customer_id", F.col("start_date").alias("a"))
    t = s.where("plan_id = 0").select("customer_id", F.col("start_date").alias("t"))
    pairs = a.join(t, "customer_id").select(F.datediff("a", "t").alias("d"))
    total, n = pairs.agg(F.sum("d"), F.count("d")).first()
    want = int((Decimal(total) / Decimal(n)).quantize(Decimal(1), rounding="ROUND_HALF_UP"))
    assert rows(S.days_to_plan(s)) == [(want,)]


def test_state_as_of_forms_agree(spark):
    rnd = random.Random(9)
    data = [(0 if i % 3 == 0 else rnd.randrange(1, 80), rnd.randrange(5),
             dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400))) for i in range(2000)]
    s = spark.createDataFrame(data, schemas.SUBSCRIPTIONS)
    from casebook.sources.driver_tables import plans as plan_table

    p = plan_table(spark)
    assert rows(S.state_as_of(s, p, "2020-09-30")) == rows(S.state_as_of(s, p, "2020-09-30", method="window"))


def test_null_customer_is_its_own_group(spark):
    from casebook.operators.ranking import extreme_with_ties

    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 5, "c"), ("x", 5, "d")],
                               "customer_id string, k int, v string")
    got = rows(extreme_with_ties(df, ["customer_id"], "k"))
    assert got == [(None, 1, "a"), ("x", 5, "c"), ("x", 5, "d")]


def test_approximate_distinct_is_opt_in_and_close(spark):
    from casebook.sources import driver_tables as T

    d = "/root/testdata/sf0.01"
    subs = T.subscriptions(spark, d)
    exact = S.customer_count(subs).first()[0]
    approx = S.customer_count(subs, approx_rsd=0.02).first()[0]
    assert exact == subs.select("customer_id").distinct().count()
    assert abs(approx - exact) <= 0.08 * exact
    plan = S.customer_count(subs, approx_rsd=0.02)._jdf.queryExecution().executedPlan().toString()
    assert "approx_count_distinct" in plan
