"""The chunked LEAD equals the window LEAD, also with one huge group."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebook.operators.sequence import next_in_group
from casebook.plans.inspect import physical_plan


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        # group 0 holds half of all rows; ids above 2^53, where doubles lose them; a NULL group
        g = 2**53 if i % 2 == 0 else rnd.choice([None, *range(2**53 + 1, 2**53 + 40)])
        day = None if i % 97 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400))
        data.append((g, day, i, rnd.choice([None, 1, 2, 3]), f"x{i}"))
    return spark.createDataFrame(data, "g long, day date, tb long, v int, extra string")


def _same(df):
    got = next_in_group(df, "g", ["day", "tb"], "v", out="nxt")
    w = Window.partitionBy("g").orderBy("day", "tb")
    want = df.withColumn("nxt", F.lead("v").over(w))
    assert set(got.columns) == set(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)


def test_equals_window_lead(skewed):
    _same(skewed)


def test_equals_window_lead_without_exchange_reuse(spark, skewed):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        _same(skewed)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_chunk_is_a_parameter(skewed):
    got = next_in_group(skewed, "g", ["day", "tb"], "v", out="nxt", chunk=F.trunc("day", "YEAR"))
    month = next_in_group(skewed, "g", ["day", "tb"], "v", out="nxt")
    key = lambda df: sorted(map(tuple, df.select("tb", "nxt").collect()))
    assert key(got) == key(month)


def test_plan_has_no_python_and_no_single_partition(skewed):
    plan = physical_plan(next_in_group(skewed, "g", ["day", "tb"], "v"))
    for bad in ("MapInPandas", "SinglePartition", "rangepartitioning"):
        assert bad not in plan


def test_hot_group_is_split_over_chunks(spark, skewed):
    hot = skewed.where(F.col("g") == 2**53).withColumn("m", F.trunc("day", "MM"))
    assert hot.repartition(16, "g", "m").select(F.spark_partition_id()).distinct().count() > 4


def test_transitions_methods_agree(subs):
    from casebook.operators import lifecycle as S

    s, _ = subs
    for ff in (True, False):
        a = S.transitions(s, year=2020, filter_first=ff, method="chunk").collect()
        b = S.transitions(s, year=2020, filter_first=ff, method="window").collect()
        assert a == b


# ---------------------------------------------------------------- S10 and S11 without pairs or hot tasks
def test_transitions_by_day_equal_the_window_on_repeated_rows(spark):
    from casebook.operators import lifecycle as S

    rnd = random.Random(21)
    data = []
    for i in range(4000):  # half of all rows on one customer in one month
        c = 1 if i % 2 else rnd.choice([None, *range(2, 30)])
        day = None if i % 211 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(30 if c == 1 else 500))
        data.append((c, rnd.choice([None, 0, 1, 1, 2, 2, 4]), day, rnd.randrange(50)))
    s = spark.createDataFrame(data, "customer_id long, plan_id int, start_date date, tb int")
    for a, b in ((2, 1), (1, 2), (2, 2), (0, 4)):
        for ff in (True, False):
            for year in (2020, None):
                kw = dict(from_plan=a, to_plan=b, year=year, filter_first=ff)
                assert S.transitions(s, **kw).collect() == S.transitions(s, method="window", **kw).collect(), kw
    unique = spark.createDataFrame(
        [(*r[:3], i) for i, r in enumerate(data)], "customer_id long, plan_id int, start_date date, tb long")
    for ff in (True, False):
        kw = dict(filter_first=ff, tiebreak="tb")
        assert S.transitions(unique, **kw).collect() == S.transitions(unique, method="window", **kw).collect()
    assert S.transitions(s.limit(0)).first().customer_count == 0


def test_no_task_of_the_transitions_holds_a_hot_customers_rows(spark):
    """Rows after each exchange: equal rows have collapsed before the shuffle."""
    from casebook.operators import lifecycle as S

    n = 200_000
    rows = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("customer_id"),
        (F.col("id") % 5).cast("int").alias("plan_id"),
        F.date_add(F.lit("2020-03-01").cast("date"), (F.col("id") % 31).cast("int")).alias("start_date"))
    hot = rows.where("customer_id = 7").groupBy("customer_id", "start_date", "plan_id").count()
    assert hot.count() <= 31 * 5
    plan = physical_plan(S.transitions(rows))
    assert plan.count("Exchange hashpartitioning(customer_id") >= 2
    partial = plan[:plan.rindex("Exchange hashpartitioning(customer_id")]
    assert "HashAggregate" in partial and "Join" not in plan


def test_histogram_of_days_forms_no_pair(spark):
    from casebook.operators import lifecycle as S

    days = 10_000
    one = spark.range(days).select(F.lit(1).alias("customer_id"), F.lit(0).alias("plan_id"),
                                   F.date_add(F.lit("1980-01-01").cast("date"), F.col("id").cast("int")).alias("start_date"))
    two = one.withColumn("plan_id", F.lit(3))
    s = one.unionByName(two)
    plan = physical_plan(S.days_to_plan_histogram(s))
    assert "Join" not in plan
    got = {r.breakdown: r.customers for r in S.days_to_plan_histogram(s).collect()}
    assert sum(got.values()) == days * days
    assert got["0 - 30 days"] == sum(days - d for d in range(30))
    assert got["-30 - 0 days"] == days * (days - 1) // 2
    assert got["360 - 390 days"] == sum(days - d for d in range(360, days))


def test_histogram_equals_the_self_join(spark):
    from casebook.operators import lifecycle as S

    rnd = random.Random(4)
    data = [(rnd.choice([None, 1, 1, 1, *range(2, 20)]), rnd.choice([0, 3, 1, None]),
             rnd.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(500))])) for _ in range(1500)]
    s = spark.createDataFrame(data, "customer_id long, plan_id int, start_date date")
    a = s.where("plan_id = 3").select("customer_id", F.col("start_date").alias("a"))
    t = s.where("plan_id = 0").select("customer_id", F.col("start_date").alias("t"))
    for lo, hi, n in ((0, 360, 12), (-60, 60, 4), (10, 17, 7)):
        b = F.width_bucket(F.datediff("a", "t"), F.lit(lo), F.lit(hi), F.lit(n))
        w = (hi - lo) // n
        want = {f"{lo + (r.b - 1) * w} - {lo + r.b * w} days": r["count"]
                for r in a.join(t, "customer_id").groupBy(b.alias("b")).count().collect() if r.b is not None}
        assert {r.breakdown: r.customers for r in S.days_to_plan_histogram(s, lo=lo, hi=hi, n=n).collect()} == want
