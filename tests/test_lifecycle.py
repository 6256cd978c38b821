"""Subscription operators on the sample and hand-made rows of conftest."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from casebook.operators import lifecycle as S


def d(s):
    return dt.date.fromisoformat(s)


def test_s0_journey_published_rows(subs):
    s, plans = subs
    out = S.journey(s, plans, customers=[1, 2, 4])
    assert rows(out) == [
        (1, 0, d("2020-08-01")), (1, 1, d("2020-08-08")), (2, 0, d("2020-09-20")), (2, 3, d("2020-09-27")),
        (4, 0, d("2020-01-17")), (4, 1, d("2020-01-24")), (4, 4, d("2020-04-21")),
    ]
    as_frame = S.journey(s, plans, customers=s.sparkSession.createDataFrame([(1,), (2,), (4,)], "customer_id long"))
    assert rows(as_frame) == rows(out)
    assert S.journey(s, plans).count() == s.count()


def test_s1_s2_s3(subs):
    s, plans = subs
    assert rows(S.customer_count(s)) == [(11,)]
    assert rows(S.starts_by_month(s)) == [(1, 3), (2, 1), (3, 1), (5, 1), (6, 1), (7, 1), (8, 1), (9, 1), (11, 1)]
    assert rows(S.starts_by_month(s, grain="month_start"))[0] == (d("2020-01-01"), 3)
    assert rows(S.starts_after_year(s, plans, 2020)) == [(1, "basic monthly", 1)]


def test_s4_churn_rate(subs):
    assert rows(S.churn_rate(subs[0])) == [(3, Decimal("27.3"))]


def test_s5_s6_after_trial(subs):
    s, plans = subs
    assert rows(S.churn_after_trial(s)) == [(1, 9)]
    assert rows(S.plan_after_trial(s, plans)) == [
        (1, "basic monthly", 6, 54), (3, "pro annual", 4, 36), (4, "churn", 1, 9),
    ]
    # by date, customer 15 starts with the annual plan, so the trial is second
    assert rows(S.plan_after_trial(s, plans, order="start_date")) == [
        (0, "trial", 1, 9), (1, "basic monthly", 3, 27), (2, "pro monthly", 3, 27), (3, "pro annual", 3, 27),
        (4, "churn", 1, 9),
    ]


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_s7_state_as_of(subs, method):
    s, plans = subs
    assert rows(S.state_as_of(s, plans, "2020-12-31", method=method)) == [
        (0, "trial", 1, 9), (1, "basic monthly", 3, 27), (2, "pro monthly", 1, 9),
        (3, "pro annual", 3, 27), (4, "churn", 3, 27),
    ]


def test_s8_s9(subs):
    s, _ = subs
    assert rows(S.upgraded_in_year(s, 3, 2020)) == [(4,)]
    assert rows(S.days_to_plan(s)) == [(99,)]


def test_s9_counts_all_pairs_without_forming_them(spark):
    """With repeated plans the answer is the self-join's average over pairs."""
    from casebook import schemas

    data = [(1, 0, d("2020-01-01")), (1, 0, d("2020-01-11")), (1, 3, d("2020-02-01")), (1, 3, d("2020-03-02")),
            (2, 0, d("2020-01-01")), (2, 3, d("2020-01-04"))]
    s = spark.createDataFrame(data, schemas.SUBSCRIPTIONS)
    # pairs: 31, 21, 61, 51, 3 -> 167 / 5 = 33.4 -> 33
    assert rows(S.days_to_plan(s)) == [(33,)]


def test_s10_bucket_edges(subs):
    s, _ = subs
    assert rows(S.days_to_plan_histogram(s)) == [
        ("-30 - 0 days", 1), ("0 - 30 days", 1), ("30 - 60 days", 1), ("360 - 390 days", 1),
    ]


def test_s10_counts_pairs_like_s9(spark):
    """Two annual rows of one customer are two pairs, as in S9."""
    from casebook import schemas

    data = [(1, 0, d("2020-01-01")), (1, 3, d("2020-02-05")), (1, 3, d("2020-02-05")), (1, 3, d("2020-04-20"))]
    s = spark.createDataFrame(data, schemas.SUBSCRIPTIONS)
    assert rows(S.days_to_plan_histogram(s)) == [("30 - 60 days", 2), ("90 - 120 days", 1)]
    assert S.conversion_days(s).agg({"pairs": "sum"}).first()[0] == 3


def test_s10_needs_even_buckets(subs):
    s, _ = subs
    with pytest.raises(ValueError):
        S.days_to_plan_histogram(s, hi=100, n=12)
    assert sum(r.customers for r in S.days_to_plan_histogram(s, hi=96, n=12).collect()) == 4


def test_exact_percentages(subs):
    s, plans = subs
    exact = {r.plan_id: (r.customer_count, r.percentage) for r in S.plan_after_trial(s, plans, exact_pct=True).collect()}
    total = S.customer_count(s).first()[0]
    for n, pct in exact.values():
        assert pct == (Decimal(100 * n) / Decimal(total)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


def test_s11_filter_first(subs):
    s, _ = subs
    # customers 10 and 11 go 2 -> 1 inside 2020; 12 only across the year end
    assert rows(S.transitions(s, year=2020)) == [(2,)]
    assert rows(S.transitions(s, year=2020, filter_first=False)) == [(3,)]


def test_metamorphic_histogram_sums_to_pairs(subs):
    s, _ = subs
    assert sum(r.customers for r in S.days_to_plan_histogram(s).collect()) == S.conversion_days(s).agg({"pairs": "sum"}).first()[0]


def test_metamorphic_state_sums_to_customers_by_cutoff(subs):
    s, plans = subs
    total = sum(r.customer_count for r in S.state_as_of(s, plans, "2020-12-31").collect())
    assert total == s.where("start_date <= '2020-12-31'").select("customer_id").distinct().count()
