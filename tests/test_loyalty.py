"""Loyalty operators on the diner rows; goldens derived by hand (FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

from conftest import rows

from casebook.operators import loyalty as L


def d(s):
    return dt.date.fromisoformat(s)


def test_l1_spend(diner):
    out = L.spend_per_customer(*diner[:2])
    assert rows(out) == [("A", Decimal("76.00")), ("B", Decimal("74.00")), ("C", Decimal("36.00"))]


def test_l2_visit_days(diner):
    assert rows(L.visit_days(diner[0])) == [("A", 4), ("B", 6), ("C", 2)]


def test_l3_first_items_keeps_ties(diner):
    assert rows(L.first_items(*diner[:2])) == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_l4_top_item(diner):
    assert rows(L.top_items(*diner[:2], n=1)) == [("ramen", 8)]
    assert rows(L.top_items(*diner[:2], n=3)) == [("curry", 4), ("ramen", 8), ("sushi", 3)]


def test_l5_favourite_items(diner):
    assert rows(L.favourite_items(*diner[:2])) == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3),
    ]


def test_l6_first_after_join(diner):
    assert rows(L.first_after_join(*diner)) == [("A", d("2021-01-07"), "curry"), ("B", d("2021-01-11"), "sushi")]


def test_l7_last_before_join(diner):
    assert rows(L.last_before_join(*diner)) == [
        ("A", d("2021-01-01"), "curry"), ("A", d("2021-01-01"), "sushi"), ("B", d("2021-01-04"), "sushi"),
    ]


def test_l8_spend_before_join(diner):
    assert rows(L.spend_before_join(*diner)) == [("A", 2, Decimal("25.00")), ("B", 2, Decimal("40.00"))]
    assert rows(L.spend_before_join(*diner, items="all")) == [("A", 2, Decimal("25.00")), ("B", 3, Decimal("40.00"))]


def test_l9_points(diner):
    assert rows(L.points(*diner[:2])) == [("A", Decimal("860.00")), ("B", Decimal("940.00")), ("C", Decimal("360.00"))]


def test_l10_bonus_points(diner):
    assert rows(L.points_with_bonus(*diner)) == [("A", Decimal("1370.00")), ("B", Decimal("820.00"))]


def test_l10_year_parameter(diner):
    assert rows(L.points_with_bonus(*diner, year=2020)) == []


def test_l11_member_flag(diner):
    out = L.sales_with_membership(*diner)
    assert out.count() == 15
    flags = rows(out.where("member = 'Y'").groupBy("customer_id").count())
    assert flags == [("A", 4), ("B", 3)]
    assert rows(out.where("customer_id = 'C'"), "member") == [("N",)] * 3


def test_l12_rank_with_gaps(diner):
    out = L.ranked_sales(*diner)
    got = rows(out, "customer_id", "order_date", "product_name", "member", "ranking")
    a = [(r[1].isoformat(), r[2], r[4]) for r in got if r[0] == "A"]
    assert a == [
        ("2021-01-01", "curry", None), ("2021-01-01", "sushi", None), ("2021-01-07", "curry", 1),
        ("2021-01-10", "ramen", 2), ("2021-01-11", "ramen", 3), ("2021-01-11", "ramen", 3),
    ]
    b = [(r[1].isoformat(), r[4]) for r in got if r[0] == "B"]
    assert b == [("2021-01-01", None), ("2021-01-02", None), ("2021-01-04", None),
                 ("2021-01-11", 1), ("2021-01-16", 2), ("2021-02-01", 3)]
    assert all(r[4] is None for r in got if r[0] == "C")


def test_l12_rank_equals_window_rank(diner):
    """The pre-aggregated rank equals RANK() over the raw rows."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    flat = L.sales_with_membership(*diner)
    w = Window.partitionBy("customer_id", "member").orderBy("order_date")
    direct = flat.withColumn("ranking", F.when(F.col("member") == "N", None).otherwise(F.rank().over(w)))
    assert rows(L.ranked_sales(*diner)) == rows(direct.select(*L.ranked_sales(*diner).columns))


def test_metamorphic_last_before_first_after(diner):
    first = {r.customer_id: r.order_date for r in L.first_after_join(*diner).collect()}
    last = {r.customer_id: r.order_date for r in L.last_before_join(*diner).collect()}
    assert all(last[c] < first[c] for c in last if c in first)
