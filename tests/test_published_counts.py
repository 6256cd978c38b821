"""The published answers of the subscription questions, on the published rows.

The rows are not part of this repository.  Name a Parquet or CSV file of
``subscriptions(customer_id, plan_id, start_date)`` in CASEBOOK_SUBSCRIPTIONS to run
these; without it they are skipped.
"""

import os
from decimal import Decimal

import pytest
from conftest import rows

from casebook.operators import lifecycle as S
from casebook.sources.driver_tables import plans
from casebook.sources.files import read_table

PATH = os.environ.get("CASEBOOK_SUBSCRIPTIONS")
pytestmark = pytest.mark.skipif(not PATH, reason="CASEBOOK_SUBSCRIPTIONS names no file")


@pytest.fixture(scope="module")
def subs(spark):
    return read_table(spark, "subscriptions", PATH, fmt="csv" if PATH.endswith(".csv") else "parquet")


def test_published_percentages(spark, subs):
    # The published answers
    assert rows(S.customer_count(subs)) == [(1000,)]
    assert rows(S.churn_rate(subs)) == [(307, Decimal("30.7"))]
    assert rows(S.churn_after_trial(subs)) == [(92, 9)]
    assert [r.percentage for r in S.plan_after_trial(subs, plans(spark)).orderBy("plan_id").collect()] == [54, 32, 3, 9]
