"""Opt-in ordered output with PostgreSQL's NULL order."""

from casebook.operators.ranking import ordered


def test_nulls_sort_as_in_postgresql(spark):
    df = spark.createDataFrame([(2, "a"), (None, "b"), (1, None), (1, "c")], "n int, t string")
    assert [tuple(r) for r in ordered(df, "n", "-t").collect()] == [(1, None), (1, "c"), (2, "a"), (None, "b")]
    assert [r.n for r in ordered(df, "-n", "t").collect()] == [None, 2, 1, 1]
