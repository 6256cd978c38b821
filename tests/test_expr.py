"""Column helpers against plain-Python models of the PostgreSQL behaviour."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.functions import expr as X

SETTINGS = settings(max_examples=15, deadline=None)


def _pg_round(num: int, den: int, digits: int) -> Decimal:
    with localcontext(prec=60):
        q = Decimal(num) / Decimal(den)
        return q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**12)), min_size=1, max_size=40),
       st.sampled_from([0, 1, 2]))
def test_round_ratio_is_half_away_from_zero(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(X.round_ratio("n", "d", digits)).collect()]
    want = [_pg_round(n, d, digits) for n, d in pairs]
    if digits == 0:
        want = [int(w) for w in want]
    assert got == want


def test_round_ratio_ties_and_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (1005, 1000), (1, 0)], "n long, d long")
    assert [r[0] for r in df.select(X.round_ratio("n", "d", 0)).collect()] == [3, -3, 1, None]
    assert [r[0] for r in df.select(X.round_ratio("n", "d", 2)).collect()][2] == Decimal("1.01")


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**12, 10**12)), min_size=1, max_size=40))
def test_int_div_truncates_toward_zero(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(X.int_div("a", "b")).collect()]
    want = [None if b == 0 else abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1) for a, b in pairs]
    assert got == want


def _pg_strip(v, rules, sentinels=("null", "")):
    # CASE WHEN v IN sentinels THEN NULL WHEN v LIKE ... THEN TRIM(chars FROM v) ... ELSE v END
    if v is None or v in sentinels:
        return None
    for match, pattern, chars in rules:
        if (match == "suffix" and v.endswith(pattern)) or (match == "contains" and pattern in v):
            return v.strip(chars)
    return v


TEXT = st.one_of(
    st.none(),
    st.sampled_from(["null", "", "NaN", "20km", "13.4 km", "25", "32 minutes", "20mins", "25 mins", "15 minute",
                     "km", "mins 5", "minute5"]),
    st.text(alphabet="0123456789. kmintues", max_size=10),
)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_strip_unit_matches_case_like_trim(spark, values):
    from casebook.operators.delivery import DISTANCE_UNITS, DURATION_UNITS

    df = spark.createDataFrame([(v,) for v in values], "v string")
    for rules in (DISTANCE_UNITS, DURATION_UNITS):
        got = [r[0] for r in df.select(X.strip_unit("v", rules)).collect()]
        assert got == [_pg_strip(v, rules) for v in values]


@SETTINGS
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_week_blocks_from_january_first(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(X.week_of_year_blocks("d")).collect()]
    assert got == [(d.timetuple().tm_yday - 1) // 7 + 1 for d in days]


def test_weekday_name_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 10),), (dt.datetime(2021, 1, 6, 0),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(X.weekday_name("t")).collect()] == ["Friday   ", "Wednesday"]


def test_minutes_field_wraps(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 10, 0), dt.datetime(2021, 1, 2, 11, 35))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.minutes_between("a", "b", "field"), X.minutes_between("a", "b", "total")).first()
    assert tuple(r) == (35, 25 * 60 + 35)


def test_year_range_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2020, 5, 1),), (dt.date(2021, 1, 1),)], "d date").write.parquet(path)
    df = spark.read.parquet(path).where(X.year_range("d", 2020))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2020-01-01)" in plan and "LessThan(d,2021-01-01)" in plan
    assert df.count() == 1


def test_null_if(spark):
    df = spark.createDataFrame([("null",), ("",), (None,), ("4",)], "v string")
    assert [r[0] for r in df.select(X.null_if("v", "null", "")).collect()] == [None, None, None, "4"]
    assert df.select(F.count(X.null_if("v", "null"))).first()[0] == 2


def test_time_helpers_ignore_the_session_zone(spark):
    """Wall-clock times inside a daylight-saving gap stay as written."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2021, 3, 14, 1, 50), dt.datetime(2021, 3, 14, 2, 35, 30))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(X.minutes_between("a", "b", "total"), X.minutes_between("a", "b", "field"),
                      X.weekday_name("b", pad=False), F.col("b").cast("string")).first()
        assert tuple(r) == (45, 45, "Sunday", "2021-03-14 02:35:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_division_is_exact_next_to_the_border(spark):
    df = spark.createDataFrame([(9999999, 10**7), (999999999900, 10**10), (2000000, 2000001)], "a long, b long")
    assert [r[0] for r in df.select(X.int_div("a", "b")).collect()] == [0, 99, 0]
    df = spark.createDataFrame([(49999999, 10**8), (54 * 10**9 - 1, 10**9 * 100)], "a long, b long")
    assert [r[0] for r in df.select(X.round_ratio("a", "b", 0)).collect()] == [0, 1]


def test_round_ratio_with_a_negative_denominator(spark):
    df = spark.createDataFrame([(5, -2), (-5, -2), (1, -3)], "n long, d long")
    assert [r[0] for r in df.select(X.round_ratio("n", "d", 0)).collect()] == [-3, 3, 0]


def test_strict_cast_raises_and_lenient_does_not(spark):
    import pytest
    from pyspark.sql.types import DecimalType

    df = spark.createDataFrame([("10.125",), (" 3 ",), (None,)], "t string")
    assert [r[0] for r in df.select(X.strict_cast("t", DecimalType(38, 10))).collect()] == [
        Decimal("10.125"), Decimal(3), None]
    bad = spark.createDataFrame([("fast",)], "t string")
    assert bad.select(X.strict_cast("t", DecimalType(38, 10), lenient=True)).first()[0] is None
    with pytest.raises(Exception, match="not a decimal"):
        bad.select(X.strict_cast("t", DecimalType(38, 10))).collect()
