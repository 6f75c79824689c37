"""Scalar expressions on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, pvalues, segments


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "later, earlier, days",
    [
        ("2018-01-01 05:00:00", "2018-01-01 10:00:00", -1),  # five hours before
        ("2018-01-02 01:00:00", "2018-01-01 23:00:00", 0),  # two hours across midnight
        ("2018-01-03 23:00:00", "2018-01-01 23:00:00", 2),  # exactly two days
        ("2018-01-03 22:59:59", "2018-01-01 23:00:00", 1),
        ("2018-03-01 00:00:00", "2018-02-27 12:00:00", 1),
        ("2017-12-30 00:00:00", "2018-01-01 00:00:00", -2),
    ],
)
def test_whole_days_is_a_floor(spark, later, earlier, days):
    assert one(spark, dates.whole_days(ts(later), ts(earlier))) == days


def test_whole_days_ignores_the_session_zone(spark):
    # 2018-11-04 00:00 does not exist in this zone; a zoned difference would be an hour off.
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = one(spark, dates.whole_days(ts("2018-11-04 12:00:00"), ts("2018-11-03 12:00:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 1


def test_null_dates(spark):
    null = F.lit(None).cast("timestamp_ntz")
    assert one(spark, dates.whole_days(null, ts("2018-01-01"))) is None
    assert one(spark, dates.flag(null > ts("2018-01-01"))) == 0


def test_lenient_timestamps(spark):
    df = spark.createDataFrame([("2018-01-05 10:11:12",), ("nonsense",), (None,)], "t string")
    got = [r["t"] for r in dates.parse_timestamps(df, ["t"]).collect()]
    assert got == [dt.datetime(2018, 1, 5, 10, 11, 12), None, None]


def test_weekdays(spark):
    days = [f"2024-01-0{i}" for i in range(1, 8)]  # 1 January 2024 was a Monday
    assert tuple(one(spark, dates.weekday_name(ts(d))) for d in days) == dates.WEEKDAYS_FROM_MONDAY


def test_month_ahead_carries_the_year(spark):
    assert one(spark, dates.month_ahead(F.lit(2017), F.lit(11), F.lit(3))) == dt.date(2018, 2, 1)
    assert one(spark, dates.month_ahead(F.lit(2017), F.lit(9), F.lit(3))) == dt.date(2017, 12, 1)


def test_season(spark):
    season = dates.season_columns(F.lit(12))
    assert one(spark, season["quarter"]) == 4 and one(spark, season["is_q4"]) == 1
    assert one(spark, season["month_cos"]) == pytest.approx(1.0)
    assert [one(spark, dates.quarter_of(F.lit(m))) for m in (1, 3, 4, 9, 10)] == [1, 1, 2, 3, 4]


def test_rounding_rules(spark):
    assert one(spark, numbers.sql_round(F.lit(2.5), 0)) == 3
    assert one(spark, numbers.even_round(F.lit(2.5), 0)) == 2


def test_ratios(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.percent(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, numbers.clip_above(F.lit(7), 5)) == 5
    assert one(spark, numbers.clip_above(F.lit(None).cast("int"), 5)) is None
    assert one(spark, numbers.at_least_zero(F.lit(-3.0))) == 0


def test_segments(spark):
    scores = range(2, 13)
    rules = [one(spark, segments.segment_by_rules(F.lit(s))) for s in scores]
    assert rules == ["Lost"] * 3 + ["At-Risk"] * 2 + ["Loyal Customers"] * 3 + ["Champions"] * 3
    cuts = [one(spark, segments.segment_by_interval(F.lit(s))) for s in scores]
    assert cuts == [None] + ["At-Risk"] * 3 + ["Potential"] * 3 + ["Champions"] * 4


def test_lookup(spark):
    table = segments.SEGMENT_ADVICE
    assert one(spark, segments.lookup(F.lit("Lost"), table)) == table["Lost"]
    assert one(spark, segments.lookup(F.lit("no such"), table)) is None
    assert one(spark, segments.lookup(F.lit("no such"), table, "else")) == "else"


def test_normal_tail_keeps_far_digits(spark):
    assert one(spark, pvalues.normal_two_sided(F.lit(9.0))) == pytest.approx(2.257e-19, rel=1e-3)
    assert one(spark, pvalues.normal_two_sided(F.lit(-1.959963984540054))) == pytest.approx(0.05)


@pytest.mark.parametrize(
    "t, df, p",
    [
        (1.0, 1.0, 0.5),  # Cauchy
        (2.0, 2.0, 1 - 2 / 6**0.5),  # closed form for two degrees of freedom
        (2.228138852, 10.0, 0.05),  # printed tables
        (2.0, 10.0, 0.0733880348),
        (0.0, 7.0, 1.0),
        (1.959963984540054, 1e10, 0.05),
    ],
)
def test_student_tail(spark, t, df, p):
    assert one(spark, pvalues.student_two_sided(F.lit(t), F.lit(df))) == pytest.approx(p, abs=2e-9)
