import datetime as dt

import pytest
from pyspark.sql import functions as F

from calyx.functions import calendar as cal
from calyx.operators import filters as flt

D = dt.date


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("d, ws, we", [
    ("2024-01-08", D(2024, 1, 8), D(2024, 1, 14)),   # Monday
    ("2024-01-14", D(2024, 1, 8), D(2024, 1, 14)),   # Sunday
    ("2024-02-29", D(2024, 2, 26), D(2024, 3, 3)),   # leap day
    ("2024-12-31", D(2024, 12, 30), D(2025, 1, 5)),  # week across the year end
    ("2025-01-01", D(2024, 12, 30), D(2025, 1, 5)),
])
def test_week_bounds(spark, d, ws, we):
    assert one(spark, cal.week_start(d)) == ws
    assert one(spark, cal.week_end(d)) == we
    assert one(spark, cal.prev_week_start(d)) == ws - dt.timedelta(days=7)
    assert one(spark, cal.prev_week_end(d)) == ws - dt.timedelta(days=1)


@pytest.mark.parametrize("d, ms, me, mx", [
    ("2024-02-10", D(2024, 2, 1), D(2024, 2, 29), D(2024, 3, 1)),
    ("2023-02-28", D(2023, 2, 1), D(2023, 2, 28), D(2023, 3, 1)),
    ("2024-12-31", D(2024, 12, 1), D(2024, 12, 31), D(2025, 1, 1)),
])
def test_month_bounds(spark, d, ms, me, mx):
    assert one(spark, cal.month_start(d)) == ms
    assert one(spark, cal.month_end(d)) == me
    assert one(spark, cal.month_end_exclusive(d)) == mx


def test_labels(spark):
    assert one(spark, cal.month_name("2024-11-05")) == "november"
    assert one(spark, cal.year_month("2024-11-05")) == "2024-11"
    assert one(spark, cal.month_tag("2024-11-05")) == "NOV2024"
    assert one(spark, cal.range_label("2024-01-08", "2024-01-14")) == "2024-01-08-2024-01-14"
    assert one(spark, cal.shift_days("2024-02-28", 2)) == D(2024, 3, 1)


def test_run_days(spark):
    b = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 14))], "start date, `end` date")
    spine = cal.date_spine(b, out_col="d")
    got = sorted(r.d.day for r in spine.filter(
        cal.is_run_day(F.col("d"), days_of_month=(1, 2, 5), weekdays=(0, 4, 6))).collect())
    # 1,2,5 by day of month; Mondays 1, 8; Fridays 5, 12; Sundays 7, 14
    assert got == [1, 2, 5, 7, 8, 12, 14]


BOUNDS = [
    (1, "2024-01-08 00:00:00"),          # Monday 00:00
    (2, "2024-01-14 23:59:59.999999"),   # Sunday last microsecond
    (3, "2024-01-15 00:00:00"),          # next Monday
    (4, "2024-01-14 23:59:59.500000"),   # inside the last second
    (5, "2024-01-31 00:00:00"),          # month last day 00:00
    (6, "2024-01-31 12:00:00"),          # month last day 12:00
]


@pytest.fixture()
def bounds(spark):
    df = spark.createDataFrame(BOUNDS, "id int, s string")
    return df.select("id", F.to_timestamp_ntz("s").alias("created_at"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_calendar_week_half_open(bounds):
    assert ids(flt.filter_calendar_week(bounds, "2024-01-10")) == [1, 2, 4]


def test_week_closed_second_drops_last_fraction(bounds):
    # F12 keeps <= 23:59:59 exactly, so the last partial second is lost
    assert ids(flt.filter_week_closed_second(bounds, "2024-01-10")) == [1]


def test_month_half_open_vs_midnight(bounds):
    assert ids(flt.filter_calendar_month(bounds, "2024-01-20")) == [1, 2, 3, 4, 5, 6]
    # F13 stops at the last day 00:00 and drops the rest of that day
    assert ids(flt.filter_month_closed_midnight(bounds, "2024-01-20")) == [1, 2, 3, 4, 5]


def test_day_filter_pushes_down(spark):
    from calyx.sources.tables import attempts
    plan = flt.filter_day(attempts(spark, "/root/testdata/sf0.001"), "2024-01-10") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan
