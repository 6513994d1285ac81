"""FIXTURES §3 edge frames: score, half, single, empty."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from calyx.functions.params import with_parsed_params
from calyx.operators import aggregates as A
from calyx.operators import normalize as N

DEC = decimal.Decimal
TS = dt.datetime


def test_score_conventions(spark):
    # inner 0 / NULL / 7 / key absent, outer 5 / NULL / 0
    rows = [(1, "{'score': 0}", 5), (2, "{'score': None}", 5), (3, "{'score': 7}", 5),
            (4, "{'x': 1}", 5), (5, "{'score': 0}", None), (6, "{'x': 1}", 0),
            (7, "{'score': None}", None), (8, "{'x': 1}", None)]
    df = spark.createDataFrame(rows, "i int, passback_params string, outer int")
    p = with_parsed_params(df)
    got = {r.i: (r.a, r.b) for r in p.select(
        "i",
        N.score_falsy_fallback(F.col("_params.score"), F.col("outer")).alias("a"),
        N.score_key_presence(F.col("_params_json"), F.col("_params.score"), F.col("outer"))
        .alias("b")).collect()}
    d = lambda x: None if x is None else DEC(x).quantize(DEC("0.01"))
    # Inner unless falsy (0 / NULL), else outer
    # Inner if the key exists (even None or 0), else outer if truthy
    assert got == {1: (d(5), d(0)), 2: (d(5), None), 3: (d(7), d(7)), 4: (d(5), d(5)),
                   5: (None, d(0)), 6: (d(0), None), 7: (None, None), 8: (None, None)}


def _attempts(spark, rows):
    return spark.createDataFrame(rows, "lti_user_id string, attempt_type string, "
                                       "created_at timestamp_ntz, is_correct boolean, "
                                       "score decimal(10,2), lesson_id string, "
                                       "lesson_name string")


def test_half_up_rate_ties(spark):
    # 1 correct of 8 = 0.125 -> 0.1250 at 4 digits; 1 of 16 = 0.0625;
    # 1 of 32 = 0.03125 -> 0.0313 (half up, not half even 0.0312)
    base = TS(2024, 1, 8, 10)
    rows = []
    for user, n in (("a", 8), ("b", 16), ("c", 32)):
        rows += [(user, "run", base + dt.timedelta(minutes=i), i == 0, DEC("1.00"), "1", "l")
                 for i in range(n)]
    got = {r.lti_user_id: r.avg_correct_rate
           for r in A.prev_week_by_user(_attempts(spark, rows), "2024-01-17").collect()}
    assert got == {"a": DEC("0.1250"), "b": DEC("0.0625"), "c": DEC("0.0313")}


def test_single_row_stddev_is_null(spark):
    rows = [("u", "run", TS(2024, 1, 9), True, DEC("4.50"), "7", "lesson 7")]
    r = A.weekly_lesson_stddev(_attempts(spark, rows), "2024-01-10").first()
    assert r.stddev_score is None and r.avg_score == DEC("4.50")


def test_empty_period_global_vs_grouped(spark):
    rows = [("u", "run", TS(2024, 1, 9), True, DEC("4.50"), "7", "lesson 7")]
    att = _attempts(spark, rows)
    empty_day = "2024-02-01"
    # global aggregates: one row; sums NULL, counts 0
    s = A.daily_summary(att, empty_day).collect()
    assert len(s) == 1 and s[0].total_attempts == 0 and s[0].correct_attempts is None \
        and s[0].incorrect_attempts is None and s[0].correct_rate is None
    g = A.weekly_global(att, empty_day).collect()
    assert len(g) == 1 and g[0].success_rate is None and g[0].attempts_per_user_avg is None
    assert A.alltime_totals(att.limit(0)).first().total_rows == 0
    # grouped aggregates: no rows
    assert A.daily_by_type(att, empty_day).count() == 0
    assert A.monthly_summary(att, empty_day).count() == 0
    assert A.new_users(att, "2024-02-05", "2024-02-12").count() == 0


def test_new_users_dimension_form_matches(spark):
    from calyx.sources.tables import attempts
    att = attempts(spark, "/root/testdata/sf0.001")
    users = att.groupBy("lti_user_id").agg(F.min("created_at").alias("first_activity"))
    for s, e in (("2024-01-08", "2024-01-15"), ("2024-01-01", "2024-01-08"),
                 ("2024-01-29", "2024-02-05")):
        a = sorted(map(tuple, A.new_users(att, s, e).collect()))
        b = sorted(map(tuple, A.new_users_from_dim(att, users, s, e).collect()))
        assert a == b and a
