import decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calyx.functions import correctness as ok
from calyx.functions.ratios import half_up_avg, half_up_ratio


def py_half_up(k, n, scale, times=1):
    q = decimal.Decimal(k * times) / decimal.Decimal(n)
    return q.quantize(decimal.Decimal(1).scaleb(-scale), rounding=decimal.ROUND_HALF_UP)


def test_half_up_known_cases(spark):
    df = spark.createDataFrame([(1111, 9001), (1, 8), (3, 8), (0, 5), (5, 0), (-1, 8)],
                               "k long, n long")
    got = [r.x for r in df.select(half_up_ratio("k", "n", scale=2).alias("x")).collect()]
    assert [str(x) if x is not None else None for x in got] == \
        ["0.12", "0.13", "0.38", "0.00", None, "-0.13"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 10**9).flatmap(lambda n: st.tuples(st.integers(0, n), st.just(n))),
                min_size=1, max_size=20),
       st.integers(0, 10**12))
def test_half_up_matches_decimal(spark, pairs, big):
    # rates (k <= n) at DECIMAL(10,4); any ratio at a wide precision
    pairs = pairs + [(big, pairs[0][1])]
    df = spark.createDataFrame(pairs, "k long, n long")
    got = df.select(half_up_ratio("k", "n", scale=4, precision=24).alias("x"),
                    half_up_ratio("k", "n", scale=2, times=100, precision=24).alias("p")).collect()
    for (k, n), r in zip(pairs, got):
        assert r.x == py_half_up(k, n, 4)
        assert r.p == py_half_up(k, n, 2, 100)
    rates = spark.createDataFrame(pairs[:-1], "k long, n long").select(
        half_up_ratio("k", "n", scale=4).alias("x")).collect()
    assert [r.x for r in rates] == [py_half_up(k, n, 4) for k, n in pairs[:-1]]


def test_half_up_avg_exact(spark):
    # 1.005 as an average: double rounding gives 1.00 or 1.01 by luck; exact gives 1.01
    df = spark.createDataFrame([(decimal.Decimal("2.01"), 2), (decimal.Decimal("2.00"), 2)],
                               "s decimal(20,2), n long")
    got = [str(r.x) for r in df.select(half_up_avg("s", "n").alias("x")).collect()]
    assert got == ["1.01", "1.00"]


def test_correct_conventions(spark):
    raw = spark.createDataFrame([(1,), (0,), (None,), (2,)], "c int")
    rows = raw.select(ok.correct_null_as_false("c").alias("a"), ok.correct_truthy("c").alias("b"),
                      ok.correct_three_valued("c").alias("t")).collect()
    assert [r.a for r in rows] == [True, False, False, False]
    assert [r.b for r in rows] == [True, False, False, True]
    assert [r.t for r in rows] == [True, False, None, True]


def test_failed_conventions(spark):
    f = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    r = f.agg(ok.failed_null_counts("ok").alias("a"), ok.failed_three_valued("ok").alias("b"),
              ok.failed_sum_zero("ok").alias("c"), F.count("ok").alias("d"),
              F.count(F.lit(1)).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (2, 1, 1, 2, 3)
    # SUM(CASE WHEN ok THEN 0 ELSE 1 END) counts NULL as failed
    assert f.agg(F.sum(F.when(F.col("ok"), 0).otherwise(1))).first()[0] == 2
