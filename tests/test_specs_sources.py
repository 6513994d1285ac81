import json

import pytest
from pyspark.sql import functions as F

from calyx.plans import specs as S
from calyx.sources import records as R
from calyx.sources import tables as T

SF = "/root/testdata/sf0.001"

SPECS = json.dumps([
    {"name": "by_type", "period": "day", "write_mode": "replace_period", "partition_by": ["ds"],
     "export": True, "min_rows": 1,
     "sql": "select attempt_type, count(*) attempts, :ds ds from {attempts} "
            "where created_at >= :period_start and created_at < :period_end group by 1"},
])


def test_load_specs_rejects_unknown_fields():
    with pytest.raises(ValueError):
        S.load_specs('[{"name": "x", "sql": "select 1", "exec": "rm -rf /"}]')


def test_run_and_rerun_empty_period(spark, tmp_table):
    base, exports = tmp_table("cfg"), tmp_table("exp")
    att = T.attempts(spark, SF)
    specs = S.load_specs(SPECS)
    res = S.run_aggregates(spark, specs, "2024-01-10", {"attempts": att}, base, exports,
                           {"attempts": "created_at"})
    n = spark.read.parquet(res[0].path).count()
    assert n == att.filter(F.to_date("created_at") == "2024-01-10").select(
        "attempt_type").distinct().count()
    assert res[0].exported and spark.read.csv(res[0].exported, sep="\t").count() == n
    # the source loses the day: the re-run empties the period (min_rows 0 for this run)
    specs[0].min_rows = 0
    specs[0].export = False
    S.run_aggregates(spark, specs, "2024-01-10",
                     {"attempts": att.filter(F.col("attempt_type") == "none")}, base, None,
                     {"attempts": "created_at"})
    from calyx.operators.writes import read_table
    assert read_table(spark, res[0].path).filter("ds = date'2024-01-10'").count() == 0


def test_generated_series_rule(spark):
    rows = {r.id: (r.category, r.amount) for r in T.generated_series(spark, 50).collect()}
    assert len(rows) == 50
    assert rows[1] == ("Category_1", 11)      # 10.5 rounds half up
    assert rows[5] == ("Category_0", 53)      # 52.5 -> 53
    assert rows[50] == ("Category_0", 525)


def test_synthetic_orders_deterministic(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "report_date string")
    a = sorted(map(tuple, R.synthetic_orders(days).collect()))
    b = sorted(map(tuple, R.synthetic_orders(days).collect()))
    assert a == b and len(a) == 2 * len(R.CAFE_BRANCHES) * len(R.CAFE_MENU)
    assert all(5 <= r[5] <= 40 for r in a)


def test_read_all_strings_and_period(spark, tmp_table):
    p = tmp_table("json")
    spark.createDataFrame([(1, True, 2.5)], "a int, b boolean, c double").write.json(p)
    df = R.read_all_strings(spark, p, "2024-01-08", "2024-01-14")
    assert dict(df.dtypes) == {"a": "string", "b": "string", "c": "string",
                               "_period_start": "date", "_period_end": "date"}
    assert df.first().b == "true"


def test_read_attempts_period(spark, tmp_table):
    p = tmp_table("landing")
    R.api_records(spark, SF).write.json(p)
    got = R.read_attempts(spark, p, "2024-01-08", "2024-01-15")
    ev = T.read_table(spark, SF, "events")
    want = ev.filter("ts >= timestamp_ntz'2024-01-08' and ts < timestamp_ntz'2024-01-15'").count()
    assert got.count() == want


def test_empty_source_gates(spark, tmp_table):
    att = T.attempts(spark, SF)
    spec = S.load_specs(SPECS)[0]
    spec.min_rows, spec.export = 0, False
    spec.on_empty_source = "skip"
    res = S.run_aggregates(spark, [spec], "2031-01-01", {"attempts": att}, tmp_table("g"), None,
                           {"attempts": "created_at"})
    assert res[0].checks == {"skipped": "empty source"}
    spec.on_empty_source = "fail"
    from calyx.operators.quality import QualityError
    with pytest.raises(QualityError):
        S.run_aggregates(spark, [spec], "2031-01-01", {"attempts": att}, tmp_table("g"), None,
                         {"attempts": "created_at"})


def test_null_share_gate(spark, tmp_table):
    att = T.attempts(spark, SF)
    spec = S.load_specs(SPECS)[0]
    spec.min_rows, spec.export = 0, False
    spec.sql = ("select attempt_type, cast(null as string) note, :ds ds from {attempts} "
                "where created_at >= :period_start and created_at < :period_end")
    spec.max_null_pct, spec.critical_columns = 10, ("attempt_type", "note")
    from calyx.operators.quality import QualityError
    with pytest.raises(QualityError, match="note"):
        S.run_aggregates(spark, [spec], "2024-01-10", {"attempts": att}, tmp_table("q"), None,
                         {"attempts": "created_at"})
    spec.critical_columns = ("attempt_type",)
    S.run_aggregates(spark, [spec], "2024-01-10", {"attempts": att}, tmp_table("q"), None,
                     {"attempts": "created_at"})


def test_table_name_parameter_and_load_time(spark, tmp_table):
    from calyx.operators.normalize import stamp_periods
    att = T.attempts(spark, SF)
    spec = S.AggSpec(name="labelled", period="day", write_mode="overwrite",
                     sql="select :table_name tbl, count(*) n from {attempts} "
                         "where created_at >= :period_start and created_at < :period_end")
    res = S.run_aggregates(spark, [spec], "2024-01-10", {"attempts": att}, tmp_table("n"))
    assert S.run_summary(spark, res).first().row_count == 1
    from calyx.operators.writes import read_table
    assert read_table(spark, res[0].path).first().tbl == "labelled"
    stamped = stamp_periods(att.limit(1), ds="2024-01-10", loaded_at=True).first()
    assert stamped.loaded_at is not None and str(stamped.week_start) == "2024-01-08"


def test_min_rows_checks_the_written_period(spark, tmp_table):
    att = T.attempts(spark, SF)
    spec = S.load_specs(SPECS)[0]
    spec.export = False
    base = tmp_table("mr")
    S.run_aggregates(spark, [spec], "2024-01-10", {"attempts": att}, base, None,
                     {"attempts": "created_at"})
    # another day with no rows: the table has rows, the period has none
    from calyx.operators.quality import QualityError
    with pytest.raises(QualityError):
        S.run_aggregates(spark, [spec], "2031-01-01", {"attempts": att}, base, None,
                         {"attempts": "created_at"})


def test_landing_reads_documents_and_rejects_junk(spark, tmp_table):
    p = tmp_table("body")
    body = ('[\n  {"lti_user_id": "a", "created_at": "2024-01-08 10:00:00"},\n'
            '  {"lti_user_id": "b", "created_at": "2024-01-08 10:00:00.250000"}\n]')
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.option("lineSep", "\x01").text(p)
    got = R.read_attempts(spark, p, "2024-01-08", "2024-01-09", multi_line=True)
    assert sorted(r.lti_user_id for r in got.collect()) == ["a", "b"]
    with pytest.raises(Exception, match="no attempt record"):
        R.read_attempts(spark, p, "2024-01-08", "2024-01-09").collect()
    q = tmp_table("lines")
    spark.createDataFrame([('{"lti_user_id": "a", "created_at": "2024-01-08 10:00:00"}',), ("{broken",)],
                          "value string").write.text(q)
    assert R.read_attempts(spark, q, "2024-01-08", "2024-01-09", on_bad="reject").count() == 1
    assert [r._corrupt_record for r in R.rejected_records(spark, q).collect()] == ["{broken"]


def test_lesson_variant_reads_its_own_name(spark):
    from calyx.operators.normalize import normalize_attempts
    recs = spark.createDataFrame(
        [(1, "u", "{'lesson_id': 7, 'lesson_name': 'Algebra', 'score': ''}", 2, "run", "2024-01-08 10:00:00", 5)],
        "event_id long, lti_user_id string, passback_params string, is_correct int, attempt_type string, "
        "created_at string, score int")
    r = normalize_attempts(recs, lesson=True).first()
    assert (r.lesson_id, r.lesson_name, r.score) == ("7", "Algebra", 5) and str(r.created_at) == "2024-01-08 10:00:00"


def test_specs_need_what_they_mean(spark, tmp_table):
    with pytest.raises(ValueError, match="order_by"):
        S.load_specs('[{"name": "x", "sql": "select 1", "write_mode": "insert_ignore", "keys": ["a"]}]')
    with pytest.raises(ValueError, match="either sql or aggregate"):
        S.load_specs('[{"name": "x"}]')
    att = T.attempts(spark, SF)
    spec = S.load_specs([{"name": "odd", "period": "week", "partition_by": ["wk"],
                          "sql": "select count(*) n, :period_start wk from {attempts}"}])
    with pytest.raises(ValueError, match="declare it in"):
        S.run_aggregates(spark, spec, "2024-01-10", {"attempts": att}, tmp_table("odd"), None,
                         {"attempts": "created_at"})


def test_totals_beyond_bigint(spark):
    import decimal
    from calyx.functions.ratios import half_up_avg, half_up_ratio
    from calyx.operators import aggregates as A
    from calyx.plans.sql_functions import register_sql_functions
    big = spark.createDataFrame([(decimal.Decimal("1000000000000000.00"), 3)], "t decimal(38,2), n long")
    assert str(big.select(half_up_avg("t", "n", precision=38).alias("x")).first().x) == "333333333333333.33"
    register_sql_functions(spark)
    assert str(spark.sql("select cast(calyx_avg(1000000000000000.00, 3, 2) as decimal(38,2)) x").first().x) \
        == "333333333333333.33"
    assert spark.sql("select calyx_ratio(1, 0, 2, 100) x").first().x is None
    k = spark.range(1).select(half_up_ratio(F.lit(-1), F.lit(8), scale=2).alias("x")).first().x
    assert str(k) == "-0.13"
    rows = spark.range(4).select(F.lit("c").alias("category"), F.lit(2 ** 62).cast("long").alias("amount"))
    assert int(A.sum_by_category(rows).first().sum_amount) == 2 ** 64
    assert A.integer_average(rows).first().average_amount == 2 ** 62
