import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from calyx.operators import quality as Q
from calyx.operators import sinks as X


def test_readiness_all_any(spark):
    full = spark.range(3)
    empty = spark.range(0)
    r = Q.ready(spark, {"a": full, "b": empty}).first()
    assert (r.ready, r.sources_checked, r.sources_ready) == (False, 2, 1)
    assert Q.ready(spark, {"a": full, "b": empty, "gone": None}, mode="any").first().ready
    assert not Q.ready(spark, {"gone": None}, mode="any").first().ready
    assert not Q.ready(spark, {"a": full}, min_rows=4).first().ready


def test_has_rows_and_min_rows(spark):
    assert Q.has_rows(spark.range(1)) and not Q.has_rows(spark.range(0))
    assert Q.assert_min_rows(spark.range(5), 3) == 5
    with pytest.raises(Q.QualityError):
        Q.assert_min_rows(spark.range(0), 1)
    row = Q.min_rows_check(spark.range(2), 3, "t").first()
    assert (row.row_count, row.passed) == (2, False)


def test_null_pct_one_pass_and_empty(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: (r.null_count, r.null_pct, r.passed)
           for r in Q.null_pct(df, {"a": 40.0, "b": 50.0}).collect()}
    assert got == {"a": (1, decimal.Decimal("33.33"), True),
                   "b": (2, decimal.Decimal("66.67"), False)}
    empty = Q.null_pct(df.limit(0), {"a": 0.0}).first()
    assert empty.null_pct is None and empty.passed


def test_duplicates_and_domain(spark):
    df = spark.createDataFrame([("u", 1, "run"), ("u", 1, "submit"), ("v", 2, "oops"),
                                ("w", 3, None)], "u string, t int, kind string")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["u", "t"]).collect()] == [("u", 1, 2)]
    v = Q.domain_violations(df, {"kind": ["run", "submit"]}).first()
    assert (v.column_name, v.violations) == ("kind", 1)


def test_partition_emptiness(spark):
    data = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 1),)], "ds date")
    periods = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "ds date")
    got = sorted(tuple(r) for r in Q.partition_emptiness(data, periods, "ds").collect())
    assert got == [(dt.date(2024, 1, 1), 2, False), (dt.date(2024, 1, 2), 0, True)]
    assert Q.partition_is_empty(data, {"ds": "2024-01-02"})


def test_observed_write_count(spark, tmp_table):
    df, obs = Q.observed(spark.range(7))
    df.write.parquet(tmp_table())
    assert obs.get["rows"] == 7


def test_tsv_minimal_quoting(spark, tmp_table):
    p = tmp_table("tsv")
    df = spark.createDataFrame([("plain", 'say "hi"', None, ""), ("tab\there", "x", "y", "z")],
                               "a string, b string, c string, d string")
    X.export_delimited(df.coalesce(1), p)
    text = "".join(open(os.path.join(p, f)).read() for f in sorted(os.listdir(p))
                   if f.startswith("part-"))
    lines = sorted(text.splitlines())
    assert lines == ['"tab\there"\tx\ty\tz', 'plain\t"say ""hi"""\t\t']
    back = X.read_delimited(spark, p, df.schema)
    assert sorted(r.b for r in back.collect()) == ['say "hi"', "x"]


def test_on_empty_policies(spark, tmp_table):
    empty = spark.range(0)
    assert not X.export_csv(empty, tmp_table(), on_empty="skip")
    with pytest.raises(X.EmptyExportError):
        X.export_json(empty, tmp_table(), on_empty="fail")
    p = tmp_table()
    assert X.export_csv(empty, p, on_empty="write") and os.path.isdir(p)


def test_export_paths_and_period_rows(spark):
    assert X.export_path("/b", "t", "2024-01-10") == "/b/t/2024-01-10"
    assert X.export_path("/b", "t", "2024-01-10", "exports/table/ds") == "/b/exports/t/ds=2024-01-10"
    with_ld = spark.createDataFrame([(dt.date(2024, 1, 10), 1), (dt.date(2024, 1, 11), 2)],
                                    "load_date date, v int")
    assert [r.v for r in X.period_rows_for_export(with_ld, "2024-01-10").collect()] == [1]
    raw = spark.createDataFrame([("2024-01-10 23:59:59", 1), ("2024-01-11 00:00:00", 2)],
                                "s string, v int").select(
        F.to_timestamp_ntz("s").alias("created_at"), "v")
    assert [r.v for r in X.period_rows_for_export(raw, "2024-01-10").collect()] == [1]


def test_order_by_first_column(spark):
    from calyx.operators.normalize import order_by_first_column
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "k string, v int")
    assert [r.k for r in order_by_first_column(df).collect()] == ["a", "b", "c"]
