"""Spec runs that are all or nothing, fused groupings, own tables, probes, bucketed joins, streams with state."""

import json

import pytest
from pyspark.sql import functions as F

from calyx.operators import aggregates as A
from calyx.operators import joins as J
from calyx.operators import quality as Q
from calyx.operators import sinks as X
from calyx.operators import writes as W
from calyx.plans import specs as S
from calyx.sources import records as R
from calyx.sources import tables as T
from calyx.streaming import jobs as ST

SF = "/root/testdata/sf0.001"
BY_TYPE = {"name": "by_type", "period": "day", "partition_by": ["ds"], "export": True,
           "sql": "select attempt_type, count(*) n, :ds ds from {attempts} "
                  "where created_at >= :period_start and created_at < :period_end group by 1"}


def run(spark, specs, ds, base, exports=None, att=None):
    return S.run_aggregates(spark, S.load_specs(specs), ds, {"attempts": att or T.attempts(spark, SF)}, base, exports,
                            {"attempts": "created_at"})


def jobs(spark, action):
    """Spark jobs that an action starts."""
    group = f"g{id(action)}"
    spark.sparkContext.setJobGroup(group, "test")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_failing_step_leaves_all_as_it_was(spark, tmp_table):
    base, exports = tmp_table("base"), tmp_table("exports")
    run(spark, [BY_TYPE], "2024-01-10", base)
    before = sorted(map(tuple, W.read_table(spark, base + "/by_type").collect()))
    boom = {"name": "boom", "period": "day", "partition_by": ["ds"], "schema": "n long, ds date",
            "sql": "select cast(raise_error('boom') as bigint) n, :ds ds from {attempts}"}
    empty = {**BY_TYPE, "name": "empty", "on_empty_export": "fail", "sql": BY_TYPE["sql"].replace("where", "where false and")}
    for bad, message in ((boom, "boom"), ({**BY_TYPE, "name": "few", "min_rows": 10 ** 6}, "required"), (empty, "nothing")):
        changed = {**BY_TYPE, "sql": BY_TYPE["sql"].replace("count(*)", "-count(*)")}
        with pytest.raises(Exception, match=message):
            run(spark, [changed, bad], "2024-01-10", base, exports)
        assert sorted(map(tuple, W.read_table(spark, base + "/by_type").collect())) == before
        assert not W.table_exists(spark, f"{base}/{bad['name']}")
        fs, folder = W._fs(spark, exports)
        assert not fs.exists(folder)


@pytest.mark.parametrize("mode", ["append", "upsert", "insert_ignore", "replace_ignore"])
def test_checks_see_what_the_write_will_leave(spark, tmp_table, mode):
    base = tmp_table("base")
    spec = {**BY_TYPE, "export": False, "write_mode": mode, "keys": ["attempt_type", "ds"], "order_by": ["n"]}
    n = W.read_table(spark, run(spark, [spec], "2024-01-10", base)[0].path).count()
    want = 2 * n if mode == "append" else n
    with pytest.raises(Q.QualityError, match=f"{want} rows < required {want + 1}"):
        run(spark, [{**spec, "min_rows": want + 1}], "2024-01-10", base)
    assert run(spark, [{**spec, "min_rows": want}], "2024-01-10", base)[0].checks == {"min_rows": True}
    assert W.read_table(spark, base + "/by_type").count() == want


def test_groupings_share_one_pass(spark, tmp_table):
    names = [f"attempt_type, {i}" for i in range(4)]
    specs = [{"name": f"s{i}", "period": "day", "partition_by": ["ds"], "group_by": ["attempt_type"] if i % 2 else [],
              "measures": {"n": "count(*)", "x": f"sum({i})"}, "columns": ["attempt_type", "created_at"]}
             for i in range(len(names))]
    att = T.attempts(spark, SF)
    seen = []
    real = W.Staged.__enter__
    W.Staged.__enter__ = lambda self: (seen.append(self.path), real(self))[1]
    try:
        res = run(spark, specs, "2024-01-10", tmp_table("fused"))
    finally:
        W.Staged.__enter__ = real
    assert len(seen) == 1                                                    # one staged pass for four specs
    day = att.filter(F.to_date("created_at") == "2024-01-10")
    total = day.count()
    for i, r in enumerate(res):
        rows = W.read_table(spark, r.path).collect()
        assert sum(x.n for x in rows) == total and sum(x.x for x in rows) == i * total
        assert len(rows) == (day.select("attempt_type").distinct().count() if i % 2 else 1)
    plan = att.groupingSets([[F.col("attempt_type")], []], "attempt_type").agg(F.count("*")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="sql or aggregate or measures"):
        S.load_specs([{"name": "x", "sql": "select 1", "measures": {"n": "count(*)"}}])


def test_specs_from_any_storage(spark, tmp_table):
    path = tmp_table("specs") + "/specs.json"
    text = json.dumps([BY_TYPE], indent=1)
    fs, folder = W._fs(spark, path)
    out = fs.create(folder, True)
    out.write(bytearray(text.encode()))
    out.close()
    assert S.read_specs(spark, path) == S.load_specs(text)
    assert S.read_specs(spark, "daily") == S.example_specs("daily")


def test_probes_stop_early(spark):
    ev = T.read_table(spark, SF, "events")
    none = ev.filter("event_id < -1")

    def never():
        raise AssertionError("probed")

    got = Q.ready_in_order(spark, {"a": ev, "b": none, "c": never}).first()
    assert tuple(got) == (False, 2, "b")
    got = Q.ready_in_order(spark, {"a": None, "b": ev, "c": never}, mode="any").first()
    assert tuple(got) == (True, 2, "b")
    assert tuple(Q.ready_in_order(spark, {"a": ev, "b": ev}, 5).first()) == (True, 2, "b")
    assert tuple(Q.ready_in_order(spark, {"a": ev.limit(3)}, 5).first()) == (False, 1, "a")
    assert tuple(Q.ready_in_order(spark, {}, 5).first()) == (True, 0, None)
    slow = {"a": none, **{f"x{i}": ev.filter(f"event_id > {i}") for i in range(20)}}
    assert jobs(spark, lambda: Q.ready_in_order(spark, slow)) <= 3


def test_bucketed_target_is_not_shuffled(spark, tmp_table):
    a = T.attempts(spark, SF).select("event_id", "lti_user_id", "created_at")
    p = tmp_table("bucketed")
    keys = ["lti_user_id", "created_at"]
    W.write_append(a.filter("event_id % 2 = 0"), p, bucket_by=(8, keys))
    W.write_append(a.filter("event_id % 4 = 1"), p)                      # later batches are bucketed too
    assert len(W.read_table(spark, p).inputFiles()) == 16
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = J.anti_new_rows(a, W.read_table(spark, p), keys, ["event_id"])
        plan = new._jdf.queryExecution().executedPlan().toString()
        merged = J.upsert_frames(W.read_table(spark, p), a, keys)
        other = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert other.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in other
    assert new.count() == a.filter("event_id % 4 = 3").count() and merged.count() == a.count()


def test_new_users_without_ids(spark):
    rows = [("u1", "2023-12-30"), ("u1", "2024-01-09"), (None, "2024-01-09"), ("u2", "2024-01-10"), (None, "2023-12-31")]
    att = spark.createDataFrame([(u, 1, t) for u, t in rows], "lti_user_id string, is_correct int, t string") \
        .select("lti_user_id", F.col("is_correct").cast("boolean").alias("is_correct"),
                F.col("t").cast("timestamp_ntz").alias("created_at"))
    one = A.new_users(att, "2024-01-08", "2024-01-15").first()
    users = A.first_activity(att, "1970-01-01", "2024-01-15")
    two = A.new_users_from_dim(att, users, "2024-01-08", "2024-01-15").first()
    for got in (one, two):
        assert (got.attempts_total, got.unique_users, got.new_users) == (3, 2, 1)


def test_keys_of_json_records(spark, tmp_table):
    p = tmp_table("json")
    spark.createDataFrame([('{"b": 1.50, "a b": {"x": [1, 2]}}',), ('{"c`d": null, "b": "t"}',), ("  ",)], "value string") \
        .write.text(p)
    df = R.read_all_strings(spark, p, "2024-01-08", "2024-01-14")
    assert df.columns == ["a b", "b", "c`d", "_period_start", "_period_end"]
    got = {(x and x.replace(" ", ""), y) for x, y in df.select("a b", "b").collect()}
    assert got == {(None, "t"), ('{"x":[1,2]}', "1.50")}
    bad = tmp_table("bad")
    spark.createDataFrame([("{broken",)], "value string").write.text(bad)
    with pytest.raises(Exception):
        R.read_all_strings(spark, bad, "2024-01-08", "2024-01-14").collect()


def test_state_and_late_rows(spark, tmp_table):
    landing, out, ck = tmp_table("landing"), tmp_table("out"), tmp_table("ck")
    schema = "id long, user string, created_at timestamp_ntz"

    def arrive(*rows):
        spark.createDataFrame([(i, u, t) for i, u, t in rows], "id long, user string, t string") \
            .select("id", "user", F.col("t").cast("timestamp_ntz").alias("created_at")).write.mode("append").parquet(landing)
        ST.run_deduplicated(spark, ST.file_stream(spark, landing, schema), out, ck, ["user", "created_at"], ["id"], "1 day")
        return sorted(r.id for r in ST.deduplicated(spark, out).collect())

    assert arrive((1, "a", "2024-01-10 12:00:00"), (2, "b", "2024-01-12 12:00:00")) == [1, 2]
    # a copy inside the delay, a copy beyond it, a new key beyond it, once more in the same batch
    assert arrive((3, "b", "2024-01-12 12:00:00"), (4, "a", "2024-01-10 12:00:00"), (5, "c", "2024-01-09 00:00:00"),
                  (6, "c", "2024-01-09 00:00:00"), (7, "b", "2024-01-12 13:00:00")) == [1, 2, 5, 7]
    assert arrive((8, "c", "2024-01-09 00:00:00"), (9, "d", "2024-01-20 00:00:00")) == [1, 2, 5, 7, 9]
    assert arrive((10, "d", "2024-01-20 00:00:00"), (11, "e", "2024-01-01 00:00:00")) == [1, 2, 5, 7, 9, 11]
    with pytest.raises(ValueError, match="must be a key"):
        ST.run_deduplicated(spark, ST.file_stream(spark, landing, schema), out, ck, ["user"], ["id"], "1 day")


def test_export_of_a_replaced_period(spark, tmp_table):
    base, exports = tmp_table("base"), tmp_table("exports")
    run(spark, [BY_TYPE], "2024-01-09", base)
    res = run(spark, [BY_TYPE], "2024-01-10", base, exports)[0]
    rows = W.read_table(spark, res.path).filter("ds = date'2024-01-10'")
    got = X.read_delimited(spark, res.exported, rows.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
