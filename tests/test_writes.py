import datetime as dt

import pytest
from pyspark.sql import functions as F

from calyx.operators import joins as J
from calyx.operators import writes as W

SCHEMA = "ds date, k string, v long"


def rows(spark, path, cols=("ds", "k", "v")):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


D1, D2, D3 = dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 10)


def test_append_twice_duplicates(spark, tmp_table):
    p = tmp_table()
    for _ in range(2):
        W.write_append(df(spark, [(D1, "a", 1)]), p)
    assert rows(spark, p) == [(D1, "a", 1)] * 2


def test_full_refresh(spark, tmp_table):
    p = tmp_table()
    W.write_full_refresh(df(spark, [(D1, "a", 1)]), p, ["ds"])
    W.write_full_refresh(df(spark, [(D2, "b", 2)]), p, ["ds"])
    assert rows(spark, p) == [(D2, "b", 2)]


def test_period_replace_is_idempotent_and_drops_empty(spark, tmp_table):
    p = tmp_table()
    data = df(spark, [(D1, "a", 1), (D2, "b", 2), (D3, "c", 3)])
    periods = [{"ds": str(d)} for d in (D1, D2, D3)]
    W.replace_periods(spark, data, p, ["ds"], periods)
    W.replace_periods(spark, data, p, ["ds"], periods)  # re-run: same table
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 2), (D3, "c", 3)]
    # re-run D2 with new rows, D3 with no rows at all
    W.replace_periods(spark, df(spark, [(D2, "b", 20)]), p, ["ds"],
                      [{"ds": str(D2)}, {"ds": str(D3)}])
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 20)]


def test_period_replace_reading_target(spark, tmp_table):
    p = tmp_table()
    W.replace_periods(spark, df(spark, [(D1, "a", 1)]), p, ["ds"])
    bumped = spark.read.parquet(p).withColumn("v", F.col("v") + 1)
    W.replace_periods(spark, bumped, p, ["ds"], source_reads_target=True)
    assert rows(spark, p) == [(D1, "a", 2)]


def test_upsert(spark, tmp_table):
    p = tmp_table()
    W.upsert(spark, df(spark, [(D1, "a", 1), (D1, "b", 1), (D2, "c", 1)]), p, ["ds", "k"], ["ds"])
    W.upsert(spark, df(spark, [(D1, "a", 9), (D1, "z", 9)]), p, ["ds", "k"], ["ds"])
    assert rows(spark, p) == [(D1, "a", 9), (D1, "b", 1), (D1, "z", 9), (D2, "c", 1)]


def test_upsert_unpartitioned(spark, tmp_table):
    p = tmp_table()
    W.upsert(spark, df(spark, [(D1, "a", 1)]), p, ["k"])
    W.upsert(spark, df(spark, [(D2, "a", 2), (D2, "b", 2)]), p, ["k"])
    assert rows(spark, p) == [(D2, "a", 2), (D2, "b", 2)]


def test_dedup_first_wins_and_null_keys(spark):
    # FIXTURES `dups`: same key twice in a batch, a NULL key twice
    b = spark.createDataFrame([(1, "u", 10, "first"), (2, "u", 10, "second"),
                               (3, None, 10, "n1"), (4, None, 10, "n2"), (5, "w", 11, "only")],
                              "arrival int, user string, ts int, payload string")
    got = sorted(tuple(r) for r in J.dedup_first_wins(b, ["user", "ts"], ["arrival"]).collect())
    assert got == [(1, "u", 10, "first"), (3, None, 10, "n1"), (4, None, 10, "n2"),
                   (5, "w", 11, "only")]


def test_insert_ignore_keeps_existing(spark, tmp_table):
    p = tmp_table()
    W.write_append(df(spark, [(D1, "a", 1)]), p)
    batch = df(spark, [(D1, "a", 2), (D2, "b", 3), (D2, "b", 4)])
    W.insert_ignore(spark, batch, p, ["k"], ["v"])
    W.insert_ignore(spark, batch, p, ["k"], ["v"])  # re-run adds nothing
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 3)]


def test_insert_if_period_absent(spark, tmp_table):
    p = tmp_table()
    assert W.insert_if_period_absent(spark, df(spark, [(D1, "a", 1)]), p, "ds", str(D1))
    assert not W.insert_if_period_absent(spark, df(spark, [(D1, "x", 9)]), p, "ds", str(D1))
    assert rows(spark, p) == [(D1, "a", 1)]


def test_load_if_partition_empty(spark, tmp_table):
    p = tmp_table()
    assert W.load_if_partition_empty(spark, df(spark, [(D1, "a", 1)]), p, ["ds"])
    assert not W.load_if_partition_empty(spark, df(spark, [(D1, "b", 2)]), p, ["ds"])
    assert W.load_if_partition_empty(spark, df(spark, [(D2, "b", 2)]), p, ["ds"])
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 2)]


def test_create_and_drop(spark, tmp_table):
    from pyspark.sql.types import StructType
    p = tmp_table()
    schema = StructType.fromDDL(SCHEMA)
    assert W.create_if_missing(spark, p, schema)
    assert not W.create_if_missing(spark, p, schema)
    assert W.table_exists(spark, p) and W.read_table(spark, p).count() == 0
    assert W.drop_table(spark, p) and not W.table_exists(spark, p)
    assert not W.drop_table(spark, p)


def boom(spark):
    """Rows whose second half fails while it is written."""
    return spark.range(100).select(
        F.lit(D1).alias("ds"), F.col("id").cast("string").alias("k"),
        F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("boom")).cast("long")).alias("v"))


def test_failed_writes_leave_the_table(spark, tmp_table):
    p = tmp_table()
    W.write_full_refresh(df(spark, [(D1, "a", 1), (D2, "b", 2)]), p, ["ds"])
    for write in (lambda: W.write_full_refresh(boom(spark), p, ["ds"]),
                  lambda: W.replace_periods(spark, boom(spark), p, ["ds"], [{"ds": D2}]),
                  lambda: W.upsert(spark, boom(spark), p, ["ds", "k"], ["ds"]),
                  lambda: W.upsert(spark, boom(spark), p, ["k"], ["ds"]),
                  lambda: W.insert_ignore(spark, boom(spark), p, ["k"], ["v"], ["ds"])):
        with pytest.raises(Exception, match="boom"):
            write()
        got = sorted(tuple(r) for r in W.read_table(spark, p).select("ds", "k", "v").collect())
        assert got == [(D1, "a", 1), (D2, "b", 2)]
    q = tmp_table()
    W.write_append(df(spark, [(D1, "a", 1)]), q)                        # no partitions
    for write in (lambda: W.write_full_refresh(boom(spark), q), lambda: W.upsert(spark, boom(spark), q, ["k"]),
                  lambda: W.write_range_replace(spark, boom(spark), q, "ds", D1, D3),
                  lambda: W.write_range_replace(spark, boom(spark), p, "ds", D1, D3)):
        with pytest.raises(Exception, match="boom"):
            write()
        assert rows(spark, q) == [(D1, "a", 1)] and W.read_table(spark, p).count() == 2
    new = tmp_table()
    with pytest.raises(Exception, match="boom"):
        W.write_append(boom(spark), new)
    assert not W.table_exists(spark, new)


def test_append_is_aligned_with_the_table(spark, tmp_table):
    p = tmp_table()
    W.write_append(df(spark, [(D1, "a", 1)]), p)
    W.write_append(df(spark, [(D2, "b", 2)]).select("v", "ds", "k"), p)
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 2)]
    for other in (df(spark, [(D2, "b", 2)]).drop("v"), df(spark, [(D2, "b", 2)]).withColumn("x", F.lit(1)),
                  df(spark, [(D2, "b", 2)]).withColumn("v", F.col("v").cast("int"))):
        with pytest.raises(ValueError, match="columns differ"):
            W.write_append(other, p)
    assert W.read_table(spark, p).columns == ["ds", "k", "v"] and W.read_table(spark, p).count() == 2


def test_upsert_checks_keys(spark, tmp_table):
    p = tmp_table()
    with pytest.raises(ValueError, match="two source rows"):
        W.upsert(spark, df(spark, [(D1, "a", 1), (D2, "a", 2)]), p, ["k"])
    W.upsert(spark, df(spark, [(D1, "a", 1), (D1, "b", 1)]), p, ["k"], ["ds"])
    W.upsert(spark, df(spark, [(D2, "a", 2)]), p, ["k"], ["ds"])          # the key moves to another partition
    assert rows(spark, p) == [(D1, "b", 1), (D2, "a", 2)]
    W.upsert(spark, df(spark, [(D2, None, 3), (D2, None, 4)]), p, ["k"], ["ds"])
    assert sorted(r.v for r in W.read_table(spark, p).filter("k is null").collect()) == [3, 4]


def test_period_replace_on_timestamp_stamps(spark, tmp_table):
    p = tmp_table()
    data = spark.createDataFrame([("2024-01-08", 1), ("2024-01-15", 2)], "t string, v int").select(
        F.to_timestamp_ntz("t", F.lit("yyyy-MM-dd")).alias("date"), "v")
    W.replace_periods(spark, data, p, ["date"])
    none = data.filter("v > 9")
    W.replace_periods(spark, none, p, ["date"], [{"date": "2024-01-08"}])
    assert [r.v for r in W.read_table(spark, p).collect()] == [2]
    W.replace_periods(spark, none, p, ["date"], [{"date": "2024-01-15 00:00:00"}])
    assert W.read_table(spark, p).count() == 0


def test_replace_ignoring_keeps_other_periods(spark, tmp_table):
    p = tmp_table()
    W.write_append(df(spark, [(D1, "a", 1), (D2, "b", 2), (D2, "c", 3)]), p, ["ds"])
    W.replace_periods_ignoring(spark, df(spark, [(D2, "a", 7), (D2, "b", 9), (D2, "b", 8), (D2, "d", 4)]), p, ["ds"],
                               [{"ds": D2}], ["k"], ["v"])
    assert rows(spark, p) == [(D1, "a", 1), (D2, "b", 8), (D2, "d", 4)]


def test_partitioned_writes_are_clustered(spark, tmp_table):
    p = tmp_table()
    data = spark.range(0, 400, 1, 8).select(F.date_add(F.lit(D1), (F.col("id") % 5).cast("int")).alias("ds"), "id")
    W.write_append(data, p, ["ds"])
    files = W.read_table(spark, p).inputFiles()
    assert len(files) == 5


def test_first_per_key_shares_one_shuffle(spark, tmp_table):
    """Broadcast off: the batch is shuffled once for dedup and anti join, and the
    target's scan gets the batch's range."""
    p = tmp_table()
    schema = "event_id long not null, user string not null, at timestamp_ntz not null"
    batch = spark.createDataFrame(spark.range(50).select(
        "id", F.concat(F.lit("u"), F.col("id") % 5), F.lit("2024-01-09").cast("timestamp_ntz")).rdd, schema)
    batch.write.parquet(p)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = J.anti_new_rows(batch, spark.read.parquet(p), ["user", "at"], ["event_id"],
                              ("at", "2024-01-08", "2024-01-15"))
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2                    # batch and target, once each
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan       # before and after the shuffle
    assert "GreaterThanOrEqual(at,2024-01-08T00:00)" in plan and "LessThan(at,2024-01-15T00:00)" in plan
    assert new.count() == 0


def files(spark, path):
    """Data files and when they were written."""
    return {f: m for f, m in W.read_table(spark, path).select("_metadata.file_path", "_metadata.file_modification_time")
            .distinct().collect()}


def test_tables_are_in_the_catalogue(spark, tmp_table):
    p = tmp_table()
    W.write_append(df(spark, [(D1, "a", 1), (D2, "b", 2)]), p, ["ds"])
    name = W.table_name(p)
    assert spark.catalog.tableExists(name) and spark.table(name).count() == 2
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["ds=2024-01-08", "ds=2024-01-09"]
    W.replace_periods(spark, df(spark, []), p, ["ds"], [{"ds": D1}])
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["ds=2024-01-09"]
    # a name works as well as a folder
    W.write_append(df(spark, [(D3, "c", 3)]), name)
    assert rows(spark, p) == [(D2, "b", 2), (D3, "c", 3)]
    # another application finds the folder
    spark.sql(f"DROP TABLE {name}")
    assert not spark.catalog.tableExists(name)
    W.write_append(df(spark, [(D1, "7", 7)]), p, ["ds"])
    assert W.read_table(spark, p).schema["ds"].dataType.simpleString() == "date" and W.read_table(spark, p).count() == 3


def test_partition_types_follow_the_batch(spark, tmp_table):
    p = tmp_table()
    data = df(spark, [(D1, "01", 1), (D1, None, 2), (D2, "a b/c=d'e", 3)])
    W.write_append(data, p, ["k"])
    spark.sql(f"DROP TABLE {W.table_name(p)}")
    W.replace_periods(spark, df(spark, [(D3, "01", 9)]), p, ["k"], [{"k": None}, {"k": "a b/c=d'e"}, {"k": "none"}])
    assert rows(spark, p) == [(D3, "01", 9)] or rows(spark, p) == [(D3, 1, 9)]
    assert W.read_table(spark, p).first()["k"] == "01"


def test_range_replace_cuts_through_days(spark, tmp_table):
    p = tmp_table()
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    frame = lambda rows: spark.createDataFrame(
        [(t and t.date() or D1, t, v) for t, v in rows], "ds date, at timestamp_ntz, v long")
    W.write_append(frame([(at(d, h), 100 * d + h) for d in (8, 9, 10, 11) for h in (3, 9, 15, 21)] + [(None, 0)]), p, ["ds"])
    before = files(spark, p)
    W.write_range_replace(spark, frame([(at(8, 12), 1), (at(9, 23), 2)]), p, "at", "2024-01-08 12:00:00",
                          "2024-01-10 12:00:00", ["ds"])
    got = sorted(r.v for r in W.read_table(spark, p).collect())
    assert got == [0, 1, 2, 803, 809, 1015, 1021, 1103, 1109, 1115, 1121]
    kept = [f for f in before if "ds=2024-01-11" in f]
    assert {f: files(spark, p)[f] for f in kept} == {f: before[f] for f in kept} and len(kept) == 1
    # a range that takes all of a day drops its partition
    W.write_range_replace(spark, frame([]), p, "at", "2024-01-11", "2024-01-12", ["ds"])
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {W.table_name(p)}").collect()] == \
        ["ds=2024-01-08", "ds=2024-01-09", "ds=2024-01-10"]
    with pytest.raises(ValueError, match="1 rows outside"):
        W.write_range_replace(spark, frame([(at(8, 13), 1), (at(12, 0), 2)]), p, "at", "2024-01-08", "2024-01-09", ["ds"])
    q = tmp_table()
    W.write_range_replace(spark, frame([(at(8, 3), 1), (at(9, 3), 2)]), q, "at", "2024-01-08", "2024-01-10")
    W.write_range_replace(spark, frame([(at(9, 5), 3)]), q, "at", "2024-01-09", "2024-01-10")
    assert sorted(r.v for r in W.read_table(spark, q).collect()) == [1, 3]


def test_moved_keys_rewrite_two_partitions(spark, tmp_table):
    p = tmp_table()
    days = [D1 + dt.timedelta(days=i) for i in range(6)]
    W.upsert(spark, df(spark, [(d, f"{d}-{i}", i) for d in days for i in range(3)]), p, ["k"], ["ds"])
    before = files(spark, p)
    W.upsert(spark, df(spark, [(days[4], f"{days[1]}-0", 50)]), p, ["k"], ["ds"])
    after = files(spark, p)
    same = [f for f in before if after.get(f) == before[f]]
    assert len(same) == 4 and not any(f"ds={d}" in f for f in same for d in (days[1], days[4]))
    got = rows(spark, p)
    assert len(got) == 18 and (days[4], f"{days[1]}-0", 50) in got and (days[1], f"{days[1]}-0", 0) not in got


def test_observed_range_prunes_the_target(spark, tmp_table):
    """Without a range given, insert-ignore reads only the batch's own days."""
    p = tmp_table()
    schema = "ds date, user string, at timestamp_ntz, v long"
    day = lambda i: D1 + dt.timedelta(days=i)
    make = lambda ds, v: spark.createDataFrame(
        [(day(i), f"u{u}", dt.datetime.combine(day(i), dt.time(u)), v) for i in ds for u in range(3)], schema)
    W.write_append(make(range(20), 1), p, ["ds"])
    target = W.read_table(spark, p)
    for parts, most in ((["ds"], 2), ((), 20)):      # partition files read
        with W.new_rows(make([18, 19, 20], 2), target, ["user", "at"], ["v"], parts) as new:
            plan = new._jdf.queryExecution().toString()
            assert {(r.ds, r.v) for r in new.collect()} == {(day(20), 2)}
            assert "GreaterThanOrEqual(at,2024-01-26T00:00)" in plan and "LessThanOrEqual(at,2024-01-28T02:00)" in plan
            read = [f for f in new.inputFiles() if p.rsplit("/", 1)[1] in f]
            assert len(read) == most
    W.insert_ignore(spark, make([18, 19, 20], 2), p, ["user", "at"], ["v"], ["ds"], partitions_follow_key=True)
    got = W.read_table(spark, p)
    assert got.count() == 63 and got.filter("v = 2").select("ds").distinct().count() == 1
