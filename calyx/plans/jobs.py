"""The reference's end-to-end flows as Spark jobs built from the
operators.  Each step is idempotent, so a re-run of the same period leaves
the same tables.

* ``daily_load``      §3.1: landing JSON → normalise → raw (period replace)
                      → A1 → aggregate (period replace) → TSV export.
* ``weekly_new_users`` §3.3: landing JSON → raw (insert-ignore) → users
                      dimension (first activity, insert-ignore) → readiness
                      → J2 new-user row (insert if absent) → TSV-with-header export.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from ..functions import calendar as cal
from ..operators import aggregates as A
from ..operators import filters as flt
from ..operators import normalize as N
from ..operators import quality as Q
from ..operators import sinks as X
from ..operators import writes as W
from ..sources import records as R
from .specs import resolve_period


def daily_load(spark: SparkSession, landing: str, ds: str, warehouse: str,
               export_base: str | None = None) -> dict:
    """§3.1 for run date ``ds``; returns the table and export paths."""
    raw_path = os.path.join(warehouse, "raw_attempts")
    agg_path = os.path.join(warehouse, "agg_daily_user_type")
    recs = R.read_attempts(spark, landing, ds, cal.shift_days(ds, 1))
    raw = N.normalize_attempts(recs).withColumn("ds", cal.as_date(ds))
    W.replace_periods(spark, raw, raw_path, ["ds"], [{"ds": ds}])
    day_rows = flt.filter_stamp(W.read_table(spark, raw_path), ds=ds)
    agg = A.daily_user_type(day_rows, ds).withColumn("ds", cal.as_date(ds))
    W.replace_periods(spark, agg, agg_path, ["ds"], [{"ds": ds}])
    out = {"raw": raw_path, "agg": agg_path}
    if export_base:
        target = X.export_path(export_base, "agg_daily_user_type", ds)
        rows = X.period_rows_for_export(
            W.read_table(spark, agg_path).withColumnRenamed("ds", "load_date"), ds)
        X.export_delimited(rows.drop("load_date"), target)
        out["export"] = target
    return out


def weekly_new_users(spark: SparkSession, landing: str, ds: str, warehouse: str,
                     export_base: str | None = None) -> dict:
    """§3.3 for the calendar week holding ``ds``."""
    week = resolve_period(spark, "week", ds)
    start, end = str(week["period_start"]), str(week["period_end"])
    raw_path = os.path.join(warehouse, "raw_attempts_weekly")
    users_path = os.path.join(warehouse, "users")
    agg_path = os.path.join(warehouse, "agg_new_users")
    keys = ["lti_user_id", "created_at"]
    batch = N.normalize_attempts(R.read_attempts(spark, landing, start, end))
    W.insert_ignore(spark, batch, raw_path, keys, ["event_id"], within=("created_at", start, end))  # W5
    raw = W.read_table(spark, raw_path)
    firsts = A.first_activity(raw, start, end)                                   # A26
    W.insert_ignore(spark, firsts, users_path, ["lti_user_id"], ["first_activity"])
    ready = Q.ready(spark, {"raw": flt.in_range(raw, "created_at", start, end),  # Q2
                            "users": W.read_table(spark, users_path)}).first()
    out = {"raw": raw_path, "users": users_path, "agg": agg_path, "ready": bool(ready.ready)}
    if not ready.ready:
        return out
    row = A.new_users_from_dim(raw, W.read_table(spark, users_path), start, end)  # J2
    W.insert_if_period_absent(spark, row, agg_path, "period_start", start)       # ON CONFLICT
    if export_base:                                                              # X2
        target = X.export_path(export_base, "agg_new_users", start)
        X.export_delimited(flt.filter_stamp(W.read_table(spark, agg_path), period_start=start),
                           target, header=True)
        out["export"] = target
    return out
