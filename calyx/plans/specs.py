"""Config-driven aggregates (SRC7, C1–C5).

A spec declares one aggregate table: a named aggregate of
``operators.aggregates``, a Spark SQL SELECT over named source views, or group
columns with measures; the period it covers, how it is written, its checks and
export. ``run_aggregates`` resolves the periods from the run date, filters each
shared source once to the union of the specs' periods and caches that scan
(only the columns its specs declare). A run is all or nothing (C5): the rows of
every spec are staged first, counted while they are written, and checked; only
when all have passed are the tables written, in order, and then the exports.
Specs given as groups and measures of one source and period are computed
together, by GROUPING SETS: one scan and one shuffle for all of them.

A run owns one period of its table. Which one follows from the partition
columns: ``ds``, ``load_date``, ``period_start``, ``week_start``,
``month_start`` and ``year_month`` are known, any other stamp is declared in
``stamps`` as the bound it holds (so ``period_end`` may be the last day or the
exclusive end); a period that can't be derived raises.

Spec SQL is bound with ``spark.sql(text, args=..., **views)``: parameters
are named markers (``:ds``, ``:period_start``, ``:period_end``) and sources
are DataFrames passed by name — no string formatting of values into SQL.
``IDENTIFIER(:table_name)`` is the spec's own table in the catalogue, as it was
before the run (C2); ``schema`` creates it where it may not exist yet.
"""

from __future__ import annotations

import json
from contextlib import ExitStack
from dataclasses import dataclass, field, fields

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import calendar as cal
from ..operators import aggregates as A
from ..operators import filters as flt
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import sinks as X
from ..operators import writes as W
from ..operators.normalize import order_by_first_column


#: aggregates a spec may name: (source rows, bounds of the run) -> rows
AGGREGATES = {
    "daily_by_type": lambda df, b: A.daily_by_type(df, b["ds"]),
    "daily_by_user": lambda df, b: A.daily_by_user(df, b["ds"]),
    "daily_user_type": lambda df, b: A.daily_user_type(df, b["ds"]),
    "weekly_user_type": lambda df, b: A.weekly_user_type(df, b["ds"]),
    "weekly_global": lambda df, b: A.weekly_global(df, b["ds"]),
    "monthly_user_attempts": lambda df, b: A.monthly_user_attempts(df, b["ds"]),
    "monthly_lesson_stats": lambda df, b: A.monthly_lesson_stats(df, b["ds"]),
    "monthly_daily_activity": lambda df, b: A.monthly_daily_activity(df, b["ds"]),
    "monthly_summary": lambda df, b: A.monthly_summary(df, b["ds"]),
    "prev_week_by_type": lambda df, b: A.prev_week_by_type(df, b["ds"]),
    "prev_week_by_user": lambda df, b: A.prev_week_by_user(df, b["ds"]),
    "prev_week_summary": lambda df, b: A.prev_week_summary(df, b["ds"]),
    "nonnull_by_type": lambda df, b: A.nonnull_by_type(
        flt.in_range(df, "created_at", b["period_start"], b["period_end"])),
}

#: stamp columns whose meaning their name tells, and the bound they hold
KNOWN_STAMPS = {"ds": "ds", "load_date": "ds", "period_start": "period_start", "week_start": "period_start",
                "month_start": "period_start", "year_month": "year_month"}


@dataclass
class AggSpec:
    name: str
    sql: str = ""
    aggregate: str = ""                 # a name in AGGREGATES, instead of sql
    group_by: tuple = ()                # or group columns (SQL, optionally "expression as name")
    measures: dict = field(default_factory=dict)   # with aggregates (SQL) by name
    source: str = "attempts"            # the source a named aggregate or a grouping reads
    schema: str = ""                    # columns (DDL) of a table to create if it doesn't exist
    columns: tuple = ()                 # source columns the spec reads (prunes the shared cache)
    stamps: dict = field(default_factory=dict)   # partition column -> period bound it holds
    period: str = "day"                 # day | rolling_week | week | prev_week | month
    # append | overwrite | replace_period | replace_ignore (delete the period, then first key wins)
    # | upsert | insert_ignore
    write_mode: str = "replace_period"
    partition_by: tuple = ()
    keys: tuple = ()
    order_by: tuple = ()
    min_rows: int = 0
    max_null_pct: float | None = None   # Q6 limit for every critical column
    critical_columns: tuple = ()
    export: bool = False
    export_columns: tuple | None = None
    export_format: str = "tsv"          # tsv | csv | json
    export_layout: str = "table/ds"
    on_empty_export: str = "write"      # write | skip | fail
    export_prefix: str | None = None    # export folder name (default: the spec name)
    on_empty_source: str = "run"        # run | skip (Q8) | fail (Q9) when the period has no rows

    @classmethod
    def from_dict(cls, d: dict) -> "AggSpec":
        names = {f.name for f in fields(cls)}
        unknown = set(d) - names
        if unknown:
            raise ValueError(f"unknown spec fields {sorted(unknown)}")
        kw = {k: tuple(v) if isinstance(v, list) else v for k, v in d.items()}
        spec = cls(**kw)
        if [bool(spec.sql), bool(spec.aggregate), bool(spec.measures)].count(True) != 1:
            raise ValueError(f"{spec.name}: give either sql or aggregate or measures")
        if spec.aggregate and spec.aggregate not in AGGREGATES:
            raise ValueError(f"{spec.name}: no aggregate {spec.aggregate!r}")
        if spec.write_mode in ("insert_ignore", "replace_ignore") and not (spec.keys and spec.order_by):
            raise ValueError(f"{spec.name}: {spec.write_mode} needs keys and order_by, the order rows arrived in")
        return spec

    def reads(self, source: str) -> bool:
        return "{" + source + "}" in self.sql if self.sql else self.source == source


def example_specs(name: str) -> list[AggSpec]:
    """Bundled spec sets: 'daily', 'monthly', 'prev_week' (plans/examples/*.json)."""
    import os
    path = os.path.join(os.path.dirname(__file__), "examples", f"{name}.json")
    with open(path, encoding="utf-8") as fh:
        return load_specs(fh.read())


def load_specs(text_or_list) -> list[AggSpec]:
    """SRC7 — specs from a JSON document (text) or a list of dicts.

    The document is data only; nothing in it is executed as code.
    """
    items = json.loads(text_or_list) if isinstance(text_or_list, str) else text_or_list
    return [AggSpec.from_dict(d) for d in items]


def read_specs(spark: SparkSession, name: str) -> list[AggSpec]:
    """SRC7 — a bundled set by its name, or a JSON file from any storage that Spark reads."""
    if "/" not in name and not name.endswith(".json"):
        return example_specs(name)
    (text,) = (r[0] for r in spark.read.text(name, wholetext=True).collect())        # one file
    return load_specs(text)


@dataclass
class RunResult:
    spec: AggSpec
    path: str
    exported: str | None = None
    checks: dict = field(default_factory=dict)


def resolve_period(spark: SparkSession, kind: str, ds: str) -> dict:
    """Period bounds of the run as DATE values (one-row evaluation of the
    calendar expressions), for binding as SQL literals."""
    s, e = cal.period_bounds(kind, ds)
    row = spark.range(1).select(cal.as_date(ds).alias("ds"), s.alias("period_start"),
                                e.alias("period_end"),
                                F.date_sub(e, 1).alias("period_last")).first()
    return {**row.asDict(), "year_month": str(row.period_start)[:7]}


def run_aggregates(spark: SparkSession, specs, ds: str, sources: dict, base_path: str,
                   export_base: str | None = None, ts_cols: dict | None = None) -> list[RunResult]:
    """C1 — create → fill → check → publish → export, all specs or none.

    ``sources`` maps view names to DataFrames; ``ts_cols`` names each
    source's time column so the shared scan can be cut to the specs' periods
    before it is cached (specs sharing a source share one scan). A step that
    fails, or whose check does, leaves every table and export of the run as it
    was; tables created for the run are dropped again.
    """
    from .sql_functions import register_sql_functions
    register_sql_functions(spark)
    ts_cols = ts_cols or {}
    kinds = {s.period for s in specs}
    shared = {}
    for name, df in sources.items():
        c = ts_cols.get(name)
        if c:
            cond = F.lit(False)
            for k in kinds:
                s, e = cal.period_bounds(k, ds)
                cond = cond | ((F.col(c) >= flt._bound(df, c, s)) & (F.col(c) < flt._bound(df, c, e)))
            df = df.filter(cond)
        readers = [sp for sp in specs if sp.reads(name)]
        if readers and all(sp.columns for sp in readers):
            wanted = {x for sp in readers for x in sp.columns} | ({c} if c else set())
            df = df.select(*[x for x in df.columns if x in wanted])
        # cache only a scan that several passes read; a single reader streams it
        passes = {(sp.period,) if sp.measures else sp.name for sp in readers}
        shared[name] = df.persist(StorageLevel.MEMORY_AND_DISK) if len(passes) > 1 else df
    bounds_of = {kind: resolve_period(spark, kind, ds) for kind in kinds}
    created, results, steps = [], [], []
    with ExitStack() as stages:
        for df in shared.values():
            stages.callback(df.unpersist)
        try:
            fused = _fused(spark, specs, shared, bounds_of, ts_cols, stages)
            for spec in specs:
                bounds = bounds_of[spec.period]
                if spec.on_empty_source != "run" and not _period_has_rows(shared, ts_cols, bounds, spec):
                    if spec.on_empty_source == "fail":
                        raise Q.QualityError(f"{spec.name}: no source rows for {ds}")
                    results.append(RunResult(spec, "", checks={"skipped": "empty source"}))
                    continue
                path = f"{base_path.rstrip('/')}/{spec.name}"
                if spec.schema and W.create_if_missing(spark, path, StructType.fromDDL(spec.schema),
                                                       list(spec.partition_by) or None):
                    created.append(path)
                if spec.name in fused:
                    rows, counts = fused[spec.name]
                else:
                    stage = W.Staged(_rows_of(spark, spec, shared, bounds, path), spec.name,
                                     observe=_counts(spec.critical_columns))
                    rows = stages.enter_context(stage)
                    counts = stage.seen
                results.append(RunResult(spec, path, checks=_checked(spark, spec, rows, counts, path, bounds)))
                steps.append((results[-1], rows, bounds))
        except BaseException:
            for path in created:
                W.drop_table(spark, path)
            raise
        for res, rows, bounds in steps:
            _write(spark, res.spec, rows, res.path, bounds)
        for res, rows, bounds in steps:
            if res.spec.export and export_base:
                res.exported = _export(spark, res.spec, rows, res.path, bounds, export_base)
    return results


def _counts(columns) -> list:
    """All rows, and the rows with a value in each of ``columns``, to be observed."""
    return [F.count(F.lit(1)).alias("rows"), *(F.count(Q._named(c)).alias(f"has_{c}") for c in columns)]


def _fused(spark, specs, shared: dict, bounds_of: dict, ts_cols: dict, stages: ExitStack) -> dict:
    """Spec name -> (rows, observed counts) of the specs given as groups and measures.

    Those of one source and period are grouped together by GROUPING SETS and
    staged by set, so that each spec then reads its own folder.
    """
    together: dict[tuple, list] = {}
    for spec in specs:
        if spec.measures:
            together.setdefault((spec.source, spec.period), []).append(spec)
    out = {}
    for (source, period), group in together.items():
        bounds, df, c = bounds_of[period], shared[source], ts_cols.get(source)
        if c:
            df = flt.in_range(df, c, bounds["period_start"], bounds["period_end"])
        keys: dict[str, str] = {}                       # expression -> column
        names = {}
        for spec in group:
            for g in spec.group_by:
                expression, _, name = g.rpartition(" as ") if " as " in g else (g, "", g)
                keys.setdefault(expression, f"__g{len(keys)}")
                names.setdefault(spec.name, []).append((name, keys[expression]))
        df = df.withColumns({col: F.expr(e) for e, col in keys.items()})
        sets = list(dict.fromkeys(tuple(col for _, col in names.get(spec.name, [])) for spec in group))
        measures = list(dict.fromkeys(m for spec in group for m in spec.measures.values()))
        bit = {col: 1 << (len(keys) - 1 - i) for i, col in enumerate(keys.values())}
        number = {tuple(st): sum(bit.values()) - sum(bit[col] for col in st) for st in sets}
        if keys:
            grouped = df.groupingSets([[F.col(x) for x in st] for st in sets], *keys.values()).agg(
                F.grouping_id().cast("long").alias("__set"), *[F.expr(m).alias(f"__m{i}") for i, m in enumerate(measures)])
        else:
            grouped = df.agg(F.lit(0).cast("long").alias("__set"),
                             *[F.expr(m).alias(f"__m{i}") for i, m in enumerate(measures)])
        seen, picks = [], {}
        for spec in group:
            here = F.col("__set") == number[tuple(col for _, col in names.get(spec.name, []))]
            cols = {name: F.col(col) for name, col in names.get(spec.name, [])}
            cols |= {name: F.col(f"__m{measures.index(m)}") for name, m in spec.measures.items()}
            picks[spec.name] = here, cols
            seen.append(F.count_if(here).alias(f"{spec.name}/rows"))
            seen += [F.count_if(here & cols[x].isNotNull()).alias(f"{spec.name}/has_{x}")
                     for x in spec.critical_columns if x in cols]
        stage = W.Staged(grouped, f"{source}-{period}", ["__set"], observe=seen)
        rows = stages.enter_context(stage)
        for spec in group:
            here, cols = picks[spec.name]
            cols |= {x: F.lit(_stamp(spec, x, bounds)) for x in spec.partition_by if x not in cols}
            counts = {k.partition("/")[2]: v for k, v in stage.seen.items() if k.partition("/")[0] == spec.name}
            out[spec.name] = rows.filter(here).select(*[col.alias(name) for name, col in cols.items()]), counts
    return out


def _checked(spark, spec: AggSpec, rows: DataFrame, counts: dict, path: str, bounds: dict) -> dict:
    """Q5 and Q6 on the rows the run's period will hold; raises when one fails, or when an export may not be empty.

    A run that replaces its period has just the staged rows, whose counts were
    observed as they were written; other modes are asked what they will leave.
    """
    wanted = spec.min_rows or (spec.max_null_pct is not None and spec.critical_columns) or \
        (spec.export and spec.on_empty_export == "fail")
    if not wanted:
        return {}
    if spec.write_mode not in ("replace_period", "overwrite") or any(f"has_{c}" not in counts for c in spec.critical_columns):
        counts = _after(spark, spec, rows, path, bounds).agg(*_counts(spec.critical_columns)).first().asDict()
    checks = {}
    if counts["rows"] < spec.min_rows:
        raise Q.QualityError(f"{spec.name}: {counts['rows']} rows < required {spec.min_rows}")
    if spec.min_rows:
        checks["min_rows"] = True
    if spec.max_null_pct is not None and spec.critical_columns:
        limits = {c: spec.max_null_pct for c in spec.critical_columns}
        shares = Q.null_shares(spark, counts["rows"], {c: counts[f"has_{c}"] for c in limits}, limits)
        failed = [r.column_name for r in shares.collect() if not r.passed]          # a row per critical column
        if failed:
            raise Q.QualityError(f"{spec.name}: NULL share above {spec.max_null_pct}% in {failed}")
        checks["null_pct"] = True
    if spec.export and spec.on_empty_export == "fail" and not counts["rows"]:
        raise X.EmptyExportError(f"{spec.name}: nothing to export")
    return checks


def _after(spark, spec: AggSpec, rows: DataFrame, path: str, bounds: dict) -> DataFrame:
    """The rows that the run's period will hold once ``rows`` are written."""
    if spec.write_mode in ("replace_period", "overwrite") or not W.table_exists(spark, path):
        dedup = spec.write_mode in ("replace_ignore", "insert_ignore")
        return J.dedup_first_wins(rows, spec.keys, spec.order_by) if dedup else rows
    table = W.read_table(spark, path)
    if spec.write_mode == "append":
        table = table.unionByName(rows)
    elif spec.write_mode == "upsert":
        table = J.upsert_frames(table, rows, spec.keys)
    elif spec.write_mode == "insert_ignore":
        table = table.unionByName(J.anti_new_rows(rows, table, spec.keys, spec.order_by))
    else:
        first = J.dedup_first_wins(rows, spec.keys, spec.order_by)
        others = table.exceptAll(_owned(spec, table, bounds))
        return first.join(others.select(*spec.keys), list(spec.keys), "left_anti").select(*rows.columns)
    return _owned(spec, table, bounds)


def _rows_of(spark, spec: AggSpec, shared: dict, bounds: dict, path: str) -> DataFrame:
    """The spec's rows, lazily, with the partition stamps its aggregate doesn't make itself."""
    if spec.aggregate:
        out = AGGREGATES[spec.aggregate](shared[spec.source], bounds)
        missing = [c for c in spec.partition_by if c not in out.columns]
        return out.withColumns({c: F.lit(_stamp(spec, c, bounds)) for c in missing}) if missing else out
    args = {k: v for k, v in bounds.items() if f":{k}" in spec.sql}
    if ":table_name" in spec.sql:  # C2: the target as an identifier, or its name as a value
        named = "identifier(:table_name)" in spec.sql.lower()
        if named:
            W.read_table(spark, path)                      # registers a folder; fails if there is no table
        args["table_name"] = W.table_name(path) if named else spec.name
    views = {k: v for k, v in shared.items() if spec.reads(k)}
    return spark.sql(spec.sql, args=args, **views)


def _stamp(spec: AggSpec, column: str, bounds: dict):
    """The value that this run's rows hold in a stamp column."""
    bound = spec.stamps.get(column) or KNOWN_STAMPS.get(column)
    if bound not in bounds:
        raise ValueError(f"{spec.name}: which period a run owns can't be told from {column!r}; declare it in "
                         f"stamps as one of {sorted(bounds)}")
    return bounds[bound]


def _owned(spec: AggSpec, table: DataFrame, bounds: dict) -> DataFrame:
    """The rows of the period this run owns; the whole table where it has no stamps."""
    for c in spec.partition_by:
        table = table.filter(F.col(c) == F.lit(_stamp(spec, c, bounds)).cast(table.schema[c].dataType))
    if not spec.partition_by and "load_date" in table.columns and spec.write_mode != "overwrite":
        table = X.period_rows_for_export(table, bounds["ds"])              # X9
    return table


def _period_has_rows(shared: dict, ts_cols: dict, bounds: dict, spec: AggSpec) -> bool:
    """Q8 / Q9 — any row of a source used by the spec inside its period (LIMIT 1 probe)."""
    for name, df in shared.items():
        c = ts_cols.get(name)
        if not spec.reads(name) or not c:
            continue
        if not flt.in_range(df, c, bounds["period_start"], bounds["period_end"]).isEmpty():
            return True
    return False


def _write(spark, spec: AggSpec, out: DataFrame, path: str, bounds: dict) -> None:
    parts = list(spec.partition_by)
    m = spec.write_mode
    if m == "append":
        W.write_append(out, path, parts or None)
    elif m == "overwrite":
        W.write_full_refresh(out, path, parts or None)
    elif m in ("replace_period", "replace_ignore"):
        if not parts:
            raise ValueError(f"{spec.name}: {m} needs partition_by stamp columns")
        periods = [{c: _stamp(spec, c, bounds) for c in parts}]
        if m == "replace_period":
            W.replace_periods(spark, out, path, parts, periods)
        else:
            W.replace_periods_ignoring(spark, out, path, parts, periods, spec.keys, spec.order_by)
    elif m == "upsert":
        W.upsert(spark, out, path, spec.keys, parts or None)
    elif m == "insert_ignore":
        W.insert_ignore(spark, out, path, spec.keys, spec.order_by, parts or None)
    else:
        raise ValueError(f"unknown write mode {m!r}")


def _export(spark, spec: AggSpec, rows: DataFrame, path: str, bounds: dict, export_base: str) -> str:
    """The rows this run owns (X9), ordered by their first column (S3); where it replaced them, they are still staged."""
    df = _owned(spec, rows if spec.write_mode == "replace_period" else W.read_table(spark, path), bounds)
    if spec.export_columns:
        df = df.select(*spec.export_columns)
    target = X.export_path(export_base, spec.export_prefix or spec.name, bounds["ds"], spec.export_layout,
                           bounds["period_start"], bounds["period_last"], spec.export_format)
    write = {"json": X.export_json, "csv": X.export_csv, "tsv": X.export_delimited}[spec.export_format]
    write(order_by_first_column(df), target, on_empty=spec.on_empty_export)
    return target


def run_summary(spark: SparkSession, results: list[RunResult]) -> DataFrame:
    """Spec name and row count of every written table (a lazy union of counts)."""
    from functools import reduce
    parts = [W.read_table(spark, r.path).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(r.spec.name).alias("spec_name"), "row_count")
             for r in results if r.path]
    return reduce(DataFrame.unionByName, parts)
