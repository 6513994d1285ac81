"""Export sinks X1–X9: delimited text, CSV with header, JSON lines, partitioned
layouts, empty-result policy, replace-on-write, period selection.

Files are written by the executors in parallel, one per task, and rows are
never gathered for the sake of a file name: an export to a named file gives its
name to the one file of a small result, and numbers the files of a larger one.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from . import filters as flt
from . import writes as W

# Timestamp text in exports: the reference's Python str(datetime) form.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

TSV_OPTIONS = {  # X1: tab, no header, '"' quote doubled inside, minimal quoting, UTF-8
    "sep": "\t", "header": "false", "quote": '"', "escape": '"', "quoteAll": "false",
    "nullValue": "", "emptyValue": "", "encoding": "UTF-8",
    "timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT, "dateFormat": "yyyy-MM-dd",
}


class EmptyExportError(RuntimeError):
    pass


def _on_empty(df: DataFrame, on_empty: str) -> bool:
    """X7 — True when the write should go ahead."""
    if on_empty == "write":
        return True
    if df.isEmpty():
        if on_empty == "fail":
            raise EmptyExportError("export source is empty")
        return False  # skip
    return True


def export_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False,
                     on_empty: str = "write", partition_by=None, mode: str = "overwrite") -> bool:
    """X1 / X2 / X3 (``sep=','``) / X5 / X8.  Returns False when skipped as empty.

    A path that ends in .csv, .tsv or .json names a file, any other a folder.
    """
    opts = dict(TSV_OPTIONS, sep=sep, header=str(header).lower())
    return _export(df, path, on_empty, partition_by, mode, lambda w, to: w.options(**opts).csv(to))


def _export(df: DataFrame, path: str, on_empty: str, partition_by, mode: str, save) -> bool:
    if not _on_empty(df, on_empty):
        return False
    stem, ext = os.path.splitext(path)
    named = ext in (".csv", ".tsv", ".json")
    if named and partition_by:
        raise ValueError(f"{path}: a partitioned export is a folder")
    w = W.clustered(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not named:
        save(w, path)
        return True
    # written beside in a hidden folder, then renamed: readers never see half a file
    spark, (parent, _, name) = df.sparkSession, path.rpartition("/")
    folder = f"{parent}/.{name}.export"
    save(w, folder)
    fs, p = W._fs(spark, folder)
    parts = sorted(st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)
    for k, part in enumerate(parts):
        to = path if len(parts) == 1 else f"{stem}_part{k:05d}{ext}"
        target = spark._jvm.org.apache.hadoop.fs.Path(to)
        fs.delete(target, False)
        if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(part), target):
            raise OSError(f"could not rename {part} to {to}")
    W.delete_path(spark, folder)
    return True


def export_csv(df: DataFrame, path: str, **kw) -> bool:
    """X3 — comma-separated with header."""
    return export_delimited(df, path, sep=",", header=True, **kw)


def export_json(df: DataFrame, path: str, on_empty: str = "write", partition_by=None,
                mode: str = "overwrite") -> bool:
    """X4 — JSON lines document of rows."""
    return _export(df, path, on_empty, partition_by, mode,
                   lambda w, to: w.option("timestampNTZFormat", TS_FORMAT)
                   .option("timestampFormat", TS_FORMAT).option("ignoreNullFields", "false").json(to))


def read_delimited(spark, path: str, schema, sep: str = "\t", header: bool = False) -> DataFrame:
    """Read an export back with its schema (round-trip checks)."""
    opts = dict(TSV_OPTIONS, sep=sep, header=str(header).lower())
    return spark.read.options(**opts).schema(schema).csv(path)


def read_json(spark, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("timestampNTZFormat", TS_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))


def export_path(base: str, table: str, ds, layout: str = "table/ds", start=None, end=None,
                ext: str = "csv") -> str:
    """X5 / X6 — object layouts keyed by the run date: folders, or named files
    (``file`` layouts, for the period ``start`` .. ``end`` where they show it)."""
    ds, ext = str(ds), ext if ext.startswith(".") else f".{ext}"
    layouts = {
        "table/ds": os.path.join(base, table, ds),
        "table/load_date": os.path.join(base, table, f"load_date={ds}"),
        "exports/table/ds": os.path.join(base, "exports", table, f"ds={ds}"),
        "prefix/ds/table_ds": os.path.join(base, ds, f"{table}_{ds}"),
        "file/ds": os.path.join(base, ds, f"{table}_{ds}{ext}"),
        "file/period": os.path.join(base, f"{table}_{start}_to_{end}_{ds}{ext}"),
        "raw": os.path.join(base, "raw", f"{table}_{ds}{ext}"),
        "agg": os.path.join(base, "agg", f"{table}_{ds}{ext}"),
    }
    return layouts[layout]


def export_pair(raw: DataFrame, agg: DataFrame, base: str, table: str, ds, ext: str = "csv",
                on_empty: str = "write") -> dict:
    """X6 — the rows of a run and their aggregate side by side, ``raw/`` and ``agg/``."""
    out = {}
    for kind, df in (("raw", raw), ("agg", agg)):
        path = export_path(base, table, ds, kind, ext=ext)
        sep = "\t" if ext == "tsv" else ","
        if export_delimited(df, path, sep=sep, header=True, on_empty=on_empty):
            out[kind] = path
    return out


def period_rows_for_export(df: DataFrame, ds) -> DataFrame:
    """X9 — rows of run date ``ds``: by ``load_date`` if the table has it, else by ``created_at``."""
    if "load_date" in df.columns:
        return flt.filter_stamp(df, load_date=ds)
    return flt.filter_day(df, ds, "created_at")
