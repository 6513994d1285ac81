"""Session construction and the shared work folder.

Settings that change results (UTC, ANSI, NTZ inference) are fixed here;
settings that only change speed (shuffle partitions, file split size) are
parameters so a cluster submit can size them for its data.
"""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

# Result-affecting settings: every session that runs calyx code must agree.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Speed settings; AQE re-plans joins, coalesces small shuffle partitions and
# splits skewed ones at run time.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "calyx",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with calyx's result settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**SPEED_CONF, **RESULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_result_conf(spark)
    return spark


def apply_result_conf(spark: SparkSession) -> None:
    """Set the result-affecting SQL settings on an existing session."""
    for k, v in RESULT_CONF.items():
        spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and exports.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    on a local master (tests) a fresh folder is created and registered. On any
    other master a folder of one machine would not be seen by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jdir.get() if jdir.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="calyx-ckpt-"))
        base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return base


_removed_at_exit: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared work folder, in a folder of this application.

    Staged tables are read lazily, so they can't go when the function that
    wrote them ends; the application's folder goes when its driver ends.
    """
    folder = os.path.join(work_dir(spark), "calyx", spark.sparkContext.applicationId)
    if folder not in _removed_at_exit:
        _removed_at_exit.add(folder)
        atexit.register(_remove, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex[:12]}")


def _remove(jvm, conf, folder: str) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    try:
        path.getFileSystem(conf).delete(path, True)
    except Exception as gone:      # the driver's JVM has ended before, by a signal say: nothing can be removed then
        print(f"calyx: {folder} was not removed ({type(gone).__name__})", file=sys.stderr)
