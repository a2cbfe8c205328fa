"""Spark session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "wardflow", driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every operator assumes (UTC, ANSI, AQE).

    Started by spark-submit without ``master``, it keeps the cluster's master,
    memory and shuffle partitions; otherwise it is a local session, whose one
    JVM has ``driver_memory`` (Spark's own default if not given).
    """
    b = SparkSession.builder.appName(app)
    # spark-submit hands its settings to the JVM, which the builder must not override
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if master or not submitted:
        cpus = os.environ.get("BENCH_CPUS", "8")
        b = b.config("spark.driver.memory", driver_memory) if driver_memory else b
        b = (b.master(master or f"local[{cpus}]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
        shuffle_partitions = shuffle_partitions or int(cpus) * 2
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session; only a local-mode session without
    one (tests, benches) gets its own folder.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="wardflow-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_OWNED: list[str] = []


def owned_dir(spark: SparkSession, name: str) -> str:
    """A folder as ``shared_dir`` gives it, for what only this session reads: deleted when Python ends, if the session still runs."""
    if not _OWNED:
        atexit.register(_delete_owned)
    _OWNED.append(shared_dir(spark, name))
    return _OWNED[-1]


def _delete_owned() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for path in _OWNED:
        try:
            delete_path(spark, path)
        except Exception:  # the session may be going down; what is left is in the folder of temporary tables
            return


def cut_lineage(df):
    """Cut lineage through a Parquet table written under the shared
    ``spark.checkpoint.dir`` (read back with the same schema).

    Used where one intermediate feeds several branches of a plan.  The plan
    is computed once (an eager ``checkpoint()`` computes it for its count job
    and again for the checkpoint files), and the files survive executor loss,
    unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = owned_dir(spark, "wardflow-cut")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session wrote under the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def file_stamp(spark: SparkSession, path: str) -> str:
    """Paths, sizes and modification times of the files under ``path``, as its file system lists them.

    Object stores report no time for a folder, so the files themselves are listed; one call a folder.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found, folders = [], [path]
    while folders:
        where = hadoop(folders.pop())
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(fs.listStatus(where))
        found.append(re.sub(r"access_time=\d+", "", text))
        folders += re.findall(r"path=([^;]+); isDirectory=true", text)
    return "".join(sorted(found))
