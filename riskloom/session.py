"""Session helpers: shared folder, checkpointing and a local session for tests."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from riskloom import limits


def local_session(cores: int | str = 8, app: str = "riskloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    A machine-local folder is made only where the setting is absent and the
    master is local, as in tests.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getCheckpointDir()
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
            context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/riskloom-{uuid.uuid4().hex[:12]}/{name}"


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers: one zip in the shared folder, once per session.

    Workers import the functions of this package by name; they need not run where the package lies.
    """
    context = spark.sparkContext
    if getattr(context, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join("riskloom", os.path.relpath(path, root)))
    target = scratch_path(spark, "riskloom.zip")
    jvm_path = context._jvm.org.apache.hadoop.fs.Path(target)
    out = jvm_path.getFileSystem(context._jsc.hadoopConfiguration()).create(jvm_path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(target)
    context._riskloom_shipped = True


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage through reliable storage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_small(df: DataFrame, rows: int = limits.LOCAL_ROWS) -> DataFrame:
    """A fitted table: local rows if there are few (checked), else reliable storage.

    Local rows join without a job of their own. The table is computed once either way.
    """
    kept = hold(df)
    head = kept.limit(rows + 1).toArrow()
    out = df.sparkSession.createDataFrame(head, df.schema) if head.num_rows <= rows else settle(kept)
    kept.unpersist()
    return out


def hold(df: DataFrame) -> DataFrame:
    """Keep for reuse within one job chain; recomputed from lineage after executor loss."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
