"""Session defaults and the shared scratch folder used by jobs that must cut lineage or land files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key costs one more shuffle at worst; without this a skewed join under an aggregate stays unsplit.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "vendaval", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Local session for development and tests; on a cluster pass your own session to the operators instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Spark removes the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Most bytes that a task sends to Python at once. Spark's own bound of 64 MB counts several times: in Java while a batch grows, and
#: in Python. Results do not depend on it.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder. A cluster may not: files on one machine would be lost
    with it, so the setting has to be there.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vendaval-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Later passes then see the same rows even when an executor is lost between them. What the job shuffled goes with its end,
    for nothing reads it any more. Python functions in it get batches of BATCH_BYTES at most, or one row. Runs one job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with setting(spark, SHUFFLE_CLEANUP, "true"), setting(spark, *BATCH_BYTES):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def release(written: DataFrame) -> None:
    """Remove the files of a result of ``cut_lineage`` that nothing will read again: no lazy DataFrame may still depend on it."""
    remove(written.sparkSession, written._scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path under the shared folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
