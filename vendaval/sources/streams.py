"""Streaming sources and sinks. File sources discover new files; the schema is always declared."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_json_source(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_table_source(
    spark: SparkSession, path: str, schema: StructType | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table read as a stream. Without a schema, the one its files declare is taken once, up front.

    ``path`` is a folder, or a pattern; name a table that is a single file by a pattern.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_append_sink(
    sdf: DataFrame, path: str, checkpoint: str, by: str | Sequence[str] | None = None
) -> StreamingQuery:
    """Append new rows and stop when the input that is available now has been read."""
    writer = sdf.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*([by] if isinstance(by, str) else by))
    return writer.trigger(availableNow=True).start(path)


def stream_complete_sink(sdf: DataFrame, path: str, checkpoint: str, keep: int = 2) -> StreamingQuery:
    """Rewrite the whole aggregate each batch: batch ``n`` lands in ``batch=n``, a rerun replaces its own folder.

    The ``keep`` newest results stay, one for readers that began before the last one was there.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        system, folders = _published(batch.sparkSession, path)
        for folder in folders[:-keep]:
            system.delete(folder, True)

    return foreach_batch_sink(sdf, publish, checkpoint, "complete")


def foreach_batch_sink(
    sdf: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(handle).trigger(availableNow=True).start()


def run_available(*queries: StreamingQuery) -> None:
    """Wait for run-to-end queries. A later start with the same checkpoint reads only new files."""
    for query in queries:
        query.awaitTermination()


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete result of ``stream_complete_sink``; the other folders are listed but not read."""
    _system, folders = _published(spark, path)
    if not folders:
        raise FileNotFoundError(f"no complete batch in {path}")
    return spark.read.parquet(folders[-1].toString())


def _published(spark: SparkSession, path: str):
    """The file system and the folders with a finished batch, oldest first. Order of writing, so that numbers may restart."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    for status in system.listStatus(root):
        folder = status.getPath()
        mark = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if folder.getName().startswith("batch=") and system.exists(mark):
            number = int(folder.getName().removeprefix("batch="))
            done.append((system.getFileStatus(mark).getModificationTime(), number, folder))
    return system, [folder for _, _, folder in sorted(done, key=lambda d: d[:2])]
