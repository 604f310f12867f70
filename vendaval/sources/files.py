"""Batch sources and sinks.

Writes that partition by a column go through a REBALANCE hint: adaptive execution then splits a value that holds a
large share of the rows over several tasks and merges tiny ones, so one heavy day never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas


def read_csv(
    spark: SparkSession, path: str, schema: StructType, quote: str = '"', escape: str = "\\", multi_line: bool = False
) -> DataFrame:
    options = {"header": "true", "quote": quote, "escape": escape, "multiLine": str(multi_line).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


def read_entity_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """One of the nine raw entities, with its declared schema and quoting rules."""
    reader = spark.read.schema(schemas.SOURCES[entity]).option("header", "true")
    return reader.options(**schemas.CSV_OPTIONS.get(entity, {})).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types guessed from the data, at the cost of one more scan. For exploration."""
    return spark.read.options(header="true", inferSchema="true").csv(path)


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet path, or the name of a catalog table."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.select(*columns) if columns else df


def source_file() -> Column:
    return F.input_file_name()


def with_ingest_metadata(
    df: DataFrame, ts: datetime | Column, source: str | Column | None = None, batch: str | None = None
) -> DataFrame:
    """Lineage columns. The time is an argument so that a rerun gives the same rows."""
    stamp = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    origin = source_file() if source is None else source if isinstance(source, Column) else F.lit(source)
    return df.withColumns({
        "_ingestao_ts": stamp, "_fonte": origin, "_versao_ingestao": F.lit(batch).cast("string"),
    })


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str], mode: str = "append") -> None:
    """Append to, or replace, the touched partitions of a partitioned table."""
    columns = [by] if isinstance(by, str) else list(by)
    writer = df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_overwrite_schema(df: DataFrame, path: str) -> None:
    """Replace data and schema. The target must not be an input of ``df``; write a new snapshot in that case."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_with_schema_merge(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All columns any file of the table ever had."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def create_table_as(df: DataFrame, name: str, ts: datetime | None = None, path: str | None = None) -> None:
    """Catalog table from a query, stamped with the ingest time. ``path`` makes it external."""
    out = df if ts is None else df.withColumn("_ingestao_ts", F.lit(ts).cast("timestamp"))
    writer = out.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def export_clustered(df: DataFrame, path: str, dist_key: str, sort_key: str, parts: int | None = None) -> None:
    """Hand-off files hashed by one key and sorted by another within each file.

    A rebalance keeps the rows of a key together and splits only what is too large for one file, so a key that holds a
    large share of the rows is written by as many tasks as its size asks for.
    """
    spread = df.hint("rebalance", *([parts] if parts else []), dist_key)
    spread.sortWithinPartitions(sort_key).write.mode("overwrite").parquet(path)


