"""Upserts, incremental loads, dated snapshots and file layout, for plain parquet tables.

Nothing here overwrites a path that it reads: results go to a new folder or to a partition of their own.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, scratch_path, setting
from .windows import dedupe_latest


def _single_source_row(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with a guard: two rows for one key fail the query."""
    row = F.struct(*[F.col(c) for c in source.columns])
    grouped = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_s"))
    stop = F.raise_error(F.lit("upsert source holds a key more than once")).cast("boolean")
    return grouped.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(stop)).select(*keys, "_s")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """Update the listed columns of matched rows and insert unmatched source rows whole.

    With ``sequence``, a source row older than the target row changes nothing. One full outer join on the keys.
    """
    marked = target.select(*keys, F.struct(*[F.col(c) for c in target.columns]).alias("_t"))
    joined = marked.join(_single_source_row(source, keys), list(keys), "full")
    old, new = F.col("_t"), F.col("_s")
    fresh = new.isNotNull()
    if sequence:
        fresh = fresh & (old.isNull() | F.coalesce(new[sequence] >= old[sequence], old[sequence].isNull()))

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        given = new[c].cast(target.schema[c].dataType) if c in source.columns else F.lit(None)
        if c in update_columns:
            return F.when(fresh, given).otherwise(old[c])
        return F.when(old.isNull(), given).otherwise(old[c])

    return joined.select(*[pick(c).alias(c) for c in target.columns])


def make_change_set(
    target: DataFrame, key: str, updates: Mapping[str, Mapping[str, object]], inserts: Sequence[Mapping[str, object]]
) -> DataFrame:
    """Demonstration changes: existing keys with new values, plus new keys. Other columns keep the target's values."""
    changed = target.where(F.col(key).isin(list(updates)))
    columns = sorted({c for values in updates.values() for c in values})
    for c in columns:
        value = F.col(c)
        for k, values in updates.items():
            if c in values:
                value = F.when(F.col(key) == k, F.lit(values[c]).cast(target.schema[c].dataType)).otherwise(value)
        changed = changed.withColumn(c, value)
    names = target.columns
    rows = [tuple(row.get(c) for c in names) for row in inserts]
    added = target.sparkSession.createDataFrame(rows, target.schema) if rows else target.limit(0)
    return changed.unionByName(added)


def merge_latest(target: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Keyed state after the changes: the newest sequence per key wins, whatever the arrival order.

    Equal sequences are settled by the remaining columns, so replaying or reordering batches changes nothing.
    """
    rest = [c for c in target.columns if c not in keys and c != sequence]
    return dedupe_latest(target.unionByName(changes.select(*target.columns)), keys, [sequence, *rest])


def delete_insert_by_key(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Replace the target rows of every key the new rows carry."""
    return target.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*target.columns))


def lookback(df: DataFrame, ts: str, fact: DataFrame, day: str, days: int = 3) -> DataFrame:
    """Input rows from ``days`` before the newest day of the fact. All rows when the fact is empty.

    The newest day is read first (one job, one value), so that the limit is a literal and reaches the scan of ``df``.
    """
    newest = fact.agg(F.max(F.to_date(day))).first()[0]
    return df if newest is None else df.where(F.col(ts) >= F.lit(newest - timedelta(days=days)).cast("timestamp"))


# ---- snapshots: a parquet table partitioned by an integer ``version`` -----------------------------------------------

def publish_snapshot(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("error").parquet(f"{path}/version={version}")


def read_snapshot(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Rows of one version, with that version's columns; no other folder is listed or read."""
    return spark.read.parquet(f"{path}/version={version}")


def restore_snapshot(spark: SparkSession, path: str, version: int, as_version: int) -> None:
    """Publish an older version again as a newer one."""
    publish_snapshot(read_snapshot(spark, path, version), path, as_version)


def snapshot_as_of(history: DataFrame, keys: Sequence[str], version: int, column: str = "version") -> DataFrame:
    """State at a version when each row carries the version that wrote it: the newest row per key up to it."""
    known = history.where(F.col(column) <= version)
    rest = [c for c in history.columns if c not in keys and c != column]
    return dedupe_latest(known, keys, [column, *rest])


def diff_versions(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed, with both values of each column."""
    b = before.select(key, F.struct(*columns).alias("_b"))
    a = after.select(key, F.struct(*columns).alias("_a"))
    old, new = F.col("_b"), F.col("_a")
    change = F.when(old.isNull(), "added").when(new.isNull(), "removed").when(~old.eqNullSafe(new), "changed")
    pairs = [F.col(f"{s}.{c}").alias(f"{c}_{label}") for c in columns for s, label in (("_b", "before"), ("_a", "after"))]
    return b.join(a, key, "full").select(key, change.alias("change"), *pairs).where("change IS NOT NULL")


def label_versions(versions: Mapping[str, DataFrame]) -> DataFrame:
    """Versions stacked under a label, for reading before and after side by side."""
    out = None
    for label, df in versions.items():
        part = df.withColumn("versao", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


# ---- layout ---------------------------------------------------------------------------------------------------------

#: Even parts of a file that are written first.
PARTS = 16


def compact(df: DataFrame, path: str, files: int) -> None:
    """Rewrite into about ``files`` files of even size, by round robin, so no key can make a large one.

    Rows are dealt to PARTS parts a file, written to the shared folder; a task then reads the parts of its file, which are
    encoded and compressed, instead of a file's worth of shuffled rows. Runs two jobs.
    """
    spark, number = df.sparkSession, "_file"
    while number in {c.lower() for c in df.columns}:
        number += "_"
    dealt = df.repartition(files * PARTS).withColumn(number, F.pmod(F.spark_partition_id(), F.lit(files)))
    parts = scratch_path(spark, "parts")
    dealt.write.partitionBy(number).option("compression", "zstd").parquet(parts)
    read = spark.read.schema(dealt.schema).parquet(parts)
    whole = [read.where(F.col(number) == i).drop(number).coalesce(1) for i in range(files)]
    with setting(spark, "spark.sql.unionOutputPartitioning", "false"):  # else a union of single partitions is a single partition
        reduce(DataFrame.unionAll, whole).write.mode("overwrite").parquet(path)
    remove(spark, parts)


def _interleaved(buckets: Sequence[Column], bits: int) -> Column:
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for position, bucket in enumerate(buckets):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out + F.shiftleft(one, bit * len(buckets) + position)
    return out


def cluster_by(df: DataFrame, columns: Sequence[str], files: int, bits: int = 8) -> DataFrame:
    """Rows ordered for file skipping: by range for one column, along a z-order curve for several.

    Curve positions come from approximate quantiles of each column (2**bits cut points, found by binary search), so
    buckets hold like numbers of rows. Runs one job for several columns. Numbers, dates and timestamps only.
    """
    if len(columns) == 1:
        return df.repartitionByRange(files, columns[0]).sortWithinPartitions(columns[0])
    size = 2**bits
    cuts = [i / size for i in range(1, size)]
    number = {c: _as_number(df, c) for c in columns}
    row = df.agg(*[F.percentile_approx(number[c], cuts, 10 * size).alias(c) for c in columns]).first()
    inputs, outputs = [f"_n{i}" for i in range(len(columns))], [f"_b{i}" for i in range(len(columns))]
    splits = [[-math.inf, *(sorted({float(x) for x in row[c] or []}) or [0.0]), math.inf] for c in columns]
    buckets = Bucketizer(inputCols=inputs, outputCols=outputs, splitsArray=splits, handleInvalid="keep")
    marked = buckets.transform(df.withColumns({n: number[c] for n, c in zip(inputs, columns)}))
    # A missing value goes to the first bucket.
    known = [F.when(F.col(n).isNull() | F.isnan(n), 0).otherwise(F.col(b)).cast("int") for n, b in zip(inputs, outputs)]
    placed = marked.withColumn("_z", _interleaved(known, bits)).drop(*inputs, *outputs)
    return placed.repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_timestamp(column).cast("double")
    return F.col(column).cast("double")


def table_stats(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows, files and bytes per table, from the metadata column of the scan."""
    out = None
    for name, path in paths.items():
        files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(
            F.count(F.lit(1)).alias("_rows"), F.max("_metadata.file_size").alias("_bytes")
        )
        stats = files.agg(
            F.lit(name).alias("tabela"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("registros"),
            F.count(F.lit(1)).alias("arquivos"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        )
        out = stats if out is None else out.unionByName(stats)
    return out
