"""Rows numbered in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of the order in one task, on average.
TASK_ROWS = 250_000


def marked(df: DataFrame, keys: Sequence[str], mark: str = "mark", label: str = "ordered") -> DataFrame:
    """The rows of ``df``, written once in the order of ``keys``, with a long that grows along it.

    ``keys`` should end with a column that no two rows share, so that a frequent key spreads over tasks. Runs two jobs.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-df.count() // TASK_ROWS))
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return cut_lineage(ordered.withColumn(mark, F.monotonically_increasing_id()), label)


def positions(df: DataFrame, group: str, keys: Sequence[str], label: str = "ordered") -> DataFrame:
    """All columns of ``df`` and ``position``: the row's place in its group, from 0, in the order of ``keys``.

    ``df`` has no column ``mark`` or ``part``. Groups are not null. Every task numbers its own rows; the rows before it are
    added up from one count for each task and group.
    """
    rows = marked(df, [group, *keys], label=label).withColumn("part", F.shiftright("mark", 33))
    counts = rows.groupBy(group, "part").agg(F.min("mark").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(  # written, so that the size by which the join is chosen is known
        counts.select(group, "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start")), "starts"
    )
    return rows.join(starts, [group, "part"]).withColumn("position", F.col("mark") - F.col("start")).drop("mark", "part", "start")
