"""Change feeds into type-1 tables: the newest sequence per key wins.

Each micro-batch is cut to its newest row per key and lands in a folder named after the run and the batch. A batch that is
run again after a failure replaces its own folder; a run from a fresh checkpoint counts from 0 again and replaces none of
an earlier run. The table is the newest row per key over all folders, which makes it
independent of arrival order and leaves the cost of a batch proportional to the batch, not to the table. ``compact``
folds the folders into one base.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import dedupe_latest
from ..sources.streams import foreach_batch_sink


@dataclass(frozen=True)
class ChangeTable:
    """A keyed table fed by changes. ``path`` lies in storage all executors share."""

    path: str
    keys: Sequence[str]
    sequence: str

    def _newest(self, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in self.keys and c != self.sequence]
        return dedupe_latest(df, self.keys, [self.sequence, *rest])

    def apply(self, changes: DataFrame, batch_id: int, run: str = "direct") -> None:
        self._newest(changes).write.mode("overwrite").parquet(f"{self.path}/run={run}/batch={batch_id}")

    def current(self, spark: SparkSession) -> DataFrame:
        return self._newest(spark.read.option("mergeSchema", "true").parquet(self.path).drop("run", "batch"))

    def compact(self, spark: SparkSession, target: str) -> ChangeTable:
        """Write the current state as the base of a new table folder; the old folder stays for running readers."""
        base = ChangeTable(target, self.keys, self.sequence)
        self.current(spark).write.mode("error").parquet(f"{target}/run=base/batch=0")
        return base


def cdc_scd1(
    stream: DataFrame, table: ChangeTable, checkpoint: str, clean: Callable[[DataFrame], DataFrame] = lambda d: d
) -> StreamingQuery:
    """Feed a table from a stream of raw rows. ``clean`` is the same cleaning the batch layer uses.

    The run is the id that Spark keeps in the checkpoint: restarts share it, a new checkpoint has a new one.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        table.apply(batch, batch_id, run)

    return foreach_batch_sink(clean(stream), apply, checkpoint, "append")


ENTITY_KEYS = {
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
    "category_translation": ("product_category_name",),
}
