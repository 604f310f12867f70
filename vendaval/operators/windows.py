"""Window functions, top-k, sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut_lineage


def _newest_first(columns: Sequence[str | Column]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in columns]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key, newest first. Plain names sort descending; give a total order for a fixed winner.

    ``row_number <= 1`` lets Spark cut each key to one candidate per task before the shuffle, so a key with very
    many rows does not meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= 1).drop("_rn")


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers over the whole set in ``order``, without a single-task sort. Runs one job.

    Rows are range-partitioned and sorted once, then written so that both later passes see the same partitions.
    A row's number is its position in its partition plus the rows of the partitions before; those offsets are one
    row per partition. ``order`` should be unique, or nearly so, for even ranges.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id holds the partition number above bit 33 and the row position below it.
    placed = placed.withColumns({
        "_part": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition: bounded by the number of shuffle partitions.
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_pos") + start)
    return numbered.select(name, *df.columns)


def moving_average(
    df: DataFrame, order: str, columns: Mapping[str, str], rows: int, digits: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """Trailing mean over ``rows`` rows, ``{output: column}``.

    For series with one row per calendar day, or series split by ``by``. Without ``by`` the series is sorted in one
    task, which a calendar bounds (a century is 36,525 rows); use ``moving_average_blocks`` for anything longer.
    """
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumns({n: _window_mean(c, window, digits) for n, c in columns.items()})


def _window_mean(column: str, window, digits: int) -> Column:
    value = S.exact(column)
    return F.round(F.try_divide(F.sum(value).over(window), F.count(value).over(window)), digits)


def moving_average_blocks(
    df: DataFrame, order: Sequence[str], columns: Mapping[str, str], rows: int, digits: int = 4, block: int = 100_000
) -> DataFrame:
    """The same trailing mean over a long series: rows get positions, then overlapping blocks of positions.

    The last ``rows - 1`` rows of a block are copied into the next one, so each block is averaged on its own. One
    task sorts one block. Runs one job, for the positions.
    """
    if rows > block:
        raise ValueError("block must hold at least one window")
    numbered = surrogate_key(df, order, "_p", start=0)
    own = F.floor(F.col("_p") / block)
    last = F.floor((F.col("_p") + rows - 1) / block)
    copies = numbered.withColumns({"_own": own, "_block": F.explode(F.sequence(own, last))})
    window = Window.partitionBy("_block").orderBy("_p").rowsBetween(1 - rows, 0)
    means = copies.withColumns({n: _window_mean(c, window, digits) for n, c in columns.items()})
    return means.where(F.col("_own") == F.col("_block")).drop("_p", "_own", "_block")


def share_of_total(
    counts: DataFrame, column: str, name: str = "pct", digits: int = 1, by: Sequence[str] = (), few: bool = False
) -> DataFrame:
    """Percent of ``column`` in its total over already grouped rows.

    The total is a scalar subquery, so the groups are not moved to one task whatever their number. ``few`` says that
    a fixed ladder names the groups (six segments, four tiers); the total is then a window over those few rows, which
    saves computing ``counts`` twice.
    """
    part = S.exact(column)
    if by or few:
        whole = F.sum(part).over(Window.partitionBy(*by))
    else:
        whole = counts.agg(F.sum(part)).scalar()
    share = F.try_divide(part * 100, whole.cast("decimal(22,6)"))
    return counts.withColumn(name, F.round(share, digits))


def group_share(
    df: DataFrame, by: Sequence[str], name: str = "total", digits: int = 1, few: bool = False
) -> DataFrame:
    return share_of_total(df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), name, digits=digits, few=few)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Global top rows: each task keeps ``k``, then the candidates are merged. End ``order`` with a unique key."""
    return df.orderBy(*order).limit(k)


def sort_by(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def sample_random_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in an order that depends only on key and seed, so a rerun picks the same rows.

    The order is that of the MD5 of seed and keys joined by bars, which other engines can repeat.
    """
    lottery = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))
    return df.orderBy(lottery, *keys).limit(n)


def sample_stratified(df: DataFrame, column: str, fractions: Mapping, seed: int = 42) -> DataFrame:
    return df.sampleBy(column, dict(fractions), seed)


def _unit_hash(keys: Sequence[str], seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(1_000_000)) / F.lit(1_000_000.0)


def train_test_split(
    df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, stratify: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: no shuffle, and a row stays on its side when data is added or a task is rerun.

    ``stratify`` gives every label the same share: its cut-off is the quantile of its own rows' hashes (to 1 in 10,000).
    The cut-offs then move when data is added.
    """
    position = _unit_hash(keys, seed)
    if not stratify:
        return df.where(position >= test_share), df.where(position < test_share)
    label = F.col(f"`{stratify}`")
    cuts = df.groupBy(label.alias("_label")).agg(F.percentile_approx(position, test_share, 10_000).alias("_cut"))
    placed = df.join(cuts, label.eqNullSafe(F.col("_label")))
    own = [F.col(f"`{c}`") for c in df.columns]
    return placed.where(position >= F.col("_cut")).select(*own), placed.where(position < F.col("_cut")).select(*own)
