"""Column profiles and drift between two sets of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .windows import dedupe_latest


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form: one row per cell, (column_name, value as text, value as number where it is one)."""
    numeric = {"byte", "short", "integer", "long", "float", "double"}

    def number(c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        return F.col(c).cast("double") if kind in numeric or kind.startswith("decimal") else F.lit(None).cast("double")

    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), number(c).alias("number"))
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells)))


def profile(df: DataFrame, columns: Sequence[str], distinct: bool = True) -> DataFrame:
    """Rows, missing, distinct, minimum, maximum, mean, deviation and percent of zeros per column.

    All but the distinct counts come from one aggregation without a shuffle of values. ``distinct`` adds the exact number
    of values, column by column: each is reduced to its values first, so no task carries a column. Without it the field
    is null.
    """
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        numeric = kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds[c].startswith("decimal")
        return F.col(c).cast("double") if numeric else F.lit(None).cast("double")

    measures = {
        "num_rows": lambda c: F.count(F.lit(1)),
        "num_nulls": lambda c: F.count_if(F.col(c).isNull()),
        "min": lambda c: F.min(number(c)),
        "max": lambda c: F.max(number(c)),
        "mean": lambda c: F.avg(number(c)),
        "stddev": lambda c: F.stddev_samp(number(c)),
        "_zeros": lambda c: F.count_if(number(c) == 0),
    }
    wide = df.agg(*[f(c).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, f in measures.items()])
    entries = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{i}_{name}").alias(name) for name in measures]) for i, c in enumerate(columns)]
    long = wide.select(F.inline(F.array(*entries)))
    if distinct:
        values = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("num_distinct")) for c in columns]
        long = long.join(reduce(DataFrame.unionByName, values), "column_name")
    else:
        long = long.withColumn("num_distinct", F.lit(None).cast("bigint"))
    return long.withColumn("percent_zeros", S.percent(F.col("_zeros"), F.col("num_rows"), 4)).drop("_zeros")


def quantiles(df: DataFrame, columns: Sequence[str], at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Approximate quantiles per column. The sketches merge map-side, so no task holds a whole column."""
    sketch = F.percentile_approx("number", list(at), 10000)
    return melt(df, columns).groupBy("column_name").agg(sketch.alias("quantiles"))


def quantile_sketches(df: DataFrame, ts: str, columns: Sequence[str], width: str = "30 days", k: int = 400) -> DataFrame:
    """window_start, window_end, column_name and the KLL ``sketch`` of its numbers: a table to store, which merges over any windows.

    A sketch holds a few thousand numbers at most, whatever it has seen. A window without a number has an empty one.
    """
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(str(i)) for i, c in enumerate(columns)]
    wide = windows_of(df, ts, width).groupBy("window_start", "window_end").agg(*sketches)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(str(i)).alias("sketch")) for i, c in enumerate(columns)]
    return wide.select("window_start", "window_end", F.inline(F.array(*entries)))


def merged_quantiles(sketches: DataFrame, at: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """by, column_name, num_values, at, quantile: stored sketches merged, without a look at the rows. Empty ones give no row."""
    merged = sketches.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch").alias("_s"))
    filled = merged.withColumn("num_values", F.kll_sketch_get_n_double("_s")).where("num_values > 0")
    found = filled.withColumn("_q", F.when(F.col("num_values") > 0, F.kll_sketch_get_quantile_double("_s", F.array(*map(F.lit, at)))))
    pairs = F.arrays_zip(F.array(*map(F.lit, at)).alias("at"), F.col("_q").alias("quantile"))
    return found.select(*by, "column_name", "num_values", F.inline(pairs).alias("at", "quantile"))


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column; ties go to the smaller text."""
    counts = melt(df, columns).where("value IS NOT NULL").groupBy("column_name", "value")
    counted = counts.agg(F.count(F.lit(1)).alias("frequency"))
    return dedupe_latest(counted, ["column_name"], [F.desc("frequency"), F.asc("value")])


def _frequencies(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return melt(df, columns).where("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias(name)
    )


def drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str], floor: float = 1e-6) -> DataFrame:
    """Divergence of the value frequencies of each column: KL, Jensen-Shannon distance, chi-squared.

    Both sides are reduced to frequencies and meet in one union and one aggregation. A value missing on one side
    counts with share ``floor``. Bucket numeric columns first.
    """
    base = _frequencies(baseline, columns, "b").withColumn("c", F.lit(0).cast("bigint"))
    cur = _frequencies(current, columns, "c").withColumn("b", F.lit(0).cast("bigint"))
    pairs = base.unionByName(cur).groupBy("column_name", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    return _divergence(pairs, [], floor)


def drift_test(measures: DataFrame, level: float = 0.05) -> DataFrame:
    """``drift`` or ``drift_by_window`` with ``p_value`` of its chi-squared statistic and ``drifted``: the chance is below ``level``.

    A column with one value has no degree of freedom: its chance is null and it has not drifted.
    """
    tested = measures.withColumn("p_value", S.chi_squared_tail(F.col("chi_squared"), F.col("degrees")))
    return tested.withColumn("drifted", F.coalesce(F.col("p_value") < level, F.lit(False)))


def _divergence(pairs: DataFrame, by: Sequence[str], floor: float) -> DataFrame:
    """``pairs`` (by, column_name, value, b, c) to the measures of each column. Sides without any row give no row."""
    keys = [*by, "column_name"]
    totals = pairs.groupBy(*keys).agg(F.sum("b").alias("bt"), F.sum("c").alias("ct")).where("bt > 0 AND ct > 0")
    joined = pairs.join(totals, keys)
    p = F.greatest(F.col("c") / F.col("ct"), F.lit(floor))
    q = F.greatest(F.col("b") / F.col("bt"), F.lit(floor))
    shares = joined.select(*keys, "b", "c", "bt", "ct", p.alias("p"), q.alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    expected_b = (F.col("b") + F.col("c")) * F.col("bt") / (F.col("bt") + F.col("ct"))
    expected_c = (F.col("b") + F.col("c")) * F.col("ct") / (F.col("bt") + F.col("ct"))
    kl = F.col("p") * F.log(F.col("p") / F.col("q"))
    js = (F.col("p") * F.log(F.col("p") / m) + F.col("q") * F.log(F.col("q") / m)) / 2
    chi = F.pow(F.col("b") - expected_b, 2) / expected_b + F.pow(F.col("c") - expected_c, 2) / expected_c
    return shares.groupBy(*keys).agg(
        F.sum(kl).alias("kl_divergence"),
        F.sqrt(F.greatest(F.sum(js), F.lit(0.0))).alias("js_distance"),
        F.sum(chi).alias("chi_squared"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    )


def windows_of(df: DataFrame, ts: str, width: str) -> DataFrame:
    """All columns and the tumbling window of ``ts``: window_start, window_end. Rows without a time are left out."""
    marked = df.where(F.col(ts).isNotNull()).withColumn("_w", F.window(F.col(ts).cast("timestamp"), width))
    return marked.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


def profile_by_window(df: DataFrame, ts: str, columns: Sequence[str], width: str = "30 days") -> DataFrame:
    """Rows, missing, minimum, maximum, mean and deviation per time window and column, with the column's type.

    One aggregation with a map-side part; its groups are windows.
    """
    kinds = dict(df.dtypes)
    number = {c: F.lit(None).cast("double") if kinds[c] in ("string", "boolean", "date") or kinds[c].startswith("timestamp") else F.col(c).cast("double") for c in columns}
    measures = {
        "num_rows": lambda c: F.count(F.lit(1)), "num_nulls": lambda c: F.count_if(F.col(c).isNull()), "min": lambda c: F.min(number[c]),
        "max": lambda c: F.max(number[c]), "mean": lambda c: F.avg(number[c]), "stddev": lambda c: F.stddev_samp(number[c]),
    }
    wide = windows_of(df, ts, width).groupBy("window_start", "window_end").agg(
        *[f(c).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, f in measures.items()]
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), *[F.col(f"{i}_{name}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ]
    return wide.select("window_start", "window_end", F.inline(F.array(*entries)))


def drift_by_window(df: DataFrame, ts: str, columns: Sequence[str], width: str = "30 days", floor: float = 1e-6) -> DataFrame:
    """``drift`` of each time window against the one before it that has rows; drift_type says so.

    Frequencies are made once; each serves its own window and, shifted, the next. The first window has none before it.
    """
    marked = windows_of(df, ts, width)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = marked.select("window_start", "window_end", F.inline(F.array(*cells))).where("value IS NOT NULL")
    counts = counts.groupBy("window_start", "window_end", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # One row per window: as many as the calendar has.
    each = marked.select("window_start", "window_end").distinct()
    order = Window.orderBy("window_start")
    following = each.select("window_start", F.lead("window_start").over(order).alias("_s"), F.lead("window_end").over(order).alias("_e"))
    zero = F.lit(0).cast("bigint")
    own = counts.select("window_start", "window_end", "column_name", "value", zero.alias("b"), F.col("n").alias("c"))
    before = counts.join(following.where("_s IS NOT NULL"), "window_start").select(
        F.col("_s").alias("window_start"), F.col("_e").alias("window_end"), "column_name", "value", F.col("n").alias("b"), zero.alias("c")
    )
    keys = ["window_start", "window_end"]
    pairs = own.unionByName(before).groupBy(*keys, "column_name", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    return _divergence(pairs, keys, floor).withColumn("drift_type", F.lit("CONSECUTIVE"))
