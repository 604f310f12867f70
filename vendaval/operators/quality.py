"""Quality rules and checks.

A rule is a name and a SQL predicate. A row passes when the predicate is true; NULL is a violation, so a rule that
wants to keep missing values says so itself.

Violations are counted by an ``Observation`` while the rows flow, at no extra scan. Spark 4.1 cannot train a
logistic regression in a session that has used an observation (the session then holds an object that tasks cannot
carry), so a job that does both should observe in ``spark.newSession()``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as S

Rules = Mapping[str, str]


@dataclass(frozen=True)
class RuleSet:
    """Rules of one table: rows to drop, conditions to fail on, conditions to count only."""

    drop: Rules = field(default_factory=dict)
    fail: Rules = field(default_factory=dict)
    warn: Rules = field(default_factory=dict)

    def all(self) -> dict[str, str]:
        return {**self.drop, **self.fail, **self.warn}


def _ok(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _observed(df: DataFrame, rules: Rules, watch: Observation | None) -> DataFrame:
    if watch is None or not rules:
        return df
    counts = [S.count_where(~_ok(p)).alias(name) for name, p in rules.items()]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts)


def expect_or_drop(df: DataFrame, rules: Rules, watch: Observation | None = None) -> DataFrame:
    """Keep the rows that pass every rule. ``watch`` receives the violations per rule as the rows flow by."""
    kept = _observed(df, rules, watch)
    for predicate in rules.values():
        kept = kept.where(_ok(predicate))
    return kept


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """The query itself fails, inside the task, on the first row that breaks a rule.

    The message names the rule and shows the first columns of the row. Because it reads more than the key, the
    optimizer cannot copy the guard to the other side of an equality join, where it would fail on rows that never
    take part.
    """
    shown = F.concat_ws(", ", *[F.col(f"`{c}`").cast("string") for c in df.columns[:3]])
    for name, predicate in rules.items():
        stop = F.raise_error(F.concat(F.lit(f"expectation failed: {name}: "), shown)).cast("boolean")
        df = df.where(F.when(_ok(predicate), F.lit(True)).otherwise(stop))
    return df


def expect_warn(df: DataFrame, rules: Rules, watch: Observation) -> DataFrame:
    """All rows stay; ``watch`` receives the violations per rule."""
    return _observed(df, rules, watch)


def apply_rules(df: DataFrame, rules: RuleSet, watch: Observation | None = None) -> DataFrame:
    """Count drop and warn violations in one pass, then drop, then guard the rest."""
    seen = _observed(df, {**rules.drop, **rules.warn}, watch)
    return expect_or_fail(expect_or_drop(seen, rules.drop), rules.fail)


def violation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows, violations, pass rate. One scan."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[S.count_where(~_ok(p)).alias(f"v_{i}") for i, p in enumerate(rules.values())],
    )
    return _stacked(wide, {name: F.col(f"v_{i}") for i, name in enumerate(rules)}, "rule", "violations").withColumn(
        "pass_rate", S.percent(F.col("total_rows") - F.col("violations"), F.col("total_rows"), 4)
    )


def _stacked(wide: DataFrame, values: Mapping[str, Column], key: str, value: str) -> DataFrame:
    """One wide row of counts to one row per entry, next to the total row count."""
    entries = [
        F.struct(F.lit(n).alias(key), F.col("_rows").alias("total_rows"), v.alias(value)) for n, v in values.items()
    ]
    return wide.select(F.inline(F.array(*entries)))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, all columns in one scan."""
    names = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(names)]
    )
    report = _stacked(wide, {c: F.col(f"n_{i}") for i, c in enumerate(names)}, "column_name", "nulls")
    return report.withColumn("null_pct", S.percent(F.col("nulls"), F.col("total_rows"), 2))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; an empty table is marked."""
    counted = [df.agg(F.lit(n).alias("tabela"), F.count(F.lit(1)).alias("registros")) for n, df in tables.items()]
    return _union(counted).withColumn("status", F.when(F.col("registros") > 0, "OK").otherwise("VAZIA"))


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Source against destination: rows on both sides and whether they match."""
    sides = []
    for name, (source, target) in pairs.items():
        left = source.agg(F.count(F.lit(1)).alias("origem"), F.lit(0).cast("bigint").alias("destino"))
        right = target.agg(F.lit(0).cast("bigint").alias("origem"), F.count(F.lit(1)).alias("destino"))
        both = left.unionByName(right).agg(F.sum("origem").alias("origem"), F.sum("destino").alias("destino"))
        sides.append(both.withColumn("tabela", F.lit(name)))
    return _union(sides).withColumn("status", _match("origem", "destino"))


def _match(first: str, second: str) -> Column:
    return F.when(F.col(first) == F.col(second), "OK").otherwise("DIVERGENTE")


def referential_check(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Distinct keys on both sides and keys found on one side only, from one pass over both.

    ``status`` is OK if every key of the child has its parent; ``same_count`` only compares the numbers. Each side is reduced to its distinct keys before they meet.
    """
    left = parent.select(key).distinct().withColumns({"_p": F.lit(1), "_c": F.lit(0)})
    right = child.select(key).distinct().withColumns({"_p": F.lit(0), "_c": F.lit(1)})
    keys = left.unionByName(right).groupBy(key).agg(F.max("_p").alias("p"), F.max("_c").alias("c"))
    keys = keys.where(F.col(key).isNotNull())
    return keys.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("parent_keys"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("child_keys"),
        F.count_if(F.col("p") > F.col("c")).alias("only_parent"),
        F.count_if(F.col("c") > F.col("p")).alias("only_child"),
    ).withColumns({
        "same_count": F.col("parent_keys") == F.col("child_keys"),
        "status": F.when(F.col("only_child") == 0, "OK").otherwise("DIVERGENTE"),
    })


def pk_null_check(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Missing keys per table."""
    checks = [
        df.agg(F.lit(n).alias("tabela"), F.lit(key).alias("pk"), F.count_if(F.col(key).isNull()).alias("nulos"))
        for n, (df, key) in tables.items()
    ]
    return _union(checks).withColumn("status", F.when(F.col("nulos") == 0, "OK").otherwise("FALHA"))


def not_null_test(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.lit(f"not_null:{column}").alias("test"), F.count_if(F.col(column).isNull()).alias("failures"))


def unique_test(df: DataFrame, column: str) -> DataFrame:
    """Failures are values that occur more than once."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return repeated.agg(F.lit(f"unique:{column}").alias("test"), F.count_if(F.col("_n") > 1).alias("failures"))


def accepted_values_test(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Failures are distinct values outside the list; NULL is not tested."""
    odd = df.where(~F.col(column).isin(list(values))).select(column).distinct()
    return odd.agg(F.lit(f"accepted_values:{column}").alias("test"), F.count(F.lit(1)).alias("failures"))


def column_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """All declared tests of a table as rows (test, failures): one pass for the not-null tests, one for each unique
    column, one for the accepted values of all columns."""
    parts, accepted = [], accepted or {}
    if not_null:
        missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        parts.append(missing.select(F.inline(F.array(*[
            F.struct(F.lit(f"not_null:{c}").alias("test"), F.col(c).alias("failures")) for c in not_null
        ]))))
    parts += [unique_test(df, c) for c in unique]
    if accepted:
        odd = [
            F.struct(F.lit(c).alias("c"), F.when(~F.col(c).isin(list(v)), F.col(c).cast("string")).alias("value"))
            for c, v in accepted.items()
        ]
        values = df.select(F.inline(F.array(*odd))).where(F.col("value").isNotNull()).distinct().groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        named = df.sparkSession.createDataFrame([(c,) for c in accepted], "c string").join(values, "c", "left")
        parts.append(named.select(F.concat(F.lit("accepted_values:"), "c").alias("test"), F.coalesce("n", F.lit(0)).alias("failures")))
    return _union(parts)


def quality_gate(checks: DataFrame, failed: Column, label: str) -> DataFrame:
    """One row: overall status, checks run, checks failed, and the names of the failed ones in order.

    ``checks`` holds one row per declared check, so the list of names is as short as the declaration.
    """
    names = F.array_join(F.sort_array(F.collect_list(F.when(failed, F.col(label)))), ",")
    row = checks.agg(
        F.count(F.lit(1)).alias("total_checks"), S.count_where(failed).alias("failed"), names.alias("details")
    )
    return row.withColumn("status", F.when(F.col("failed") == 0, "OK").otherwise("FALHA"))


def recompute_check(df: DataFrame, stored: str, expected: Column) -> DataFrame:
    """Rows whose stored value equals its recomputation; two missing values agree."""
    same = F.col(stored).eqNullSafe(expected)
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(same).alias("corretos"), F.count_if(~same).alias("divergentes")
    )
