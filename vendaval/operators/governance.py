"""Personal-data scan and classification, row and column access, masking."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import scalars as S


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """The pattern, behind a plain search for the character every match holds, which is cheap on long texts."""
    sign = fixed.PII_VALUE_SIGNS.get(kind)
    return F.when(text.contains(sign), text.rlike(pattern)) if sign else text.rlike(pattern)


def pii_scan_values(
    df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Per text column and category: rows, rows whose text matches, hit rate in percent. Whole texts, one scan."""
    rules = patterns or fixed.PII_VALUE_PATTERNS
    hits = {
        (c, kind): S.count_where(_matches(F.col(c).cast("string"), kind, pattern)).alias(f"{c}__{kind}")
        for c in columns
        for kind, pattern in rules.items()
    }
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *hits.values())
    entries = [
        F.struct(
            F.lit(c).alias("coluna"), F.lit(kind).alias("categoria"), F.col("_rows").alias("total_rows"),
            F.col(f"{c}__{kind}").alias("hits"),
        )
        for c, kind in hits
    ]
    return wide.select(F.inline(F.array(*entries))).withColumn(
        "hit_rate", S.percent(F.col("hits"), F.col("total_rows"), 4)
    )


def pii_scan_names(df: DataFrame) -> DataFrame:
    """Columns whose names suggest personal data, next to the rows that carry a value."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("present")) for c in df.columns]
    rules = [F.struct(F.lit(k).alias("categoria"), F.lit(p).alias("pattern")) for k, p in fixed.PII_NAME_PATTERNS.items()]
    named = counts.select(F.inline(F.array(*cells))).select("coluna", "present", F.inline(F.array(*rules)))
    return named.where(F.rlike(F.lower("coluna"), F.col("pattern"))).drop("pattern")


def pii_classify(scan: DataFrame, least_rate: float = 0.0) -> DataFrame:
    """Data-protection class and action for every category with a hit rate above ``least_rate``."""
    classes: dict[str, list[str]] = {}
    for category, kind in fixed.PII_CLASSES.items():
        classes.setdefault(kind, []).append(category)
    kind = F.coalesce(*[F.when(F.col("categoria").isin(c), F.lit(k)) for k, c in classes.items()])
    masked = F.col("categoria").isin(fixed.PII_MASKED)
    found = scan.where(F.col("hit_rate") > least_rate) if "hit_rate" in scan.columns else scan
    return found.withColumns({
        "tipo_pii": kind, "acao_recomendada": F.when(masked, "MASKING").otherwise("REVIEW"),
    })


def column_view(
    df: DataFrame, table: str, role: str, hidden: Mapping[str, Mapping[str, Sequence[str]]] | None = None
) -> DataFrame:
    """What a role may select: all columns but the ones hidden from it in this table (``layer.name``).

    Fails closed: a role that is neither restricted nor in UNRESTRICTED_ROLES is an error, and so is a hidden column
    that the table does not have, since its content may stand under another name.
    """
    policy = hidden or {"analista_jr": fixed.JUNIOR_HIDDEN}
    if role in fixed.UNRESTRICTED_ROLES and role not in policy:
        return df
    if role not in policy:
        raise ValueError(f"no column policy for role {role}")
    names = policy[role].get(table, [])
    if missing := set(names) - set(df.columns):
        raise ValueError(f"columns to hide from {role} are not in {table}: {sorted(missing)}")
    return df.drop(*names)


def row_filter(
    df: DataFrame, column: str, user_groups: Collection[str], regional: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Members of regional groups see the rows of all their groups' states; everyone else sees all rows.

    The test is one literal IN list, so it reaches the parquet scan.
    """
    rules = regional or fixed.REGIONAL_GROUPS
    mine = [rules[group] for group in user_groups if group in rules]
    return df.where(F.col(column).isin(sorted({value for values in mine for value in values}))) if mine else df


def sql_row_filters(
    spark: SparkSession,
    user_groups: Collection[str],
    functions: Mapping[str, str] | None = None,
    regional: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Register a boolean SQL function of a state per ``{function: group}`` for the session; returns their names.

    For a member of the group it is true for the group's states, for everyone else always. The optimizer puts its body in
    place of the call, so the test reaches the parquet scan as if it were written out.
    """
    rules = regional or fixed.REGIONAL_GROUPS
    functions = fixed.ROW_FILTER_FUNCTIONS if functions is None else functions
    for name, group in functions.items():
        states = ", ".join("'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'" for s in rules[group])
        body = f"state IN ({states})" if group in user_groups else "TRUE"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`(state STRING) RETURNS BOOLEAN RETURN {body}")
    return list(functions)


def row_filter_by_grant(df: DataFrame, column: str, grants: DataFrame, user: str) -> DataFrame:
    """Row access from an entitlement table (user, value): a semi join on the granted values."""
    mine = grants.where(F.col("user") == user).select(F.col("value").alias(column))
    return df.join(mine, column, "left_semi")


def redact(text: Column, patterns: Mapping[str, str] | None = None) -> Column:
    for kind, pattern in (patterns or fixed.PII_VALUE_PATTERNS).items():
        text = F.regexp_replace(text, pattern, f"<{kind}>")
    return text


def mask_columns(df: DataFrame, policy: Mapping[str, str], round_digits: int = 1) -> DataFrame:
    """``{column: "redact" | "round" | "hash" | "null"}``."""
    actions = {
        "redact": lambda c: redact(F.col(c)),
        "round": lambda c: F.round(F.col(c), round_digits),
        "hash": lambda c: F.sha2(F.col(c).cast("string"), 256),
        "null": lambda c: F.lit(None).cast(df.schema[c].dataType),
    }
    return df.withColumns({c: actions[action](c) for c, action in policy.items()})


def region_access_report(orders: DataFrame, group: str = "Regiao_Norte") -> DataFrame:
    """Rows an unrestricted user sees against rows a member of the regional group sees, in one scan."""
    inside = F.col("customer_state").isin(list(fixed.REGIONAL_GROUPS[group]))
    counts = orders.agg(F.count(F.lit(1)).alias("total_admin"), S.count_where(inside).alias("total_regiao"))
    return counts.withColumns({
        "bloqueados": F.col("total_admin") - F.col("total_regiao"),
        "pct_visivel": S.percent(F.col("total_regiao"), F.col("total_admin"), 2),
    })


def region_state_report(orders: DataFrame, group: str = "Regiao_Norte") -> DataFrame:
    """Orders, mean ticket and mean delivery days per state, as a member of the group sees them."""
    seen = row_filter(orders, "customer_state", [group])
    days = S.ratio(F.sum("tempo_total_seg"), F.count("tempo_total_seg") * 86400, 1)
    report = seen.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        S.mean_of("total_pago", 2).alias("ticket_medio"),
        days.alias("tempo_medio_entrega_dias"),
    )
    return report.orderBy(F.desc("total_pedidos"), "customer_state")
