"""Usage and cost reports over a usage table with a metadata struct, and dated prices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, ladders
from ..functions import scalars as S
from ..operators.joins import effective_dated_join
from ..operators.windows import share_of_total, top_k

SUM = "decimal(28,4)"


def since(usage: DataFrame, day: str) -> DataFrame:
    return usage.where(F.col("usage_date") >= F.lit(day).cast("date"))


def _total(name: str = "total_dbus") -> Column:
    return F.sum("usage_quantity").cast(SUM).alias(name)


def _first_last() -> list[Column]:
    return [F.min("usage_date").alias("primeiro_uso"), F.max("usage_date").alias("ultimo_uso")]


def usage_by_sku(usage: DataFrame) -> DataFrame:
    keys = ["sku_name", "billing_origin_product"]
    grouped = usage.groupBy(*keys).agg(
        _total(), F.count_distinct("usage_date").alias("dias_com_uso"), *_first_last()
    )
    return grouped.orderBy(F.desc("total_dbus"), *keys)


def _selected(rule: Mapping[str, Sequence[str]]) -> Column:
    sku, origin = F.lower("sku_name"), F.lower("billing_origin_product")
    wanted = ladders.like_any(sku, rule["sku"]) | ladders.like_any(origin, rule["origin"])
    return wanted & ~ladders.like_any(sku, rule["not_sku"])


# Grouping columns of each workload report; dotted names are fields of the metadata struct.
WORKLOAD_KEYS = {
    "dlt": ["sku_name", "usage_metadata.cluster_id", "usage_metadata.job_id"],
    "ml": ["sku_name", "billing_origin_product", "usage_metadata.cluster_id"],
    "notebook": ["sku_name", "usage_metadata.cluster_id"],
    "sql": ["sku_name", "usage_metadata.warehouse_id"],
}


def workload_usage(usage: DataFrame, workload: str) -> DataFrame:
    """Usage of one kind of workload, chosen by name fragments."""
    keys = WORKLOAD_KEYS[workload]
    names = [k.split(".")[-1] for k in keys]
    chosen = usage.where(_selected(fixed.USAGE_WORKLOADS[workload]))
    grouped = chosen.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        _total(), F.count(F.lit(1)).alias("registros_billing"), *_first_last()
    )
    return grouped.orderBy(F.desc("total_dbus"), *names)


def workload_series(usage: DataFrame, workload: str) -> DataFrame:
    chosen = usage.where(_selected(fixed.USAGE_SERIES[workload]))
    return chosen.groupBy("usage_date", "sku_name").agg(_total("dbus_dia")).orderBy("usage_date", "sku_name")


def _categorised(usage: DataFrame, name: str = "categoria_workload") -> DataFrame:
    return usage.withColumn(name, ladders.usage_category(F.col("sku_name")))


def usage_by_day_category(usage: DataFrame) -> DataFrame:
    keys = ["usage_date", "categoria_workload"]
    return _categorised(usage).groupBy(*keys).agg(_total("dbus_dia")).orderBy(*keys)


def category_totals(usage: DataFrame) -> DataFrame:
    grouped = _categorised(usage).groupBy("categoria_workload").agg(
        _total(), F.count_distinct("usage_date").alias("dias_com_uso")
    )
    shares = share_of_total(grouped, "total_dbus", "pct_total", few=True)
    return shares.orderBy(F.desc("total_dbus"), "categoria_workload")


def estimated_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost at the price of the day. Usage is summed per sku and day before it meets the prices."""
    daily = usage.groupBy("sku_name", "usage_date").agg(F.sum("usage_quantity").alias("usage_quantity"))
    flat = prices.select(
        "sku_name", F.col("pricing.default").alias("preco"), "price_start_time", "price_end_time"
    )
    priced = effective_dated_join(daily, flat, "sku_name", "usage_date", "price_start_time", "price_end_time")
    keyed = _categorised(priced, "categoria").groupBy("sku_name", "categoria", "preco").agg(_total())
    cost = F.round(F.col("total_dbus") * F.col("preco"), 2).cast("decimal(28,2)")
    return keyed.select(
        "sku_name", "categoria", "total_dbus", F.round("preco", 4).alias("preco_por_dbu"),
        cost.alias("custo_estimado_usd"),
    ).orderBy(F.desc_nulls_last("custo_estimado_usd"), "sku_name", "preco_por_dbu")


def event_listing(events: DataFrame, pattern: str, k: int = 30) -> DataFrame:
    """Newest events of the sources whose name matches."""
    return top_k(events.where(F.col("pipeline_name").like(pattern)), [F.desc("timestamp"), "event_id"], k)


def event_summary(events: DataFrame, pattern: str) -> DataFrame:
    keys = ["pipeline_name", "event_type", "level"]
    grouped = events.where(F.col("pipeline_name").like(pattern)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_eventos"), F.min("timestamp").alias("primeiro_evento"),
        F.max("timestamp").alias("ultimo_evento"),
    )
    return grouped.orderBy("pipeline_name", F.desc("total_eventos"), "event_type", "level")


def usage_overview(usage: DataFrame) -> DataFrame:
    """Total, days in use and daily mean."""
    row = usage.agg(_total(), F.count_distinct("usage_date").alias("dias_com_uso"))
    return row.withColumn("media_diaria", S.ratio(F.col("total_dbus"), F.col("dias_com_uso"), 2))


def category_summary(usage: DataFrame) -> DataFrame:
    grouped = _categorised(usage, "categoria").groupBy("categoria").agg(_total("total"))
    return share_of_total(grouped, "total", few=True).orderBy(F.desc("total"), "categoria")


def sku_summary(usage: DataFrame) -> DataFrame:
    return usage.groupBy("sku_name").agg(_total("total")).orderBy(F.desc("total"), "sku_name")


def active_resources(resources: DataFrame) -> DataFrame:
    """Resources that were not deleted, newest first."""
    return resources.where("delete_time IS NULL").drop("delete_time").orderBy(F.desc("create_time"), "cluster_id")
