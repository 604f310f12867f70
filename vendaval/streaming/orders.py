"""Order stream: enrichment and windowed sales. Every function takes a batch frame as well as a streaming one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def stream_enrich(documents: DataFrame, ts: datetime | None = None, skip_null_payments: bool = False) -> DataFrame:
    """Flat order record with its total, item count, bad-review flag and partition day. Stateless."""
    total = S.array_total("payments", lambda p: p["value"], skip_nulls=skip_null_payments)
    bought = S.to_ts("timestamps.purchase")
    record = {
        "order_id": F.col("order_id"),
        "order_status": F.col("order_status"),
        "customer_unique_id": F.col("customer.customer_unique_id"),
        "customer_state": F.col("customer.state"),
        "customer_city": F.col("customer.city"),
        "purchase_ts": bought,
        "estimated_delivery_ts": S.to_ts("timestamps.estimated_delivery"),
        "total_order_value": total,
        "num_items": F.size("items"),
        "review_negativo": F.coalesce(F.col("review.score") <= 2, F.lit(False)),
        "review_score": F.col("review.score"),
        "purchase_date": F.to_date(bought),
    }
    if ts is not None:
        record["_ingestao_timestamp"] = F.lit(ts).cast("timestamp")
    return documents.select(*[c.alias(n) for n, c in record.items()])


def watermark(sdf: DataFrame, column: str = "purchase_ts", delay: str = "1 day") -> DataFrame:
    """Bound lateness. Timestamps without a zone are cast, which the watermark requires."""
    return sdf.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def _sales(exact_customers: bool) -> list:
    people = F.count_distinct("customer_unique_id") if exact_customers else F.approx_count_distinct("customer_unique_id")
    value = F.col("total_order_value")
    return [
        F.count("order_id").alias("total_pedidos"),
        F.sum(value).alias("gmv"),
        F.avg(value).alias("ticket_medio"),
        F.sum(F.col("review_negativo").cast("int")).alias("reviews_negativos"),
        people.alias("clientes_unicos"),
    ]


def gmv_by_state(records: DataFrame, width: str = "1 day", delay: str = "1 day", exact: bool | None = None) -> DataFrame:
    """Sales per tumbling window and state.

    A batch frame counts customers exactly unless ``exact=False`` asks for less; a stream can only count them
    approximately. For exact counts on a stream use
    ``customer_days`` and ``roll_up_customer_days``.
    """
    windowed = watermark(records, delay=delay).groupBy(F.window("purchase_ts", width), "customer_state")
    sales = windowed.agg(*_sales(not records.isStreaming if exact is None else exact))
    start = F.col("window.start")
    return sales.withColumns({"inicio": start, "data": start.cast("date")}).drop("window")


def daily_gmv_by_state(records: DataFrame, exact: bool | None = None) -> DataFrame:
    return gmv_by_state(records, "1 day", "1 day", exact).drop("inicio")


def hourly_gmv_by_state(records: DataFrame, exact: bool | None = None) -> DataFrame:
    return gmv_by_state(records, "1 hour", "10 minutes", exact)


def customer_days(records: DataFrame, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """First level of the exact count: one state row per window, state and customer, so no hot state piles up."""
    value = F.col("total_order_value")
    windowed = watermark(records, delay=delay).groupBy(
        F.window("purchase_ts", width), "customer_state", "customer_unique_id"
    )
    return windowed.agg(
        F.count("order_id").alias("pedidos"),
        F.sum(value).alias("valor"),
        F.count(value).alias("com_valor"),
        F.sum(F.col("review_negativo").cast("int")).alias("negativos"),
    ).select(F.col("window.start").alias("inicio"), *[
        "customer_state", "customer_unique_id", "pedidos", "valor", "com_valor", "negativos"
    ])


def roll_up_customer_days(rows: DataFrame) -> DataFrame:
    """Second level: the measures of ``gmv_by_state`` with an exact number of customers."""
    grouped = rows.groupBy("inicio", "customer_state").agg(
        F.sum("pedidos").alias("total_pedidos"),
        F.sum("valor").alias("gmv"),
        F.try_divide(F.sum("valor"), F.sum("com_valor")).alias("ticket_medio"),
        F.sum("negativos").alias("reviews_negativos"),
        F.count("customer_unique_id").alias("clientes_unicos"),
    )
    return grouped.withColumn("data", F.col("inicio").cast("date"))


def customer_sketches(records: DataFrame, width: str = "1 hour", delay: str = "1 day", lg_size: int = 12) -> DataFrame:
    """inicio, customer_state, pedidos and the sketch ``clientes`` of who bought: mergeable state of fixed size per window.

    Unlike a finished estimate, it rolls up to longer windows (``roll_up_sketches``). The estimate is within about 4 % in
    nearly all cases at the default size of 4 KB.
    """
    windowed = watermark(records, delay=delay).groupBy(F.window("purchase_ts", width), "customer_state")
    people = F.hll_sketch_agg("customer_unique_id", F.lit(lg_size))
    sketched = windowed.agg(F.count("order_id").alias("pedidos"), people.alias("clientes"))
    return sketched.select(F.col("window.start").alias("inicio"), "customer_state", "pedidos", "clientes")


def roll_up_sketches(sketches: DataFrame, unit: str = "day") -> DataFrame:
    """Stored sketches merged per calendar unit and state, in the same form, so that months come from days and days from hours."""
    return sketches.groupBy(F.date_trunc(unit, "inicio").alias("inicio"), "customer_state").agg(
        F.sum("pedidos").alias("pedidos"), F.hll_union_agg("clientes").alias("clientes")
    )


def unique_customers(sketches: DataFrame) -> DataFrame:
    """The estimate ``clientes_unicos`` in place of the sketch."""
    return sketches.withColumn("clientes_unicos", F.hll_sketch_estimate("clientes")).drop("clientes")


def stream_load_report(gmv: DataFrame, k: int = 10) -> DataFrame:
    """States by total sales."""
    totals = gmv.groupBy("customer_state").agg(
        F.sum("gmv").alias("gmv_total"), F.sum("total_pedidos").alias("pedidos")
    )
    return totals.orderBy(F.desc("gmv_total"), "customer_state").limit(k)


def monthly_load_report(records: DataFrame) -> DataFrame:
    """Volume, sales and mean ticket per purchase month."""
    month = F.date_trunc("month", "purchase_ts").alias("mes")
    value = F.col("total_order_value")
    report = records.groupBy(month).agg(
        F.count("order_id").alias("total_pedidos"), F.sum(value).alias("gmv"), F.avg(value).alias("ticket_medio")
    )
    return report.orderBy("mes")
