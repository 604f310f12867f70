"""Raw layer: nested orders to order lines, cleaning, daily batch ingest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ladders
from ..functions import scalars as S
from ..operators import aggregates, joins, rows
from ..operators.windows import dedupe_latest


def delivery_metrics(df: DataFrame, delivered: str, promised: str, purchased: str, day: str) -> DataFrame:
    """Days against the promise, an on-time flag (False while undelivered) and the partition day."""
    delay = S.delay_days(delivered, promised)
    return df.withColumns({
        "delta_entrega_dias": delay,
        "entregue_no_prazo": F.coalesce(delay <= 0, F.lit(False)),
        day: F.to_date(purchased),
    })


TOTALS = ["total_order_value", "payment_types", "max_installments", "num_payment_methods"]


def order_lines(
    documents: DataFrame, ts: datetime | Column | None = None, source: str | None = None, repeated: bool = False
) -> DataFrame:
    """One row per order and item, with payment totals, review and delivery figures.

    Totals come from the payments inside each document, so the whole step is narrow. ``repeated`` is for feeds that
    hold an order in several documents: totals are then summed per order and joined back.
    """
    if repeated:
        totals = aggregates.order_payment_totals(rows.explode_payments(documents))
        flat = rows.flatten_order(documents, keep=["items", "review"])
        lines = joins.join_order_totals(rows.explode_items(flat), totals)
    else:
        held = aggregates.with_document_totals(documents)
        lines = rows.explode_items(rows.flatten_order(held, keep=["items", *TOTALS, "review"]))
    lines = rows.extract_review(lines)
    out = delivery_metrics(lines, "delivered_customer_ts", "estimated_delivery_ts", "purchase_ts", "purchase_date")
    if ts is None:
        return out
    stamp = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    return out.withColumns({"_ingestao_timestamp": stamp, "_notebook": F.lit(source).cast("string")})


def clean_order_lines(
    lines: DataFrame, keys: Sequence[str] = ("order_id", "order_item_id"), order: Sequence[str | Column] = ()
) -> DataFrame:
    """Required ids, known statuses, one row per key, no negative money, scores within 1 to 5, delay scale.

    The default key keeps two lines of one product; ``("order_id", "product_id")`` keeps one of them. The winner is
    the newest ingest, then the remaining columns, so it does not depend on row order.
    """
    present = rows.require_not_null(lines, ["order_id", "customer_id"])
    known = rows.normalise_domain(present, "order_status")
    unique = dedupe_latest(known, keys, list(order) or _tie_break(known, keys))
    priced = rows.non_negative_or_null(unique, ["price", "freight_value", "total_order_value"])
    scored = rows.null_if_outside(priced, "review_score", 1, 5)
    return scored.withColumn("status_entrega", ladders.delay_scale(F.col("delta_entrega_dias")))


def _tie_break(df: DataFrame, keys: Sequence[str]) -> list[str]:
    stamp = [c for c in ("_ingestao_timestamp", "_ingestao_ts") if c in df.columns]
    sortable = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    return stamp + [c for c in sortable if c not in keys and c not in stamp]


def clean_customers(customers: DataFrame) -> DataFrame:
    shaped = rows.require_not_null(customers, ["customer_id"]).withColumns({
        "customer_state": S.clean_upper("customer_state"),
        "customer_city": S.clean_lower("customer_city"),
        "customer_zip_code_prefix": S.pad_zip("customer_zip_code_prefix"),
    })
    return dedupe_latest(shaped, ["customer_id"], _tie_break(shaped, ["customer_id"]))


MEASURES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def clean_products(products: DataFrame, fill: str = "zero") -> DataFrame:
    """Category in lower case with a flag for a missing one; missing sizes become 0, or the category median."""
    shaped = rows.require_not_null(products, ["product_id"])
    shaped = shaped.withColumn("product_category_name", S.clean_lower("product_category_name"))
    if fill == "median":
        shaped = rows.fill_with_group_median(shaped, MEASURES, "product_category_name")
    else:
        shaped = rows.fill_nulls(shaped, dict.fromkeys(MEASURES, 0))
    return rows.flag_null(shaped, "product_category_name", "sem_categoria")


def ingest_orders(orders: DataFrame, ts: datetime | Column, source: Column | None = None) -> DataFrame:
    """Daily batch: lineage columns, partition day and delay. Write with ``files.write_partitioned``."""
    stamp = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    return orders.withColumns({
        "order_purchase_date": F.to_date("order_purchase_timestamp"),
        "delta_entrega_dias": S.delay_days("order_delivered_customer_date", "order_estimated_delivery_date"),
        "_ingestao_timestamp": stamp,
        "_source_file": F.input_file_name() if source is None else source,
    })
