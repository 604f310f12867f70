"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import scalars as S

# Target column -> path in the order document.
_HEAD = {
    "order_id": "order_id",
    "order_status": "order_status",
    "customer_id": "customer.customer_id",
    "customer_unique_id": "customer.customer_unique_id",
    "customer_zip": "customer.zip_code_prefix",
    "customer_city": "customer.city",
    "customer_state": "customer.state",
}
_TIMES = {
    "purchase_ts": "purchase",
    "approved_ts": "approved",
    "delivered_carrier_ts": "delivered_carrier",
    "delivered_customer_ts": "delivered_customer",
    "estimated_delivery_ts": "estimated_delivery",
}
_ITEM = ["order_item_id", "product_id", "seller_id", "price", "freight_value"]
_PAYMENT = {
    "payment_sequential": "sequential",
    "payment_type": "type",
    "payment_installments": "installments",
    "payment_value": "value",
}


def flatten_order(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Customer and timestamp fields as columns; ``keep`` names nested columns to carry along."""
    head = [F.col(path).alias(name) for name, path in _HEAD.items()]
    times = [S.to_ts(F.col(f"timestamps.{field}")).alias(name) for name, field in _TIMES.items()]
    return documents.select(*head, *times, *keep)


def explode_items(df: DataFrame) -> DataFrame:
    """One row per element of ``items``; an order without items stays as one row of NULLs."""
    rest = [c for c in df.columns if c != "items"]
    lines = df.select(*rest, F.explode_outer("items").alias("_item"))
    return lines.select(*rest, *[F.col(f"_item.{name}").alias(name) for name in _ITEM])


def explode_payments(documents: DataFrame) -> DataFrame:
    lines = documents.select("order_id", F.explode_outer("payments").alias("_payment"))
    return lines.select("order_id", *[F.col(f"_payment.{field}").alias(n) for n, field in _PAYMENT.items()])


def extract_review(df: DataFrame) -> DataFrame:
    """Score, comment and date out of the ``review`` struct, which is dropped."""
    return df.withColumns({
        "review_score": F.col("review.score"),
        "review_comment": F.col("review.comment_message"),
        "review_creation_date": S.to_ts("review.creation_date"),
    }).drop("review")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def non_negative_or_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a negative value in any of the columns."""
    for name in columns:
        df = df.where(F.coalesce(F.col(name), F.lit(0)) >= 0)
    return df


def null_if_outside(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).between(low, high), F.col(column)))


def normalise_domain(
    df: DataFrame, column: str, allowed: Sequence[str] = tuple(fixed.ORDER_STATUSES), default: str = "unknown"
) -> DataFrame:
    known = F.col(column).isin(list(allowed))
    return df.withColumn(column, F.when(known, F.col(column)).otherwise(default))


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).like(pattern))


def filter_starts_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def filter_between(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def filter_text_min_len(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose trimmed text is longer than ``n`` characters."""
    return df.where(S.longer_than(column, n))


# Columns each staging view exposes.
STAGING = {
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        "delta_entrega_dias", "status_entrega",
    ],
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code", "customer_city", "customer_state",
    ],
    "items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        "total_item_value",
    ],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "products": [
        "product_id", "product_category", "product_name_length", "product_description_length",
        "product_photos_qty", "product_weight_kg", "product_length_cm", "product_height_cm", "product_width_cm",
        "product_volume_cm3", "porte_produto",
    ],
    "reviews": [
        "review_id", "order_id", "review_score", "review_title", "review_message", "review_creation_date",
        "review_answer_timestamp", "tempo_resposta_seg", "review_sentiment", "has_comment",
    ],
    "sellers": ["seller_id", "seller_zip_code", "seller_city", "seller_state"],
}


def select_staging(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*STAGING[entity])


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fill_with_group_median(df: DataFrame, columns: Sequence[str], group: str, accuracy: int = 10000) -> DataFrame:
    """Replace NULLs by the median of the row's group. The medians are sketches, merged map-side."""
    medians = df.groupBy(F.col(group).alias("_g")).agg(
        *[F.percentile_approx(c, 0.5, accuracy).alias(f"_m_{c}") for c in columns]
    )
    joined = df.join(medians, F.col(group).eqNullSafe(F.col("_g")), "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in columns})
    return filled.select(*df.columns)


def flag_null(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(column).isNull())


def exclude_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def type_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: name, type, and how many values are present."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    kinds = {c: df.schema[c].dataType.simpleString() for c in names}
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), F.col(c).alias("present"))
        for c in names
    ]
    return counts.select(F.inline(F.array(*entries)))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(first, *others).distinct()


def union_all(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=allow_missing)
    return first
