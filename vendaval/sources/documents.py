"""Nested order documents: build, read, split by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_nested_json(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return spark.read.schema(schemas.order_document(streaming)).json(path)


def _renamed(columns: dict[str, str], kinds: dict[str, str] | None = None) -> list[Column]:
    kinds = kinds or {}
    return [F.col(old).cast(kinds.get(new, "string")).alias(new) for old, new in columns.items()]


def assemble_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One document per order: customer, timestamps, items[], payments[] and the earliest review.

    Every child is reduced to one row per order before the join, all on the order key, so each input is shuffled
    once. Arrays are sorted; a child that is absent gives an empty array and a NULL review.
    """
    item = F.struct(*_renamed(
        {"order_item_id": "order_item_id", "product_id": "product_id", "seller_id": "seller_id",
         "shipping_limit_date": "shipping_limit_date", "price": "price", "freight_value": "freight_value"},
        {"order_item_id": "int", "price": "double", "freight_value": "double"},
    ))
    payment = F.struct(*_renamed(
        {"payment_sequential": "sequential", "payment_type": "type", "payment_installments": "installments",
         "payment_value": "value"},
        {"sequential": "int", "installments": "int", "value": "double"},
    ))
    review = F.struct(*_renamed(
        {"review_id": "review_id", "review_score": "score", "review_comment_title": "comment_title",
         "review_comment_message": "comment_message", "review_creation_date": "creation_date",
         "review_answer_timestamp": "answer_timestamp"},
        {"score": "int"},
    ))
    item_lists = items.groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    payment_lists = payments.groupBy("order_id").agg(F.sort_array(F.collect_list(payment)).alias("payments"))
    first_review = reviews.groupBy("order_id").agg(
        F.min_by(review, F.struct("review_creation_date", "review_id")).alias("review")
    )
    customer = F.struct(*_renamed({
        "customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
        "customer_zip_code_prefix": "zip_code_prefix", "customer_city": "city", "customer_state": "state",
    }))
    timestamps = F.struct(*_renamed({
        "order_purchase_timestamp": "purchase", "order_approved_at": "approved",
        "order_delivered_carrier_date": "delivered_carrier", "order_delivered_customer_date": "delivered_customer",
        "order_estimated_delivery_date": "estimated_delivery",
    }))
    empty = schemas.order_document()
    return (
        orders.join(customers, "customer_id", "left")
        .join(item_lists, "order_id", "left")
        .join(payment_lists, "order_id", "left")
        .join(first_review, "order_id", "left")
        .select(
            "order_id",
            "order_status",
            customer.alias("customer"),
            timestamps.alias("timestamps"),
            F.coalesce("items", F.array().cast(empty["items"].dataType)).alias("items"),
            F.coalesce("payments", F.array().cast(empty["payments"].dataType)).alias("payments"),
            "review",
        )
    )


def write_json(documents: DataFrame, path: str) -> None:
    """JSON lines, compressed: names and times repeat in every document, and readers take the codec from the file name."""
    documents.write.json(path, compression="gzip")


def write_daily_json(documents: DataFrame, path: str) -> None:
    """One folder of compressed JSON lines per purchase day, the arrival pattern a stream picks up."""
    day = F.to_date(F.col("timestamps.purchase"))
    dated = documents.withColumn("purchase_date", day).hint("rebalance", "purchase_date")
    dated.write.mode("overwrite").partitionBy("purchase_date").json(path, compression="gzip")
