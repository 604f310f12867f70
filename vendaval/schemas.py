"""Declared schemas. Pipelines never infer types."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "t": T.TimestampType(),
}


def _struct(spec: str, required: tuple[str, ...] = ()) -> T.StructType:
    """``"order_id:s price:d"`` to a StructType."""
    fields = (entry.split(":") for entry in spec.split())
    return T.StructType([T.StructField(name, _KINDS[kind], name not in required) for name, kind in fields])


LINEAGE = "_ingestao_ts:t _fonte:s _versao_ingestao:s"

ORDERS = _struct(
    "order_id:s customer_id:s order_status:s order_purchase_timestamp:t order_approved_at:t "
    "order_delivered_carrier_date:t order_delivered_customer_date:t order_estimated_delivery_date:t",
    ("order_id", "customer_id"),
)
CUSTOMERS = _struct(
    "customer_id:s customer_unique_id:s customer_zip_code_prefix:s customer_city:s customer_state:s"
)
ITEMS = _struct(
    "order_id:s order_item_id:i product_id:s seller_id:s shipping_limit_date:t price:d freight_value:d"
)
PAYMENTS = _struct("order_id:s payment_sequential:i payment_type:s payment_installments:i payment_value:d")
REVIEWS = _struct(
    "review_id:s order_id:s review_score:i review_comment_title:s review_comment_message:s "
    "review_creation_date:t review_answer_timestamp:t"
)
PRODUCTS = _struct(
    "product_id:s product_category_name:s product_name_lenght:i product_description_lenght:i "
    "product_photos_qty:i product_weight_g:i product_length_cm:i product_height_cm:i product_width_cm:i"
)
SELLERS = _struct("seller_id:s seller_zip_code_prefix:s seller_city:s seller_state:s")
GEOLOCATION = _struct(
    "geolocation_zip_code_prefix:s geolocation_lat:d geolocation_lng:d geolocation_city:s geolocation_state:s"
)
TRANSLATION = _struct("product_category_name:s product_category_name_english:s")

SOURCES = {
    "orders": ORDERS, "customers": CUSTOMERS, "items": ITEMS, "payments": PAYMENTS, "reviews": REVIEWS,
    "products": PRODUCTS, "sellers": SELLERS, "geolocation": GEOLOCATION, "category_translation": TRANSLATION,
}

# Embedded quotes in review text are doubled, so the escape is the quote itself.
CSV_OPTIONS = {"reviews": {"quote": '"', "escape": '"', "multiLine": "true"}}


def order_document(streaming: bool = False) -> T.StructType:
    """Nested order. The streaming form carries fewer item and review fields."""
    shipping = "" if streaming else "shipping_limit_date:s "
    review = (
        "review_id:s score:i comment_message:s" if streaming
        else "review_id:s score:i comment_title:s comment_message:s creation_date:s answer_timestamp:s"
    )
    parts = {
        "order_id": (T.StringType(), False),
        "order_status": (T.StringType(), True),
        "customer": (_struct("customer_id:s customer_unique_id:s zip_code_prefix:s city:s state:s"), True),
        "timestamps": (
            _struct("purchase:s approved:s delivered_carrier:s delivered_customer:s estimated_delivery:s"), True
        ),
        "items": (
            T.ArrayType(_struct(f"order_item_id:i product_id:s seller_id:s {shipping}price:d freight_value:d")), True
        ),
        "payments": (T.ArrayType(_struct("sequential:i type:s installments:i value:d")), True),
        "review": (_struct(review), True),
    }
    return T.StructType([T.StructField(n, kind, nullable) for n, (kind, nullable) in parts.items()])
