"""Clean layer: eleven tables with their quality rules. Each function works on batch and streaming frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ladders
from ..functions import scalars as S
from ..operators import aggregates, joins
from ..operators.quality import RuleSet

# Declared tests per clean table (not null, unique, accepted values).
TESTS = {
    "orders": (["order_id", "customer_id"], ["order_id"], {}),
    "customers": (["customer_id"], ["customer_id"], {}),
    "products": (["product_id"], ["product_id"], {}),
    "sellers": (["seller_id"], ["seller_id"], {}),
    "reviews": (["review_id", "order_id"], [], {}),
    "items": (["order_id", "product_id", "seller_id"], [], {}),
}

# Rule names and predicates per table.
RULES = {
    "orders": RuleSet(
        drop={"order_id_not_null": "order_id IS NOT NULL", "customer_id_not_null": "customer_id IS NOT NULL"},
        warn={"Entrega_Atraso_Alerta": "delta_entrega_dias <= 30 OR delta_entrega_dias IS NULL"},
    ),
    "customers": RuleSet(drop={"customer_id_not_null": "customer_id IS NOT NULL"}),
    "items": RuleSet(
        drop={"order_id_not_null": "order_id IS NOT NULL", "product_id_not_null": "product_id IS NOT NULL"},
        warn={"Preco_Alerta_Alto": "price < 10000"},
    ),
    "payments": RuleSet(
        drop={
            "order_id_not_null": "order_id IS NOT NULL",
            "Valor_Pagamento_Valido": "payment_value BETWEEN 0.01 AND 99999.99",
        },
    ),
    "reviews": RuleSet(
        drop={"review_id_not_null": "review_id IS NOT NULL", "order_id_not_null": "order_id IS NOT NULL"},
        warn={"Score_Range_Valido": "review_score BETWEEN 1 AND 5"},
    ),
    "products": RuleSet(drop={"product_id_not_null": "product_id IS NOT NULL"}),
    "sellers": RuleSet(drop={"seller_id_not_null": "seller_id IS NOT NULL"}),
    "geolocation": RuleSet(drop={"zip_code_not_null": "geolocation_zip_code_prefix IS NOT NULL"}),
    "category_translation": RuleSet(
        drop={
            "category_pt_not_null": "product_category_name IS NOT NULL",
            "category_en_not_null": "product_category_name_english IS NOT NULL",
        },
    ),
    "orders_enriched": RuleSet(
        fail={"Order_ID_Obrigatorio": "order_id IS NOT NULL", "Customer_ID_Obrigatorio": "customer_id IS NOT NULL"},
    ),
    "items_enriched": RuleSet(
        fail={
            "Item_Order_ID_Obrigatorio": "order_id IS NOT NULL",
            "Item_Product_ID_Obrigatorio": "product_id IS NOT NULL",
        },
    ),
}

LINEAGE = ["_ingestao_ts", "_fonte", "_versao_ingestao"]

_EVENTS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
# Elapsed-time column -> (first event, last event).
_LEGS = {
    "tempo_aprovacao_seg": ("order_purchase_timestamp", "order_approved_at"),
    "tempo_postagem_seg": ("order_approved_at", "order_delivered_carrier_date"),
    "tempo_transporte_seg": ("order_delivered_carrier_date", "order_delivered_customer_date"),
    "tempo_total_seg": ("order_purchase_timestamp", "order_delivered_customer_date"),
}


def _kept(df: DataFrame, names: list[str]) -> list[str]:
    """Lineage columns that are present, for the change-feed form of a table."""
    return [c for c in names if c in df.columns]


def orders(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns({c: F.col(c).cast("timestamp") for c in _EVENTS})
    delivered, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    derived = {name: S.elapsed_seconds(first, last) for name, (first, last) in _LEGS.items()}
    derived["delta_entrega_dias"] = S.delay_days(delivered, promised)
    derived["status_entrega"] = ladders.delivery_status(delivered, promised)
    return typed.select(
        "order_id", "customer_id", S.clean_lower("order_status").alias("order_status"), *_EVENTS,
        *[c.alias(n) for n, c in derived.items()],
    )


def _place(raw: DataFrame, who: str, ids: list[str]) -> DataFrame:
    """Address columns of a party, cleaned: zip of five digits, city lower case, state upper case."""
    return raw.select(
        *ids,
        S.pad_zip(f"{who}_zip_code_prefix").alias(f"{who}_zip_code"),
        S.clean_lower(f"{who}_city").alias(f"{who}_city"),
        S.clean_upper(f"{who}_state").alias(f"{who}_state"),
        *_kept(raw, LINEAGE),
    )


def customers(raw: DataFrame) -> DataFrame:
    return _place(raw, "customer", ["customer_id", "customer_unique_id"])


def sellers(raw: DataFrame) -> DataFrame:
    return _place(raw, "seller", ["seller_id"])


def items(raw: DataFrame) -> DataFrame:
    priced = raw.withColumns({
        "price": S.money("price"),
        "freight_value": S.money("freight_value"),
        "shipping_limit_date": F.col("shipping_limit_date").cast("timestamp"),
    })
    return priced.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def payments(raw: DataFrame) -> DataFrame:
    kind = S.clean_lower("payment_type")
    return raw.select(
        "order_id", "payment_sequential", kind.alias("payment_type"), "payment_installments",
        S.money("payment_value").alias("payment_value"), ladders.payment_group(kind).alias("payment_group"),
    )


def reviews(raw: DataFrame) -> DataFrame:
    created, answered = (F.col(c).cast("timestamp") for c in ("review_creation_date", "review_answer_timestamp"))
    score = F.col("review_score").cast("int")
    return raw.select(
        "review_id",
        "order_id",
        score.alias("review_score"),
        S.text_or("review_comment_title").alias("review_title"),
        S.text_or("review_comment_message").alias("review_message"),
        created.alias("review_creation_date"),
        answered.alias("review_answer_timestamp"),
        S.elapsed_seconds(created, answered).alias("tempo_resposta_seg"),
        ladders.score_sentiment(score).alias("review_sentiment"),
        S.has_text("review_comment_message").alias("has_comment"),
    )


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Translated category, weight in kilograms, sizes, volume and size class."""
    sized = raw.withColumns({
        c: S.money(c) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    })
    named = joins.join_lookup_coalesce(
        sized, translation, "product_category_name", "product_category_name_english", "product_category"
    )
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    volume = F.col(sides[0]) * F.col(sides[1]) * F.col(sides[2])
    return named.select(
        "product_id",
        "product_category",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
        F.round(F.col("product_weight_g") / 1000, 2).alias("product_weight_kg"),
        *[F.round(c, 1).alias(c) for c in sides],
        F.round(volume, 1).alias("product_volume_cm3"),
        ladders.size_class(F.col("product_weight_g")).alias("porte_produto"),
        *_kept(named, LINEAGE),
    )


def geolocation(raw: DataFrame) -> DataFrame:
    return aggregates.geo_centroids(raw)


def category_translation(raw: DataFrame) -> DataFrame:
    names = ["product_category_name", "product_category_name_english"]
    return raw.select(*[F.trim(c).alias(c) for c in names], *_kept(raw, LINEAGE))


def orders_enriched(clean_orders: DataFrame, clean_customers: DataFrame, clean_payments: DataFrame) -> DataFrame:
    """Orders with the buyer's address and a one-row payment summary.

    Payments are summarised per order first; orders then meet them on the same key, so orders are shuffled by order
    once and by customer once.
    """
    buyer = ["customer_unique_id", "customer_city", "customer_state", "customer_zip_code"]
    paid = aggregates.payment_summary(clean_payments)
    joined = joins.left_pick(clean_orders, clean_customers, "customer_id", buyer).join(paid, "order_id", "left")
    return joined.select(
        "order_id", "customer_id", "customer_unique_id", "order_status", *_EVENTS, *_LEGS, "delta_entrega_dias",
        "status_entrega", "customer_city", "customer_state", "customer_zip_code", "total_pago", "max_parcelas",
        "num_pagamentos", "metodo_pagamento_principal", "grupo_pagamento_principal",
    )


def items_enriched(clean_items: DataFrame, clean_products: DataFrame, clean_sellers: DataFrame) -> DataFrame:
    goods = ["product_category", "product_weight_kg", "product_volume_cm3", "porte_produto"]
    shop = ["seller_city", "seller_state", "seller_zip_code"]
    joined = joins.left_pick(clean_items, clean_products, "product_id", goods)
    joined = joins.left_pick(joined, clean_sellers, "seller_id", shop)
    return joined.select(*clean_items.columns, *goods, *shop)
