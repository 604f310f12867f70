"""Joins: J1-J16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, joins
from .oracle import dbl, txt
from .registry import check


@check("J1_join_order_totals", f"""
    SELECT i.order_id, i.order_item_id, i.product_id, i.price, {dbl('p.total')} AS total_order_value,
      p.n AS num_payment_methods
    FROM b_items i LEFT JOIN (SELECT order_id, SUM(payment_value) AS total, COUNT(*) AS n FROM b_payments GROUP BY 1) p
      ON i.order_id = p.order_id""")
def _(b):
    lines = b.raw_items.select("order_id", "order_item_id", "product_id", "price")
    joined = joins.join_order_totals(lines, aggregates.order_payment_totals(b.raw_payments))
    return joined.select(*lines.columns, "total_order_value", "num_payment_methods")


@check("J2_join_lookup_coalesce", """
    SELECT product_id, coalesce(t.product_category_name_english, replace(p.product_category_name, '_', ' '))
      AS product_category
    FROM b_products p LEFT JOIN b_translation t ON p.product_category_name = t.product_category_name""")
def _(b):
    return joins.join_lookup_coalesce(
        b.raw_products, b.raw_translation, "product_category_name", "product_category_name_english", "product_category"
    ).select("product_id", "product_category")


@check("J3_enrich_orders", f"""
    SELECT order_id, customer_unique_id, customer_state, {dbl('total_pago')} AS total_pago, num_pagamentos,
      metodo_pagamento_principal FROM s_orders_enriched""")
def _(b):
    return b.orders_enriched.select(
        "order_id", "customer_unique_id", "customer_state", "total_pago", "num_pagamentos",
        "metodo_pagamento_principal",
    )


@check("J4_enrich_items", """
    SELECT order_id, order_item_id, product_id, seller_id, product_category, porte_produto, seller_state
    FROM s_items_enriched""")
def _(b):
    return b.items_enriched.select(
        "order_id", "order_item_id", "product_id", "seller_id", "product_category", "porte_produto", "seller_state"
    )


@check("J5_join_customer_orders", f"""
    SELECT o.order_id, c.customer_unique_id, c.customer_state, {dbl('v.t')} AS order_total
    FROM s_customers c JOIN s_orders o ON c.customer_id = o.customer_id
      JOIN (SELECT order_id, SUM(total_item_value) AS t FROM s_items GROUP BY 1) v ON o.order_id = v.order_id""")
def _(b):
    joined = joins.join_customer_orders(b.customers, b.orders, aggregates.order_values(b.items))
    return joined.select("order_id", "customer_unique_id", "customer_state", "order_total")


@check("J6_join_items_orders", f"""
    SELECT i.order_id, i.product_id, i.seller_id, {dbl('i.price')} AS price, o.order_status
    FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
    WHERE o.order_status IN ('delivered','invoiced','processing','shipped')""")
def _(b):
    joined = joins.join_items_orders(b.items, b.orders.select("order_id", "order_status"), joins.SALE_STATUSES)
    return joined.select("order_id", "product_id", "seller_id", "price", "order_status")


@check("J7_join_items_reviews", """
    SELECT i.product_id, CAST(SUM(r.review_score) AS BIGINT) AS score_sum, COUNT(r.review_score) AS scored_reviews,
      COUNT(r.review_id) AS total_reviews, COUNT(*) FILTER (WHERE r.review_score <= 2) AS negative_reviews
    FROM s_items i JOIN s_scores r ON i.order_id = r.order_id GROUP BY 1""")
def _(b):
    return joins.join_items_reviews(b.items, b.scores, "product_id")


@check("J8_left_then_require", f"""
    SELECT p.product_id, s.n AS vendas, r.n AS reviews
    FROM s_products p LEFT JOIN (SELECT product_id, COUNT(*) AS n FROM s_items GROUP BY 1) s ON p.product_id = s.product_id
      LEFT JOIN (SELECT i.product_id, COUNT(*) AS n FROM s_items i JOIN s_scores r ON i.order_id = r.order_id
                 WHERE r.review_score = 1 GROUP BY 1) r ON p.product_id = r.product_id
    WHERE s.n > 25""")
def _(b):
    sold = b.items.groupBy("product_id").agg(F.count(F.lit(1)).alias("vendas"))
    bad = joins.join_items_reviews(b.items, b.scores.where("review_score = 1"), "product_id")
    judged = bad.select("product_id", F.col("total_reviews").alias("reviews"))
    return joins.left_then_require(b.products.select("product_id"), sold, judged, "product_id", F.col("vendas") > 25)


@check("J9_join_features", f"""
    SELECT o.order_id, o.customer_state, {dbl('a.total_itens_valor')} AS total_itens_valor, a.peso_medio_kg, a.qtd_itens
    FROM s_orders_enriched o JOIN g_items_agg a ON o.order_id = a.order_id""")
def _(b):
    joined = joins.join_features(b.orders_enriched, aggregates.items_feature_agg(b.items_enriched))
    return joined.select("order_id", "customer_state", "total_itens_valor", "peso_medio_kg", "qtd_itens")


@check("J11_effective_dated_join", f"""
    SELECT {txt('u.usage_date')} AS usage_date, u.sku_name, {dbl('u.usage_quantity')} AS usage_quantity,
      {dbl('p.preco')} AS preco
    FROM u_usage u LEFT JOIN u_prices p ON u.sku_name = p.sku_name
      AND u.usage_date BETWEEN p.price_start_time AND coalesce(p.price_end_time, DATE '2099-12-31')""")
def _(b):
    usage = b.usage.select("usage_date", "sku_name", "usage_quantity")
    prices = b.prices.select("sku_name", F.col("pricing.default").alias("preco"), "price_start_time", "price_end_time")
    joined = joins.effective_dated_join(usage, prices, "sku_name", "usage_date", "price_start_time", "price_end_time")
    return joined.select("usage_date", "sku_name", "usage_quantity", "preco")


@check("J12_join_reviews_delivery", """
    SELECT r.review_id, r.review_sentiment, o.status_entrega, o.delta_entrega_dias
    FROM s_scores r JOIN s_orders o ON r.order_id = o.order_id""")
def _(b):
    joined = joins.join_reviews_delivery(b.scores, b.orders)
    return joined.select("review_id", "review_sentiment", "status_entrega", "delta_entrega_dias")


FIRST_LINE = """(SELECT order_id, product_category, seller_state FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY order_item_id, product_id, seller_id) AS rn FROM s_items_enriched) WHERE rn = 1)"""


@check("J13_join_review_context", f"""
    SELECT r.review_id, r.order_id, o.customer_state, o.status_entrega, i.product_category, i.seller_state
    FROM s_scores r JOIN s_orders_enriched o ON r.order_id = o.order_id JOIN {FIRST_LINE} i ON r.order_id = i.order_id""")
def _(b):
    joined = joins.join_review_context(b.scores.select("review_id", "order_id"), b.orders_enriched, b.items_enriched)
    return joined.drop("delta_entrega_dias")


PERSON_SEGMENT = """(SELECT customer_unique_id, arg_max(rfm_segment, CAST(last_purchase AS VARCHAR) || customer_state
        || customer_city) AS rfm_segment FROM g_rfm GROUP BY 1)"""


@check("J14_join_risk_segment", f"""
    SELECT p.order_id, p.risco_atraso, o.customer_unique_id, s.rfm_segment
    FROM g_predictions p LEFT JOIN s_orders_enriched o ON p.order_id = o.order_id
      LEFT JOIN {PERSON_SEGMENT} s ON o.customer_unique_id = s.customer_unique_id""")
def _(b):
    joined = joins.join_risk_segment(b.predictions, b.orders_enriched, b.rfm)
    return joined.select("order_id", "risco_atraso", "customer_unique_id", "rfm_segment")


@check("J15_join_geo", f"""
    SELECT c.customer_id, c.customer_zip_code, CAST(g.pontos AS BIGINT) AS pontos
    FROM s_customers c LEFT JOIN (SELECT geolocation_zip_code_prefix AS z, SUM(num_registros) AS pontos,
        SUM(geolocation_lat * num_registros) AS w FROM s_geolocation GROUP BY 1) g ON c.customer_zip_code = g.z""")
def _(b):
    located = joins.join_geo(b.customers, b.geolocation)
    counts = b.geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("customer_zip_code")).agg(
        F.sum("num_registros").alias("pontos")
    )
    # A customer has a point exactly when the zip has registered rows.
    matched = located.join(counts, "customer_zip_code", "left")
    return matched.select(
        "customer_id", "customer_zip_code", F.when(F.col("lat").isNotNull(), F.col("pontos")).alias("pontos")
    )


@check("J15_zip_points", """
    SELECT geolocation_zip_code_prefix, round(SUM(geolocation_lat * num_registros) / SUM(num_registros), 4) AS lat,
      round(SUM(geolocation_lng * num_registros) / SUM(num_registros), 4) AS lng FROM s_geolocation GROUP BY 1""")
def _(b):
    points = joins.zip_points(b.geolocation)
    return points.select("geolocation_zip_code_prefix", *[F.round(c, 4).alias(c) for c in ("lat", "lng")])


@check("J16_semi_join_in", """
    SELECT order_id, customer_id FROM s_orders
    WHERE order_id IN (SELECT order_id FROM s_items WHERE price > 100000)""")
def _(b):
    dear = b.items.where(F.col("price") > 100000)
    return joins.semi_join_in(b.orders.select("order_id", "customer_id"), dear, "order_id")
