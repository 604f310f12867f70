"""The bound tables once more, as SQL over the test tables, and helpers for exact rounding.

Each entry of ``TABLES`` is one common table expression. ``statement`` puts the ones a query needs, in order, in front
of it.
"""

from __future__ import annotations

import re


def half_up(top: str, bottom: str, digits: int) -> str:
    """``top / bottom`` of whole numbers, rounded half away from zero, as a double."""
    unit = 10**digits
    return (
        f"(SIGN({top}) * CAST((2 * ABS(CAST({top} AS HUGEINT)) * {unit} + CAST({bottom} AS HUGEINT))"
        f" // NULLIF(2 * CAST({bottom} AS HUGEINT), 0) AS DOUBLE) / {unit})"
    )


def mean(value: str, digits: int, scale: int = 2) -> str:
    """Mean of an aggregate input that has ``scale`` decimals."""
    unit = 10**scale
    return half_up(f"SUM(CAST(({value}) * {unit} AS HUGEINT))", f"(COUNT({value}) * {unit})", digits)


def ratio(top: str, bottom: str, digits: int, scale: int = 2) -> str:
    """A sum with ``scale`` decimals over a whole number."""
    unit = 10**scale
    return half_up(f"CAST(({top}) * {unit} AS HUGEINT)", f"(({bottom}) * {unit})", digits)


def pct(part: str, whole: str, digits: int = 1) -> str:
    return half_up(f"(({part}) * 100)", f"({whole})", digits)


def pct_where(condition: str, digits: int = 1) -> str:
    return pct(f"COUNT(*) FILTER (WHERE {condition})", "COUNT(*)", digits)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def txt(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


_STATES = "['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO']"
NORTE = "('AC','AM','AP','PA','RO','RR','TO')"
SALES = "('delivered','invoiced','processing','shipped')"
REGION = (
    "CASE WHEN estado IN ('AC','AM','AP','PA','RO','RR','TO') THEN 'Norte' "
    "WHEN estado IN ('AL','BA','CE','MA','PB','PE','PI','RN','SE') THEN 'Nordeste' "
    "WHEN estado IN ('DF','GO','MS','MT') THEN 'Centro-Oeste' "
    "WHEN estado IN ('ES','MG','RJ','SP') THEN 'Sudeste' "
    "WHEN estado IN ('PR','RS','SC') THEN 'Sul' ELSE 'Outros' END"
)
TIER = (
    "CASE WHEN estado IN ('MG','PR','RJ','RS','SP') THEN 'Tier 1' "
    "WHEN estado IN ('BA','CE','DF','ES','GO','PA','PE','SC') THEN 'Tier 2' ELSE 'Tier 3' END"
)
_CAT = "lower(p_type) || '_' || replace(lower(p_brand), '#', '_')"
AS_OF = "DATE '2001-08-15'"
USAGE_CATEGORY = (
    "CASE WHEN lower(sku_name) LIKE '%dlt%' OR lower(sku_name) LIKE '%pipelines%' THEN 'DLT Pipelines' "
    "WHEN lower(sku_name) LIKE '%serving%' OR lower(sku_name) LIKE '%model%' THEN 'Model Serving' "
    "WHEN lower(sku_name) LIKE '%sql%' OR lower(sku_name) LIKE '%warehouse%' THEN 'SQL Warehouse' "
    "WHEN lower(sku_name) LIKE '%serverless%compute%' OR lower(sku_name) LIKE '%interactive%' "
    "THEN 'Serverless Compute' ELSE 'Outros' END"
)
SCALE5 = (
    "CASE WHEN delta_entrega_dias IS NULL THEN 'sem_informacao' WHEN delta_entrega_dias <= -3 THEN 'muito_adiantado' "
    "WHEN delta_entrega_dias <= 0 THEN 'no_prazo' WHEN delta_entrega_dias <= 5 THEN 'atraso_leve' "
    "ELSE 'atraso_grave' END"
)
# Minimum of a shared value: reviews of an order times its lines are written as the plain pair join here.
_REVIEW_PAIRS = "s_items i JOIN s_scores r ON i.order_id = r.order_id"

TABLES: dict[str, str] = {
    "b_orders": f"""
        SELECT o_orderkey AS k, {txt('o_orderkey')} AS order_id, {txt('o_custkey')} AS customer_id,
          CASE WHEN o_orderkey % 50 = 7 THEN 'weird' WHEN o_orderkey % 50 = 8 THEN 'processing'
               WHEN o_orderkey % 50 = 9 THEN 'invoiced' WHEN o_orderstatus = 'F' THEN ' Delivered '
               WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'CANCELED' END AS order_status,
          bought AS order_purchase_timestamp,
          CASE WHEN o_orderkey % 23 <> 0 THEN bought + to_hours(o_orderkey % 48) END AS order_approved_at,
          CASE WHEN o_orderstatus <> 'P' THEN bought + to_hours(o_orderkey % 5 * 24 + 60) END
            AS order_delivered_carrier_date,
          CASE WHEN o_orderstatus = 'F' THEN bought + to_hours((o_orderkey % 70 + 5) * 24 + o_orderkey % 3) END
            AS order_delivered_customer_date,
          o_orderdate + to_hours(720) AS order_estimated_delivery_date
        FROM (SELECT *, o_orderdate + to_hours(o_orderkey % 24) AS bought FROM orders)""",
    "b_customers": f"""
        SELECT {txt('c_custkey')} AS customer_id, 'u' || {txt('c_custkey // 2')} AS customer_unique_id,
          (c_custkey * 37) % 100000 AS customer_zip_code_prefix, ' ' || c_mktsegment || ' ' AS customer_city,
          lower({_STATES}[c_nationkey + 1]) || ' ' AS customer_state FROM customer""",
    "b_sellers": f"""
        SELECT {txt('s_suppkey')} AS seller_id, (s_suppkey * 53) % 100000 AS seller_zip_code_prefix,
          ' City ' || {txt('s_suppkey % 40')} AS seller_city, lower({_STATES}[s_nationkey + 1]) AS seller_state
        FROM supplier""",
    "b_products": f"""
        SELECT {txt('p_partkey')} AS product_id, CASE WHEN p_partkey % 41 <> 0 THEN {_CAT} END AS product_category_name,
          length(p_name) AS product_name_lenght, p_size * 10 AS product_description_lenght,
          p_size % 6 AS product_photos_qty, CASE WHEN p_partkey % 31 <> 0 THEN p_size * 150 END AS product_weight_g,
          p_size + 10 AS product_length_cm, p_partkey % 20 + 5 AS product_height_cm,
          p_partkey % 15 + 8 AS product_width_cm FROM part""",
    "b_translation": f"""
        SELECT DISTINCT {_CAT} AS product_category_name,
          'en ' || replace({_CAT}, '_', ' ') AS product_category_name_english FROM part WHERE p_type <> 'ECONOMY'""",
    "b_items": f"""
        SELECT {txt('l_orderkey')} AS order_id, l_linenumber AS order_item_id, {txt('l_partkey')} AS product_id,
          {txt('l_suppkey')} AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "b_payments": f"""
        SELECT {txt('o_orderkey')} AS order_id, seq AS payment_sequential,
          CASE WHEN seq = 2 THEN 'voucher' WHEN o_orderpriority = '1-URGENT' THEN 'credit_card'
               WHEN o_orderpriority = '2-HIGH' THEN 'boleto' WHEN o_orderpriority = '3-MEDIUM' THEN 'voucher'
               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' Debit_Card ' ELSE 'not_defined' END AS payment_type,
          o_orderkey % 10 + 1 AS payment_installments,
          CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CASE WHEN o_orderkey % 5 <> 0 THEN 0.25 WHEN seq = 1 THEN 0.15
               ELSE 0.10 END AS DECIMAL(10,2)) AS payment_value
        FROM orders, (VALUES (1), (2)) AS s(seq) WHERE seq = 1 OR o_orderkey % 5 = 0""",
    "b_reviews": f"""
        SELECT 'r' || {txt('o_orderkey')} AS review_id, {txt('o_orderkey')} AS order_id,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 6
               ELSE (o_orderkey * 7) % 11 % 5 + 1 END AS review_score,
          d.text AS review_comment_message,
          o_orderdate + to_hours((o_orderkey % 40 + 10) * 24) AS review_creation_date,
          o_orderdate + to_hours((o_orderkey % 40 + 10) * 24 + o_orderkey % 100) AS review_answer_timestamp
        FROM orders LEFT JOIN documents d ON d.doc_id = o_orderkey WHERE o_orderkey % 4 <> 3""",
    "b_geolocation": f"""
        SELECT c_custkey % 300 AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
          c_nationkey * 1.5 AS geolocation_lng, ' ' || c_mktsegment AS geolocation_city,
          lower({_STATES}[c_nationkey + 1]) AS geolocation_state FROM customer""",
    "s_orders": """
        SELECT k, order_id, customer_id, lower(trim(order_status)) AS order_status, order_purchase_timestamp,
          order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
          order_estimated_delivery_date,
          CAST(epoch(order_approved_at) - epoch(order_purchase_timestamp) AS BIGINT) AS tempo_aprovacao_seg,
          CAST(epoch(order_delivered_carrier_date) - epoch(order_approved_at) AS BIGINT) AS tempo_postagem_seg,
          CAST(epoch(order_delivered_customer_date) - epoch(order_delivered_carrier_date) AS BIGINT)
            AS tempo_transporte_seg,
          CAST(epoch(order_delivered_customer_date) - epoch(order_purchase_timestamp) AS BIGINT) AS tempo_total_seg,
          date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delta_entrega_dias,
          CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'no_prazo'
               WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'atrasado'
               ELSE 'pendente' END AS status_entrega
        FROM b_orders""",
    "s_customers": """
        SELECT customer_id, customer_unique_id,
          lpad(CAST(customer_zip_code_prefix AS VARCHAR), 5, '0') AS customer_zip_code,
          lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM b_customers""",
    "s_sellers": """
        SELECT seller_id, lpad(CAST(seller_zip_code_prefix AS VARCHAR), 5, '0') AS seller_zip_code,
          lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state FROM b_sellers""",
    "s_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
          CAST(price AS DECIMAL(10,2)) AS price, freight_value,
          CAST(price AS DECIMAL(10,2)) + freight_value AS total_item_value FROM b_items""",
    "s_payments": """
        SELECT *, CASE WHEN payment_type IN ('credit_card', 'debit_card') THEN 'cartao'
                       WHEN payment_type = 'boleto' THEN 'boleto' WHEN payment_type = 'voucher' THEN 'voucher'
                       ELSE 'outro' END AS payment_group
        FROM (SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type, payment_installments,
                payment_value FROM b_payments)
        WHERE payment_value BETWEEN 0.01 AND 99999.99""",
    "s_reviews": """
        SELECT review_id, order_id, review_score, '' AS review_title,
          coalesce(review_comment_message, '') AS review_message, review_creation_date, review_answer_timestamp,
          CAST(epoch(review_answer_timestamp) - epoch(review_creation_date) AS BIGINT) AS tempo_resposta_seg,
          CASE WHEN review_score >= 4 THEN 'positivo' WHEN review_score = 3 THEN 'neutro' ELSE 'negativo' END
            AS review_sentiment,
          review_comment_message IS NOT NULL AND length(review_comment_message) > 0 AS has_comment
        FROM b_reviews""",
    "s_scores": """
        SELECT review_id, order_id, review_score, review_creation_date, tempo_resposta_seg, review_sentiment
        FROM s_reviews""",
    "s_translation": "SELECT * FROM b_translation",
    "s_products": """
        SELECT product_id,
          coalesce(t.product_category_name_english, replace(p.product_category_name, '_', ' ')) AS product_category,
          product_name_lenght AS product_name_length, product_description_lenght AS product_description_length,
          product_photos_qty, CAST(product_weight_g // 150 * 0.15 AS DECIMAL(10,2)) AS product_weight_kg,
          product_length_cm, product_height_cm, product_width_cm,
          CAST(product_length_cm * product_height_cm * product_width_cm AS DECIMAL(18,1)) AS product_volume_cm3,
          CASE WHEN product_weight_g <= 500 THEN 'pequeno' WHEN product_weight_g <= 5000 THEN 'medio'
               ELSE 'grande' END AS porte_produto
        FROM b_products p LEFT JOIN b_translation t ON p.product_category_name = t.product_category_name""",
    "s_geolocation": """
        SELECT lpad(CAST(geolocation_zip_code_prefix AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
          lower(trim(geolocation_city)) AS geolocation_city, upper(trim(geolocation_state)) AS geolocation_state,
          round(avg(geolocation_lat), 6) AS geolocation_lat, round(avg(geolocation_lng), 6) AS geolocation_lng,
          COUNT(*) AS num_registros FROM b_geolocation GROUP BY 1, 2, 3""",
    "s_paid": """
        SELECT order_id, SUM(payment_value) AS total_pago, MAX(payment_installments) AS max_parcelas,
          COUNT(*) AS num_pagamentos, arg_min(payment_type, payment_sequential) AS metodo_pagamento_principal,
          arg_min(payment_group, payment_sequential) AS grupo_pagamento_principal
        FROM s_payments GROUP BY order_id""",
    "s_orders_enriched": """
        SELECT o.*, c.customer_unique_id, c.customer_city, c.customer_state, c.customer_zip_code, p.total_pago,
          p.max_parcelas, p.num_pagamentos, p.metodo_pagamento_principal, p.grupo_pagamento_principal
        FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
          LEFT JOIN s_paid p ON o.order_id = p.order_id""",
    "s_items_enriched": """
        SELECT i.*, p.product_category, p.product_weight_kg, p.product_volume_cm3, p.porte_produto, s.seller_city,
          s.seller_state, s.seller_zip_code
        FROM s_items i LEFT JOIN s_products p ON i.product_id = p.product_id
          LEFT JOIN s_sellers s ON i.seller_id = s.seller_id""",
    "g_fact": f"""
        SELECT CAST(o.order_purchase_timestamp AS DATE) AS data_venda, COUNT(DISTINCT o.order_id) AS total_pedidos,
          COUNT(DISTINCT o.customer_id) AS total_clientes, SUM(i.total_item_value) AS gmv,
          {mean('i.total_item_value', 2)} AS ticket_medio, SUM(i.freight_value) AS total_frete
        FROM s_orders o JOIN s_items i ON o.order_id = i.order_id WHERE o.order_status IN {SALES} GROUP BY 1""",
    "g_rfm": f"""
        SELECT *, CASE WHEN frequency >= 3 AND recency_days <= 90 THEN 'Champions'
            WHEN frequency >= 2 AND recency_days <= 180 THEN 'Loyal' WHEN frequency = 1 AND recency_days <= 90 THEN 'New'
            WHEN frequency >= 2 AND recency_days > 180 THEN 'At Risk' WHEN frequency = 1 AND recency_days > 365 THEN 'Lost'
            ELSE 'Hibernating' END AS rfm_segment
        FROM (
          SELECT c.customer_unique_id, c.customer_state, c.customer_city, COUNT(DISTINCT o.order_id) AS frequency,
            SUM(v.order_total) AS monetary,
            date_diff('day', MAX(o.order_purchase_timestamp), {AS_OF}) AS recency_days,
            MIN(o.order_purchase_timestamp) AS first_purchase, MAX(o.order_purchase_timestamp) AS last_purchase,
            {mean('v.order_total', 2)} AS avg_ticket
          FROM s_customers c JOIN s_orders o ON c.customer_id = o.customer_id
            JOIN (SELECT order_id, CAST(SUM(total_item_value) AS DECIMAL(20,2)) AS order_total FROM s_items
                  GROUP BY 1) v ON o.order_id = v.order_id
          WHERE o.order_status = 'delivered' GROUP BY 1, 2, 3)""",
    "g_products": f"""
        SELECT p.product_id, p.product_category, p.product_weight_kg, s.total_orders, s.total_revenue, s.avg_price,
          s.last_sale_date, s.days_since_last_sale, r.avg_review_score, r.total_reviews, r.negative_review_rate,
          CASE WHEN days_since_last_sale <= 30 THEN 'Ativo' WHEN days_since_last_sale <= 90 THEN 'Moderado'
               WHEN days_since_last_sale <= 180 THEN 'Baixo' ELSE 'Inativo' END AS product_status
        FROM s_products p
          JOIN (SELECT i.product_id, COUNT(DISTINCT i.order_id) AS total_orders,
                  SUM(i.total_item_value) AS total_revenue, {mean('i.price', 2)} AS avg_price,
                  MAX(o.order_purchase_timestamp) AS last_sale_date,
                  date_diff('day', MAX(o.order_purchase_timestamp), {AS_OF}) AS days_since_last_sale
                FROM s_items i JOIN s_orders o ON i.order_id = o.order_id WHERE o.order_status = 'delivered'
                GROUP BY 1) s ON p.product_id = s.product_id
          LEFT JOIN (SELECT i.product_id, {mean('r.review_score', 2, 0)} AS avg_review_score,
                  COUNT(r.review_id) AS total_reviews,
                  {pct('COUNT(*) FILTER (WHERE r.review_score <= 2)', 'COUNT(r.review_id)', 2)} AS negative_review_rate
                FROM {_REVIEW_PAIRS} GROUP BY 1) r ON p.product_id = r.product_id""",
    "g_seller_metrics": f"""
        SELECT i.seller_id, COUNT(DISTINCT o.order_id) AS total_orders,
          COUNT(*) FILTER (WHERE o.order_status = 'delivered') AS delivered_orders,
          COUNT(*) FILTER (WHERE o.order_status = 'canceled') AS canceled_orders,
          COUNT(*) FILTER (WHERE o.status_entrega = 'no_prazo') AS on_time_orders,
          {mean('o.delta_entrega_dias', 2, 0)} AS avg_delivery_delta
        FROM s_items i JOIN s_orders o ON i.order_id = o.order_id GROUP BY 1""",
    "g_sellers": f"""
        SELECT *, CASE WHEN seller_score >= 80 THEN 'Excelente' WHEN seller_score >= 60 THEN 'Bom'
            WHEN seller_score >= 40 THEN 'Regular' ELSE 'Critico' END AS seller_tier
        FROM (
          SELECT s.seller_id, s.seller_city, s.seller_state, m.total_orders, m.delivered_orders, m.canceled_orders,
            {half_up('r.score_sum', 'r.scored', 2)} AS avg_review_score, r.negative_reviews,
            {pct('m.on_time_orders', 'm.delivered_orders', 2)} AS on_time_rate,
            {pct('m.canceled_orders', 'm.total_orders', 2)} AS cancel_rate,
            floor((coalesce(r.score_sum / (r.scored * 5.0), 0.5) * 40
              + coalesce(m.on_time_orders / NULLIF(CAST(m.delivered_orders AS DOUBLE), 0), 0.5) * 30
              + (1 - m.canceled_orders / CAST(m.total_orders AS DOUBLE)) * 20
              + least(m.total_orders / 100.0, 1) * 10) * 100 + 0.5 + 1e-9) / 100 AS seller_score
          FROM s_sellers s JOIN g_seller_metrics m ON s.seller_id = m.seller_id
            LEFT JOIN (SELECT i.seller_id, SUM(r.review_score) AS score_sum, COUNT(r.review_score) AS scored,
                         COUNT(*) FILTER (WHERE r.review_score <= 2) AS negative_reviews
                       FROM {_REVIEW_PAIRS} GROUP BY 1) r ON s.seller_id = r.seller_id)""",
    "g_items_agg": f"""
        SELECT order_id, SUM(total_item_value) AS total_itens_valor, SUM(freight_value) AS total_frete,
          {mean('product_weight_kg', 4)} AS peso_medio_kg, {mean('product_volume_cm3', 2, 1)} AS volume_medio_cm3,
          COUNT(*) AS qtd_itens, MAX(seller_state) AS seller_state
        FROM s_items_enriched GROUP BY 1""",
    "g_features": """
        SELECT o.order_id, o.customer_id, CASE WHEN o.status_entrega = 'atrasado' THEN 1 ELSE 0 END AS label,
          o.tempo_aprovacao_seg, coalesce(o.tempo_postagem_seg, 0) AS tempo_postagem_seg,
          CAST(coalesce(o.total_pago, 0) AS DECIMAL(22,2)) AS total_pago, coalesce(o.max_parcelas, 1) AS max_parcelas,
          CASE WHEN o.grupo_pagamento_principal = 'cartao' THEN 1 ELSE 0 END AS pag_cartao,
          CASE WHEN o.grupo_pagamento_principal = 'boleto' THEN 1 ELSE 0 END AS pag_boleto, o.customer_state,
          CAST(coalesce(i.total_itens_valor, 0) AS DECIMAL(22,2)) AS total_itens_valor,
          CAST(coalesce(i.total_frete, 0) AS DECIMAL(22,2)) AS total_frete, coalesce(i.peso_medio_kg, 0) AS peso_medio_kg,
          coalesce(i.volume_medio_cm3, 0) AS volume_medio_cm3, i.qtd_itens, i.seller_state, o.delta_entrega_dias,
          o.status_entrega, o.order_status, o.k
        FROM s_orders_enriched o JOIN g_items_agg i ON o.order_id = i.order_id
        WHERE o.status_entrega IN ('no_prazo', 'atrasado') AND o.tempo_aprovacao_seg IS NOT NULL""",
    "g_predictions": """
        SELECT *, CASE WHEN probabilidade_falha > 0.5 THEN 1 ELSE 0 END AS predicao_atraso,
          CASE WHEN probabilidade_falha <= 0.3 THEN 'baixo' WHEN probabilidade_falha <= 0.6 THEN 'medio'
               ELSE 'alto' END AS risco_atraso, 'v' || CAST(k % 3 + 1 AS VARCHAR) AS modelo_versao,
          '2024-06-01 12:00:00' AS scored_at
        FROM (SELECT *, CAST((k * 7919) % 701 + label * 300 AS DOUBLE) / 1024.0 AS probabilidade_falha FROM g_features)""",
    "t_labelled": """
        SELECT review_id, order_id, review_score, review_sentiment AS sentimento_regra,
          CASE WHEN n % 10 = 0 THEN 'Mixed' WHEN n % 10 = 1 THEN 'Positive' WHEN n % 10 = 2 THEN 'Negative'
               WHEN review_sentiment = 'positivo' THEN 'Positive' WHEN review_sentiment = 'negativo' THEN 'Negative'
               ELSE 'Neutral' END AS sentimento_modelo
        FROM (SELECT *, CAST(substr(review_id, 2) AS BIGINT) AS n FROM s_scores)""",
    "u_usage": """
        SELECT CAST(ts AS DATE) AS usage_date,
          CASE event_type WHEN 'view' THEN 'STANDARD_DLT_CORE' WHEN 'click' THEN 'SERVERLESS_SQL_COMPUTE'
               WHEN 'purchase' THEN 'MODEL_SERVING' WHEN 'signup' THEN 'SERVERLESS_COMPUTE_INTERACTIVE'
               WHEN 'error' THEN 'STORAGE' ELSE 'OTHER' END AS sku_name,
          'ORIGIN_' || CAST(user_id % 3 AS VARCHAR) AS billing_origin_product,
          CAST(value AS DECIMAL(14,4)) AS usage_quantity, 'c' || CAST(user_id % 7 AS VARCHAR) AS cluster_id,
          'w' || CAST(user_id % 4 AS VARCHAR) AS warehouse_id, 'j' || CAST(user_id % 5 AS VARCHAR) AS job_id
        FROM events""",
    "u_prices": """
        WITH span AS (SELECT sku_name, MIN(usage_date) AS a,
                        CAST((length(sku_name) % 5 + 1) * 0.07 AS DECIMAL(8,4)) AS base FROM u_usage GROUP BY 1)
        SELECT sku_name, base AS preco, a AS price_start_time, a + 9 AS price_end_time FROM span
        UNION ALL SELECT sku_name, CAST(base * 1.10 AS DECIMAL(8,4)), a + 10, CAST(NULL AS DATE) FROM span""",
    "u_events": """
        SELECT event_id, 'flow_' || CAST(user_id % 4 AS VARCHAR) AS pipeline_name, event_type,
          CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, ts AS "timestamp" FROM events""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    words = set(re.findall(r"[a-z_]+", sql))
    for name, body in TABLES.items():
        if name in words and name not in found:
            _needed(body, found)
            found[name] = None


def statement(sql: str) -> str:
    """One SELECT with the tables it reads in front. A query may bring tables of its own after ``WITH``."""
    found: dict[str, None] = {}
    _needed(sql, found)
    body = sql.strip()
    tables = [f"{name} AS ({TABLES[name].strip()})" for name in found]
    if body.upper().startswith("WITH "):
        own = body[5:]
        return "WITH " + ",\n".join(tables + [own]) if tables else body
    return ("WITH " + ",\n".join(tables) + "\n" if tables else "") + body
