"""Layers and marts: B1-B3, SV1-SV11, GD1-GD5, GF1-GF12."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import bronze, gold, requirements
from .bound import AS_OF, STAMP
from .oracle import AS_OF as AS_OF_SQL
from .oracle import REGION, SALES, SCALE5, TIER, dbl, half_up, mean, pct_where, txt
from .registry import check

_ORDER_TIMES = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
_TIMES_SQL = ", ".join(f"{txt(c)} AS {c}" for c in _ORDER_TIMES)
_LEGS_SQL = "tempo_aprovacao_seg, tempo_postagem_seg, tempo_transporte_seg, tempo_total_seg"


# ---- raw layer ----------------------------------------------------------------------------------------------------

# Order lines as the nested documents give them: items and payments per order, unfiltered.
LINES = f"""
    SELECT o.order_id, o.order_status, o.customer_id, c.customer_unique_id,
      CAST(c.customer_zip_code_prefix AS VARCHAR) AS customer_zip, c.customer_city, c.customer_state,
      {txt('o.order_purchase_timestamp')} AS purchase_ts, {txt('o.order_approved_at')} AS approved_ts,
      {txt('o.order_delivered_carrier_date')} AS delivered_carrier_ts,
      {txt('o.order_delivered_customer_date')} AS delivered_customer_ts,
      {txt('o.order_estimated_delivery_date')} AS estimated_delivery_ts,
      i.order_item_id, i.product_id, i.seller_id, i.price, CAST(i.freight_value AS DOUBLE) AS freight_value,
      CAST(p.total_order_value AS DOUBLE) AS total_order_value, p.payment_types, p.max_installments,
      p.num_payment_methods, r.review_score, r.review_comment, {txt('r.review_creation_date')} AS review_creation_date,
      date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS delta_entrega_dias,
      coalesce(date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) <= 0, FALSE)
        AS entregue_no_prazo,
      CAST(CAST(o.order_purchase_timestamp AS DATE) AS VARCHAR) AS purchase_date
    FROM b_orders o LEFT JOIN b_customers c ON o.customer_id = c.customer_id
      LEFT JOIN b_items i ON o.order_id = i.order_id
      LEFT JOIN (SELECT order_id, SUM(payment_value) AS total_order_value,
                   array_to_string(list_sort(list(payment_type)), ',') AS payment_types,
                   MAX(payment_installments) AS max_installments, COUNT(*) AS num_payment_methods
                 FROM b_payments GROUP BY 1) p ON o.order_id = p.order_id
      LEFT JOIN (SELECT order_id, review_score, CAST(NULL AS VARCHAR) AS review_comment, review_creation_date
                 FROM b_reviews) r ON o.order_id = r.order_id"""


def _flat_lines(df):
    return df.withColumns({
        "payment_types": F.array_join("payment_types", ","),
        "total_order_value": F.round("total_order_value", 2),
    })


@check("B1_bronze_order_lines", LINES)
def _(b):
    return _flat_lines(bronze.order_lines(b.json_documents))


@check("B1_bronze_order_lines_in_memory", LINES)
def _(b):
    return _flat_lines(bronze.order_lines(b.documents))


@check("B1_bronze_order_lines_repeated_orders", LINES)
def _(b):
    return _flat_lines(bronze.order_lines(b.documents, repeated=True))


# A line is unique up to rows equal in every column, so the winner of (order, item) is the largest row.
@check("B2_bronze_clean_order_lines", f"""
    SELECT order_id, order_item_id, product_id, seller_id, order_status, price, freight_value, review_score,
      {SCALE5} AS status_entrega
    FROM (SELECT order_id, order_item_id, product_id, seller_id,
            CASE WHEN order_status IN ('approved','canceled','created','delivered','invoiced','processing','shipped',
              'unavailable') THEN order_status ELSE 'unknown' END AS order_status,
            price, freight_value, CASE WHEN review_score BETWEEN 1 AND 5 THEN review_score END AS review_score,
            delta_entrega_dias,
            row_number() OVER (PARTITION BY order_id, order_item_id
              ORDER BY product_id DESC NULLS LAST, seller_id DESC NULLS LAST, price DESC NULLS LAST,
                freight_value DESC NULLS LAST) AS rn
          FROM ({LINES}))
    WHERE rn = 1""")
def _(b):
    lines = bronze.order_lines(b.documents)
    winner = ["product_id", "seller_id", "price", "freight_value"]
    return bronze.clean_order_lines(lines, order=winner).select(
        "order_id", "order_item_id", "product_id", "seller_id", "order_status", "price", "freight_value",
        "review_score", "status_entrega",
    )


@check("B2_bronze_clean_customers", """
    SELECT customer_id, customer_unique_id, lpad(CAST(customer_zip_code_prefix AS VARCHAR), 5, '0')
        AS customer_zip_code_prefix, lower(trim(customer_city)) AS customer_city,
      upper(trim(customer_state)) AS customer_state FROM b_customers""")
def _(b):
    return bronze.clean_customers(b.raw_customers)


@check("B2_bronze_clean_products", """
    SELECT product_id, lower(trim(product_category_name)) AS product_category_name, product_name_lenght,
      product_description_lenght, product_photos_qty, coalesce(product_weight_g, 0) AS product_weight_g,
      product_length_cm, product_height_cm, product_width_cm, product_category_name IS NULL AS sem_categoria
    FROM b_products""")
def _(b):
    return bronze.clean_products(b.raw_products)


@check("B3_batch_orders_ingest", f"""
    SELECT order_id, customer_id, order_status, {_TIMES_SQL},
      {txt('CAST(order_purchase_timestamp AS DATE)')} AS order_purchase_date,
      date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delta_entrega_dias,
      '2024-06-01 12:00:00' AS _ingestao_timestamp, 'orders.parquet' AS _source_file FROM b_orders""")
def _(b):
    file_name = F.regexp_extract(F.input_file_name(), "(orders[.]parquet)", 1)
    from .bound import raw_orders

    return bronze.ingest_orders(raw_orders(b.table("orders")), STAMP, file_name)


# ---- clean layer --------------------------------------------------------------------------------------------------

@check("SV1_silver_orders", f"""
    SELECT order_id, customer_id, order_status, {_TIMES_SQL}, {_LEGS_SQL}, delta_entrega_dias, status_entrega
    FROM s_orders""")
def _(b):
    return b.orders


@check("SV2_silver_customers", "SELECT * FROM s_customers")
def _(b):
    return b.customers


@check("SV3_silver_items", f"""
    SELECT order_id, order_item_id, product_id, seller_id, {txt('shipping_limit_date')} AS shipping_limit_date,
      {dbl('price')} AS price, {dbl('freight_value')} AS freight_value, {dbl('total_item_value')} AS total_item_value
    FROM s_items""")
def _(b):
    return b.items


@check("SV4_silver_payments", f"""
    SELECT order_id, payment_sequential, payment_type, payment_installments, {dbl('payment_value')} AS payment_value,
      payment_group FROM s_payments""")
def _(b):
    return b.payments


@check("SV5_silver_reviews", f"""
    SELECT review_id, order_id, review_score, review_title, review_message,
      {txt('review_creation_date')} AS review_creation_date, {txt('review_answer_timestamp')} AS review_answer_timestamp,
      tempo_resposta_seg, review_sentiment, has_comment FROM s_reviews""")
def _(b):
    return b.reviews


_PRODUCTS_SQL = f"""product_id, product_category, product_name_length, product_description_length, product_photos_qty,
      {dbl('product_weight_kg')} AS product_weight_kg, {dbl('product_length_cm')} AS product_length_cm,
      {dbl('product_height_cm')} AS product_height_cm, {dbl('product_width_cm')} AS product_width_cm,
      {dbl('product_volume_cm3')} AS product_volume_cm3, porte_produto"""


@check("SV6_silver_products", f"SELECT {_PRODUCTS_SQL} FROM s_products")
def _(b):
    return b.products


@check("SV7_silver_sellers", "SELECT * FROM s_sellers")
def _(b):
    return b.sellers


@check("SV8_silver_geolocation", "SELECT * FROM s_geolocation")
def _(b):
    return b.geolocation


@check("SV9_silver_category_translation", "SELECT * FROM s_translation")
def _(b):
    return b.translation


@check("SV10_silver_orders_enriched", f"""
    SELECT order_id, customer_id, customer_unique_id, order_status, {_TIMES_SQL}, {_LEGS_SQL}, delta_entrega_dias,
      status_entrega, customer_city, customer_state, customer_zip_code, {dbl('total_pago')} AS total_pago, max_parcelas,
      num_pagamentos, metodo_pagamento_principal, grupo_pagamento_principal FROM s_orders_enriched""")
def _(b):
    return b.orders_enriched


@check("SV11_silver_items_enriched", f"""
    SELECT order_id, order_item_id, product_id, seller_id, {txt('shipping_limit_date')} AS shipping_limit_date,
      {dbl('price')} AS price, {dbl('freight_value')} AS freight_value, {dbl('total_item_value')} AS total_item_value,
      product_category, {dbl('product_weight_kg')} AS product_weight_kg,
      {dbl('product_volume_cm3')} AS product_volume_cm3, porte_produto, seller_city, seller_state, seller_zip_code
    FROM s_items_enriched""")
def _(b):
    return b.items_enriched


# ---- marts --------------------------------------------------------------------------------------------------------

_CALENDAR_SQL = """
    CAST(d AS VARCHAR) AS data_id, year(d) AS ano, month(d) AS mes, day(d) AS dia, quarter(d) AS trimestre,
    extract(dow FROM d) AS dia_semana_num,
    ['Domingo','Segunda','Terça','Quarta','Quinta','Sexta','Sábado'][extract(dow FROM d) + 1] AS dia_semana_nome,
    extract(dow FROM d) IN (0, 6) AS is_fim_de_semana,
    ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro',
     'Dezembro'][month(d)] AS mes_nome,
    CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS ano_trimestre, strftime(d, '%Y-%m') AS ano_mes,
    CASE WHEN month(d) IN (11, 12, 1, 2) THEN 'Alta' WHEN month(d) IN (5, 6, 7, 8) THEN 'Baixa' ELSE 'Media' END
      AS sazonalidade_varejo"""


@check("GD1_dim_tempo", f"""
    SELECT {_CALENDAR_SQL} FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS d FROM s_orders)""")
def _(b):
    return gold.dim_tempo(b.orders)


PLACES = """SELECT customer_state AS estado, customer_city AS cidade FROM s_customers
    UNION SELECT seller_state, seller_city FROM s_sellers"""


@check("GD2_dim_localizacao", f"""
    SELECT row_number() OVER (ORDER BY estado, cidade) AS localizacao_id, estado, cidade, {REGION} AS regiao,
      {TIER} AS tier_mercado FROM ({PLACES})""")
def _(b):
    return gold.dim_localizacao(b.customers, b.sellers)


RFM_SQL = f"""customer_unique_id, customer_state, customer_city, frequency, {dbl('monetary')} AS monetary, recency_days,
    {txt('first_purchase')} AS first_purchase, {txt('last_purchase')} AS last_purchase, avg_ticket, rfm_segment"""


@check("GD3_dim_clientes_rfm", f"SELECT {RFM_SQL} FROM g_rfm")
def _(b):
    return b.rfm


@check("GD3_dim_clientes_rfm_by_person", f"""
    SELECT c.customer_unique_id, arg_max(c.customer_state, o.k_time) AS customer_state,
      arg_max(c.customer_city, o.k_time) AS customer_city, COUNT(DISTINCT o.order_id) AS frequency,
      {dbl('SUM(v.t)')} AS monetary, {mean('v.t', 2)} AS avg_ticket,
      date_diff('day', MAX(o.order_purchase_timestamp), {AS_OF_SQL}) AS recency_days
    FROM s_customers c
      JOIN (SELECT *, CAST(order_purchase_timestamp AS VARCHAR) || ' ' || order_id AS k_time FROM s_orders
            WHERE order_status = 'delivered') o ON c.customer_id = o.customer_id
      JOIN (SELECT order_id, CAST(SUM(total_item_value) AS DECIMAL(20,2)) AS t FROM s_items GROUP BY 1) v
        ON o.order_id = v.order_id
    GROUP BY 1""")
def _(b):
    return gold.dim_clientes_rfm(b.orders, b.customers, b.items, AS_OF, by_person=True).drop(
        "first_purchase", "last_purchase", "rfm_segment"
    )


PRODUCT_MART_SQL = f"""product_id, product_category, {dbl('product_weight_kg')} AS product_weight_kg, total_orders,
    {dbl('total_revenue')} AS total_revenue, avg_price, {txt('last_sale_date')} AS last_sale_date,
    days_since_last_sale, avg_review_score, total_reviews, negative_review_rate, product_status"""


@check("GD4_dim_produtos_performance", f"SELECT {PRODUCT_MART_SQL} FROM g_products")
def _(b):
    return b.product_mart


@check("GD5_dim_sellers_score", "SELECT * FROM g_sellers")
def _(b):
    return b.seller_mart


@check("GD5_seller_metrics_by_order", f"""
    SELECT seller_id, COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
      COUNT(*) FILTER (WHERE order_status = 'canceled') AS canceled_orders,
      COUNT(*) FILTER (WHERE status_entrega = 'no_prazo') AS on_time_orders,
      {mean('delta_entrega_dias', 2, 0)} AS avg_delivery_delta
    FROM (SELECT DISTINCT i.seller_id, o.order_id, o.order_status, o.status_entrega, o.delta_entrega_dias
          FROM s_items i JOIN s_orders o ON i.order_id = o.order_id) GROUP BY 1""")
def _(b):
    return gold.seller_metrics(b.items, b.orders, order_grain=True)


FACT_SQL = f"""{txt('data_venda')} AS data_venda, total_pedidos, total_clientes, {dbl('gmv')} AS gmv, ticket_medio,
    {dbl('total_frete')} AS total_frete"""


@check("GF1_fato_vendas_diarias", f"SELECT {FACT_SQL} FROM g_fact")
def _(b):
    return b.fact


FEATURES_SQL = f"""order_id, customer_id, label, tempo_aprovacao_seg, tempo_postagem_seg, {dbl('total_pago')} AS total_pago,
    max_parcelas, pag_cartao, pag_boleto, customer_state, {dbl('total_itens_valor')} AS total_itens_valor,
    {dbl('total_frete')} AS total_frete, peso_medio_kg, volume_medio_cm3, qtd_itens, seller_state, delta_entrega_dias,
    status_entrega, order_status"""


@check("GF2_features_ml", f"SELECT {FEATURES_SQL} FROM g_features")
def _(b):
    return b.features


# ---- stakeholder marts --------------------------------------------------------------------------------------------

@check("GF3_fato_vendas", f"""
    SELECT i.order_id, i.order_item_id, CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS BIGINT) AS date_key,
      o.customer_unique_id AS customer_key, i.product_id AS product_key, i.seller_id AS seller_key,
      o.customer_zip_code AS location_key, o.metodo_pagamento_principal AS payment_type, {dbl('i.price')} AS price,
      {dbl('i.freight_value')} AS freight_value, {dbl('i.total_item_value')} AS total_item_value, r.review_score,
      o.delta_entrega_dias, o.status_entrega
    FROM s_items_enriched i JOIN s_orders_enriched o ON i.order_id = o.order_id
      LEFT JOIN s_scores r ON i.order_id = r.order_id""")
def _(b):
    return requirements.fato_vendas(b.orders_enriched, b.items_enriched, b.scores)


@check("GF3_dim_pagamento", """
    SELECT DISTINCT payment_type, payment_group,
      CASE payment_type WHEN 'credit_card' THEN 'Cartão de Crédito' WHEN 'debit_card' THEN 'Cartão de Débito'
        WHEN 'boleto' THEN 'Boleto' WHEN 'voucher' THEN 'Voucher' WHEN 'not_defined' THEN 'Not Defined' END AS descricao
    FROM s_payments""")
def _(b):
    return requirements.dim_pagamento(b.payments)


@check("GF4_gmv_categoria_estado", f"""
    SELECT {txt('CAST(o.order_purchase_timestamp AS DATE)')} AS data_venda, i.product_category, o.customer_state,
      {dbl('SUM(i.total_item_value)')} AS gmv, COUNT(DISTINCT o.order_id) AS total_pedidos, COUNT(*) AS volume,
      {mean('i.total_item_value', 2)} AS ticket_medio
    FROM s_items_enriched i JOIN s_orders_enriched o ON i.order_id = o.order_id WHERE o.order_status IN {SALES}
    GROUP BY 1, 2, 3""")
def _(b):
    return requirements.gmv_categoria_estado(b.orders_enriched, b.items_enriched)


@check("GF5_serie_horaria", f"""
    WITH span AS (SELECT CAST(MIN(order_purchase_timestamp) AS DATE) AS a, CAST(MAX(order_purchase_timestamp) AS DATE)
                    AS z FROM s_orders),
    grid AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP) + INTERVAL 23 HOUR,
               INTERVAL 1 HOUR)) AS hora FROM span),
    counted AS (SELECT date_trunc('hour', order_purchase_timestamp) AS hora, COUNT(*) AS n FROM s_orders GROUP BY 1)
    SELECT {txt('g.hora')} AS hora, coalesce(n, 0) AS pedidos, extract(dow FROM g.hora) AS dia_semana_num,
      extract(dow FROM g.hora) IN (0, 6) AS is_fim_de_semana,
      CAST(g.hora AS DATE) IN (DATE '1999-12-25', DATE '2000-12-25') AS is_feriado
    FROM grid g LEFT JOIN counted c ON g.hora = c.hora""")
def _(b):
    from datetime import date

    return requirements.serie_horaria(b.orders, [date(1999, 12, 25), date(2000, 12, 25)])


@check("GF6_features_fraude", f"""
    WITH base AS (SELECT *, CAST(order_purchase_timestamp AS DATE) AS dia FROM s_orders_enriched
                  WHERE customer_unique_id IS NOT NULL),
    daily AS (SELECT customer_unique_id, dia, COUNT(*) AS n, SUM(CAST(total_pago * 100 AS HUGEINT)) AS cents,
                COUNT(total_pago) AS paid FROM base GROUP BY 1, 2),
    win AS (SELECT *, MIN(dia) OVER (PARTITION BY customer_unique_id) AS first_day,
              SUM(cents) OVER w AS cents30, SUM(paid) OVER w AS paid30 FROM daily
            WINDOW w AS (PARTITION BY customer_unique_id ORDER BY dia
              RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)),
    home AS (SELECT customer_unique_id, arg_min(customer_zip_code, customer_id) AS zip FROM s_customers GROUP BY 1)
    SELECT b.order_id, b.customer_unique_id, date_diff('day', w.first_day, b.dia) AS customer_age_days,
      coalesce(b.customer_zip_code = h.zip, FALSE) AS payment_zip_vs_customer_zip_match, w.n AS daily_purchase_count,
      {half_up('w.cents30', '(w.paid30 * 100)', 2)} AS avg_payment_value_30d
    FROM base b JOIN win w ON b.customer_unique_id = w.customer_unique_id AND b.dia = w.dia
      LEFT JOIN home h ON b.customer_unique_id = h.customer_unique_id""")
def _(b):
    return requirements.features_fraude(b.orders_enriched, b.customers)


@check("GF7_features_churn", f"""
    WITH base AS (SELECT o.*, r.review_score, r.tempo_resposta_seg,
                    CAST(o.order_purchase_timestamp AS VARCHAR) || ' ' || o.order_id AS k_time
                  FROM s_orders_enriched o LEFT JOIN s_scores r ON o.order_id = r.order_id
                  WHERE o.customer_unique_id IS NOT NULL),
    cats AS (SELECT b.customer_unique_id, i.product_category, COUNT(*) AS n
             FROM s_items_enriched i JOIN s_orders_enriched b ON i.order_id = b.order_id
             WHERE i.product_category IS NOT NULL GROUP BY 1, 2),
    fav AS (SELECT customer_unique_id, product_category FROM (
              SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, product_category) AS rn
              FROM cats) WHERE rn = 1)
    SELECT b.customer_unique_id, COUNT(*) AS total_pedidos,
      date_diff('day', MAX(b.order_purchase_timestamp), {AS_OF_SQL}) AS recency_days,
      {dbl('coalesce(SUM(b.total_pago), 0)')} AS total_gasto, {mean('b.review_score', 2, 0)} AS avg_review_score,
      {mean('b.tempo_resposta_seg', 0, 0)} AS tempo_resposta_medio_seg,
      COUNT(*) FILTER (WHERE b.status_entrega = 'atrasado') AS pedidos_atrasados,
      arg_max_null(b.delta_entrega_dias, b.k_time) AS ultimo_delta_entrega,
      MAX(f.product_category) AS categoria_preferida
    FROM base b LEFT JOIN fav f ON b.customer_unique_id = f.customer_unique_id GROUP BY 1""")
def _(b):
    return requirements.features_churn(b.orders_enriched, b.items_enriched, b.scores, AS_OF)


@check("GF8_penetracao_estado", f"""
    WITH people AS (SELECT customer_state, customer_city, COUNT(DISTINCT customer_unique_id) AS clientes
                    FROM s_customers GROUP BY 1, 2),
    sales AS (SELECT customer_state, customer_city, coalesce(SUM(total_pago), 0) AS gmv, COUNT(*) AS pedidos
              FROM s_orders_enriched WHERE order_status IN {SALES} GROUP BY 1, 2),
    geo AS (SELECT geolocation_state AS customer_state, geolocation_city AS customer_city,
              COUNT(DISTINCT geolocation_zip_code_prefix) AS ceps, SUM(num_registros) AS pontos
            FROM s_geolocation GROUP BY 1, 2)
    SELECT p.customer_state, p.customer_city, p.clientes, {dbl('coalesce(s.gmv, 0)')} AS gmv,
      coalesce(s.pedidos, 0) AS pedidos, coalesce(g.ceps, 0) AS ceps, CAST(coalesce(g.pontos, 0) AS BIGINT) AS pontos,
      {half_up('p.clientes', 'g.ceps', 2)} AS clientes_por_cep
    FROM people p LEFT JOIN sales s USING (customer_state, customer_city)
      LEFT JOIN geo g USING (customer_state, customer_city)""")
def _(b):
    return requirements.penetracao_estado(b.customers, b.orders_enriched, b.geolocation)


CAUSE_SQL = """CASE WHEN regexp_matches(lower(review_message), '(atras|demor|prazo|late|delay|nunca cheg|não cheg)')
      THEN 'atraso'
    WHEN regexp_matches(lower(review_message), '(diferente|errad|trocad|wrong|different)') THEN 'produto_diferente'
    WHEN regexp_matches(lower(review_message), '(defeit|quebrad|danific|broken|defect)') THEN 'defeito'
    WHEN regexp_matches(lower(review_message), '(falt|incomplet|missing|parcial)') THEN 'incompleto' ELSE 'outro' END"""


@check("GF9_causa_reviews", f"""
    SELECT {CAUSE_SQL} AS causa, o.status_entrega, COUNT(*) AS total,
      {mean('o.delta_entrega_dias', 1, 0)} AS delta_medio_dias, {mean('r.review_score', 2, 0)} AS score_medio
    FROM s_reviews r JOIN s_orders o ON r.order_id = o.order_id WHERE r.review_score <= 2 GROUP BY 1, 2""")
def _(b):
    return requirements.causa_reviews(b.reviews, b.orders)


@check("GF10_fato_logistica", f"""
    SELECT i.seller_id, i.seller_state, i.product_category, COUNT(*) AS itens,
      {mean('o.delta_entrega_dias', 2, 0)} AS delta_medio_dias,
      {half_up('SUM(o.tempo_total_seg)', '(COUNT(o.tempo_total_seg) * 86400)', 2)} AS lead_time_medio_dias,
      MAX(o.delta_entrega_dias) AS delta_max_dias, {pct_where("o.status_entrega = 'no_prazo'", 2)} AS pct_no_prazo
    FROM s_items_enriched i JOIN s_orders_enriched o ON i.order_id = o.order_id
    WHERE o.tempo_total_seg IS NOT NULL GROUP BY 1, 2, 3""")
def _(b):
    return requirements.fato_logistica(b.orders_enriched, b.items_enriched)


@check("GF10_sla_lead_time_quantiles")
def _(b):
    report = requirements.lead_time_quantiles(b.orders_enriched)
    return report.withColumn("quantis_seg", F.array_join(F.col("quantis_seg").cast("array<string>"), ","))


@check("GF11_fato_pagamentos", f"""
    SELECT {txt('CAST(o.order_purchase_timestamp AS DATE)')} AS data, p.payment_type, p.payment_group,
      COUNT(*) AS pagamentos, {dbl('SUM(p.payment_value)')} AS valor_total,
      {mean('p.payment_installments', 2, 0)} AS parcelas_media
    FROM s_payments p JOIN s_orders o ON p.order_id = o.order_id GROUP BY 1, 2, 3""")
def _(b):
    return requirements.fato_pagamentos(b.orders, b.payments)


@check("GF11_fato_receita_por_produto", f"""
    SELECT i.product_id, COUNT(*) AS itens, {dbl('SUM(i.total_item_value)')} AS receita,
      {dbl('SUM(i.freight_value)')} AS frete
    FROM s_items i JOIN s_orders o ON i.order_id = o.order_id WHERE o.order_status IN {SALES} GROUP BY 1""")
def _(b):
    return requirements.receita_por_produto(b.orders, b.items)


@check("GF12_produtos_90d", f"""
    SELECT product_id, {dbl(f"coalesce(SUM(total_item_value) FILTER (WHERE sale AND age BETWEEN 0 AND 90), 0)")}
        AS total_revenue_90d, {pct_where("order_status = 'canceled'", 2)} AS return_rate,
      MIN(age) FILTER (WHERE sale) AS days_since_last_sale
    FROM (SELECT i.product_id, i.total_item_value, o.order_status, o.order_status IN {SALES} AS sale,
            date_diff('day', o.order_purchase_timestamp, {AS_OF_SQL}) AS age
          FROM s_items i JOIN s_orders o ON i.order_id = o.order_id) GROUP BY 1""")
def _(b):
    return requirements.produtos_90d(b.orders, b.items, AS_OF)
