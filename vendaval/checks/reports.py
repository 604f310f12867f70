"""Report queries: RP1-RP20, US1-US8."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports, usage
from .joins import PERSON_SEGMENT
from .oracle import USAGE_CATEGORY, dbl, half_up, mean, pct_where, txt
from .registry import check
from .tables import FACT_SQL, RFM_SQL


def _share(table: str) -> str:
    return half_up("(COUNT(*) * 100)", f"(SELECT COUNT(*) FROM {table})", 1)


# Values that are already rounded to two digits are averaged again as hundredths.
def mean2(column: str, digits: int) -> str:
    return mean(f"CAST({column} AS DECIMAL(18,2))", digits)


@check("RP1_executive_kpis", f"""
    SELECT {dbl('SUM(gmv)')} AS gmv_total, CAST(SUM(total_pedidos) AS BIGINT) AS pedidos_total,
      {half_up('CAST(SUM(gmv) * 100 AS HUGEINT)', '(SUM(total_pedidos) * 100)', 2)} AS ticket_medio_geral,
      {dbl('SUM(total_frete)')} AS frete_total, CAST(SUM(total_clientes) AS BIGINT) AS clientes_total,
      COUNT(DISTINCT data_venda) AS dias_operacao FROM g_fact""")
def _(b):
    return reports.executive_kpis(b.fact)


_W7 = "OVER (ORDER BY data_venda ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@check("RP2_daily_gmv_trend", f"""
    SELECT {txt('data_venda')} AS data_venda, {dbl('gmv')} AS gmv, total_pedidos, ticket_medio, {dbl('total_frete')}
      AS total_frete,
      {half_up(f'(SUM(CAST(gmv * 100 AS HUGEINT)) {_W7})', f'((COUNT(gmv) {_W7}) * 100)', 4)} AS gmv_media_7d,
      {half_up(f'(SUM(total_pedidos) {_W7})', f'(COUNT(total_pedidos) {_W7})', 4)} AS pedidos_media_7d FROM g_fact""")
def _(b):
    return reports.daily_gmv_trend(b.fact)


@check("RP3_rfm_distribution", f"""
    SELECT rfm_segment, COUNT(*) AS total_clientes, {_share('g_rfm')} AS pct,
      {mean2('monetary', 2)} AS monetary_medio, {mean('frequency', 2, 0)} AS frequency_media,
      {mean('recency_days', 0, 0)} AS recency_media, {mean2('avg_ticket', 2)} AS ticket_medio FROM g_rfm GROUP BY 1""")
def _(b):
    return reports.rfm_distribution(b.rfm)


@check("RP4_customers_by_state", f"""
    SELECT customer_state, COUNT(*) AS total_clientes, {dbl('SUM(monetary)')} AS monetary_total,
      {mean2('monetary', 2)} AS monetary_medio, {mean('frequency', 2, 0)} AS frequency_media FROM g_rfm GROUP BY 1""")
def _(b):
    return reports.customers_by_state(b.rfm)


@check("RP5_retention_targets", f"""
    SELECT rfm_segment, customer_state, COUNT(*) AS total, {mean2('monetary', 2)} AS monetary_medio,
      {mean('recency_days', 0, 0)} AS recency_media FROM g_rfm
    WHERE rfm_segment IN ('At Risk', 'Lost') AND monetary > 200 GROUP BY 1, 2
    ORDER BY monetary_medio DESC, rfm_segment, customer_state LIMIT 15""")
def _(b):
    return reports.retention_targets(b.rfm)


@check("RP6_seller_tier_distribution", f"""
    SELECT seller_tier, COUNT(*) AS total_sellers, {_share('g_sellers')} AS pct,
      {mean2('seller_score', 2)} AS score_medio, {mean2('avg_review_score', 2)} AS review_medio,
      {mean2('on_time_rate', 1)} AS on_time_medio, {mean2('cancel_rate', 2)} AS cancel_medio,
      CAST(SUM(total_orders) AS BIGINT) AS pedidos_total FROM g_sellers GROUP BY 1""")
def _(b):
    return reports.seller_tier_distribution(b.seller_mart)


# The synthetic sellers score alike, so the list is taken from a tier that has members; the default is 'Critico'.
@check("RP7_critical_sellers", f"""
    SELECT seller_id, seller_state, total_orders, seller_score, seller_tier, avg_review_score AS avg_review,
      negative_reviews, {half_up('CAST(CAST(on_time_rate AS DECIMAL(18,2)) * 100 AS HUGEINT)', '100', 1)} AS on_time_pct,
      cancel_rate AS cancel_pct FROM g_sellers WHERE seller_tier = 'Regular' AND total_orders >= 10
    ORDER BY seller_score, seller_id LIMIT 15""")
def _(b):
    return reports.critical_sellers(b.seller_mart, tier="Regular")


@check("RP8_seller_score_points", """
    SELECT seller_id, seller_state, seller_score, total_orders, avg_review_score, seller_tier FROM g_sellers
    WHERE total_orders >= 5""")
def _(b):
    return reports.seller_score_points(b.seller_mart)


@check("RP9_product_status_distribution", f"""
    SELECT product_status, COUNT(*) AS total_produtos, {_share('g_products')} AS pct,
      {dbl('SUM(total_revenue)')} AS revenue_total, {mean2('avg_review_score', 2)} AS review_medio,
      {mean2('negative_review_rate', 1)} AS neg_review_pct_media FROM g_products GROUP BY 1""")
def _(b):
    return reports.product_status_distribution(b.product_mart)


@check("RP10_top_categories", f"""
    SELECT product_category, COUNT(*) AS total_produtos, CAST(SUM(total_orders) AS BIGINT) AS pedidos_total,
      {dbl('SUM(total_revenue)')} AS revenue_total, {mean2('avg_review_score', 2)} AS review_medio
    FROM g_products GROUP BY 1 ORDER BY SUM(total_revenue) DESC, product_category NULLS LAST LIMIT 10""")
def _(b):
    return reports.top_categories(b.product_mart)


@check("RP11_idle_products", f"""
    SELECT product_id, product_category, total_orders, {dbl('total_revenue')} AS total_revenue, avg_review_score,
      days_since_last_sale, product_status FROM g_products
    WHERE product_status = 'Inativo' AND total_revenue > 500 ORDER BY g_products.total_revenue DESC, product_id LIMIT 15""")
def _(b):
    return reports.idle_products(b.product_mart)


_HIGH = "risco_atraso = 'alto'"


@check("RP12_prediction_kpis", f"""
    SELECT modelo_versao, COUNT(*) AS total_scored, COUNT(*) FILTER (WHERE {_HIGH}) AS risco_alto,
      {pct_where(_HIGH)} AS pct_risco_alto, round(avg(probabilidade_falha), 4) AS prob_media,
      {pct_where('predicao_atraso = label')} AS accuracy_pct FROM g_predictions GROUP BY 1""")
def _(b):
    return reports.prediction_kpis(b.predictions)


@check("RP13_probability_histogram", f"""
    SELECT round(floor(probabilidade_falha * 20) / 20.0, 2) AS faixa_prob, COUNT(*) AS total_pedidos,
      COUNT(*) FILTER (WHERE label = 1) AS realmente_atrasados, {mean('total_pago', 2)} AS ticket_medio
    FROM g_predictions GROUP BY 1""")
def _(b):
    return reports.probability_histogram(b.predictions)


@check("RP14_risk_distribution", f"""
    SELECT risco_atraso, COUNT(*) AS total_pedidos, {_share('g_predictions')} AS pct,
      COUNT(*) FILTER (WHERE label = 1) AS realmente_atrasados, {pct_where('label = 1')} AS taxa_atraso_real_pct,
      round(avg(probabilidade_falha), 4) AS prob_media, {dbl('SUM(total_pago)')} AS valor_total_em_risco
    FROM g_predictions GROUP BY 1""")
def _(b):
    return reports.risk_distribution(b.predictions)


@check("RP15_risk_by_state", f"""
    SELECT customer_state, COUNT(*) AS total_pedidos, COUNT(*) FILTER (WHERE {_HIGH}) AS risco_alto,
      {pct_where(_HIGH)} AS pct_risco_alto, round(avg(probabilidade_falha), 4) AS prob_media
    FROM g_predictions GROUP BY 1 HAVING COUNT(*) >= 50""")
def _(b):
    return reports.risk_by_state(b.predictions)


@check("RP16_alert_list", f"""
    SELECT order_id, customer_state, seller_state, {dbl('total_pago')} AS total_pago, qtd_itens,
      {half_up('CAST(CAST(peso_medio_kg AS DECIMAL(12,4)) * 10000 AS HUGEINT)', '10000', 2)} AS peso_kg,
      round(probabilidade_falha, 4) AS probabilidade_falha, risco_atraso, predicao_atraso, label AS atraso_real
    FROM g_predictions ORDER BY g_predictions.probabilidade_falha DESC, order_id LIMIT 20""")
def _(b):
    return reports.alert_list(b.predictions)


_JOINED = f"""g_predictions p LEFT JOIN s_orders_enriched o ON p.order_id = o.order_id
    LEFT JOIN {PERSON_SEGMENT} s ON o.customer_unique_id = s.customer_unique_id"""


@check("RP17_risk_by_segment", f"""
    SELECT s.rfm_segment, p.risco_atraso, COUNT(*) AS total_pedidos, round(avg(p.probabilidade_falha), 4) AS prob_media,
      {mean('p.total_pago', 2)} AS ticket_medio FROM {_JOINED} GROUP BY 1, 2""")
def _(b):
    return reports.risk_by_segment(b.predictions, b.orders_enriched, b.rfm)


@check("RP18_prescriptive_list", f"""
    SELECT p.order_id, p.customer_state, p.seller_state, {dbl('p.total_pago')} AS total_pago, p.probabilidade_falha,
      p.risco_atraso, s.rfm_segment FROM {_JOINED} WHERE p.{_HIGH}""")
def _(b):
    return reports.prescriptive_list(b.predictions, b.orders_enriched, b.rfm)


@check("RP18_risk_band_kpis", f"""
    SELECT risco_atraso, COUNT(*) AS total_pedidos, round(avg(probabilidade_falha), 3) AS prob_media,
      {mean('total_pago', 2)} AS ticket_medio, COUNT(*) FILTER (WHERE label = 1) AS realmente_atrasados,
      {pct_where('label = 1')} AS taxa_atraso_real_pct FROM g_predictions GROUP BY 1""")
def _(b):
    return reports.risk_band_kpis(b.predictions)


@check("RP19_comment_coverage", f"""
    SELECT COUNT(*) AS total_reviews, COUNT(*) FILTER (WHERE review_message <> '') AS com_comentario,
      {pct_where("review_message <> ''")} AS pct_com_comentario FROM s_reviews""")
def _(b):
    return reports.comment_coverage(b.reviews)


@check("RP19_commented_score_share", f"""
    WITH said AS (SELECT * FROM s_reviews WHERE review_message <> '')
    SELECT review_score, COUNT(*) AS total, {_share('said')} AS pct FROM said GROUP BY 1""")
def _(b):
    return reports.commented_score_share(b.reviews)


@check("RP20_serving_vendas_diarias", f"SELECT {FACT_SQL} FROM g_fact")
def _(b):
    return reports.serving_dataset(b.fact, "vendas_diarias")


@check("RP20_serving_clientes_rfm", f"SELECT {RFM_SQL} FROM g_rfm")
def _(b):
    return reports.serving_dataset(b.rfm, "clientes_rfm")


@check("RP20_serving_sellers_score", """
    SELECT seller_id, seller_city, seller_state, total_orders, delivered_orders, canceled_orders, avg_review_score,
      on_time_rate, cancel_rate, seller_score, seller_tier FROM g_sellers""")
def _(b):
    return reports.serving_dataset(b.seller_mart, "sellers_score")


@check("RP20_serving_produtos_performance", f"""
    SELECT product_id, product_category, total_orders, {dbl('total_revenue')} AS total_revenue, avg_price,
      days_since_last_sale, avg_review_score, total_reviews, negative_review_rate, product_status FROM g_products""")
def _(b):
    return reports.serving_dataset(b.product_mart, "produtos_performance")


@check("RP20_serving_predicoes", f"""
    SELECT order_id, customer_id, customer_state, seller_state, {dbl('total_pago')} AS total_pago,
      {dbl('total_frete')} AS total_frete, qtd_itens, peso_medio_kg, label, predicao_atraso, probabilidade_falha,
      risco_atraso, modelo_versao, scored_at FROM g_predictions""")
def _(b):
    return reports.serving_dataset(b.predictions, "predicoes")


# ---- usage ----------------------------------------------------------------------------------------------------------

_TOTAL = dbl("SUM(usage_quantity)")
_RANGE = f"{txt('MIN(usage_date)')} AS primeiro_uso, {txt('MAX(usage_date)')} AS ultimo_uso"


@check("US1_usage_by_sku", f"""
    SELECT sku_name, billing_origin_product, {_TOTAL} AS total_dbus, COUNT(DISTINCT usage_date) AS dias_com_uso, {_RANGE}
    FROM u_usage WHERE usage_date >= DATE '2024-01-05' GROUP BY 1, 2""")
def _(b):
    return usage.usage_by_sku(usage.since(b.usage, "2024-01-05"))


_PICKS = {
    "dlt": "lower(sku_name) LIKE '%dlt%' OR lower(sku_name) LIKE '%delta_live%' OR lower(sku_name) LIKE '%pipelines%' "
           "OR lower(billing_origin_product) LIKE '%dlt%' OR lower(billing_origin_product) LIKE '%pipelines%'",
    "ml": "lower(sku_name) LIKE '%serving%' OR lower(sku_name) LIKE '%model%' OR lower(sku_name) LIKE '%inference%' "
          "OR lower(sku_name) LIKE '%ml%' OR lower(billing_origin_product) LIKE '%serving%' "
          "OR lower(billing_origin_product) LIKE '%model%'",
    "notebook": "(lower(sku_name) LIKE '%serverless%compute%' OR lower(sku_name) LIKE '%interactive%' "
                "OR lower(sku_name) LIKE '%notebook%') AND lower(sku_name) NOT LIKE '%sql%' "
                "AND lower(sku_name) NOT LIKE '%dlt%'",
    "sql": "lower(sku_name) LIKE '%sql%' OR lower(sku_name) LIKE '%warehouse%'",
}
_KEYS = {
    "dlt": "sku_name, cluster_id, job_id", "ml": "sku_name, billing_origin_product, cluster_id",
    "notebook": "sku_name, cluster_id", "sql": "sku_name, warehouse_id",
}
for _kind, _pick in _PICKS.items():
    check(f"US2_workload_usage_{_kind}", f"""
        SELECT {_KEYS[_kind]}, {_TOTAL} AS total_dbus, COUNT(*) AS registros_billing, {_RANGE} FROM u_usage
        WHERE {_pick} GROUP BY {_KEYS[_kind]}""")(lambda b, k=_kind: usage.workload_usage(b.usage, k))

_SERIES = {
    "dlt": "lower(sku_name) LIKE '%dlt%' OR lower(sku_name) LIKE '%pipelines%' "
           "OR lower(billing_origin_product) LIKE '%dlt%'",
    "ml": "lower(sku_name) LIKE '%serving%' OR lower(sku_name) LIKE '%model%' OR lower(sku_name) LIKE '%inference%' "
          "OR lower(billing_origin_product) LIKE '%serving%'",
}
for _kind, _pick in _SERIES.items():
    check(f"US3_workload_series_{_kind}", f"""
        SELECT {txt('usage_date')} AS usage_date, sku_name, {_TOTAL} AS dbus_dia FROM u_usage WHERE {_pick}
        GROUP BY 1, 2""")(lambda b, k=_kind: usage.workload_series(b.usage, k))


@check("US4_usage_by_day_category", f"""
    SELECT {txt('usage_date')} AS usage_date, {USAGE_CATEGORY} AS categoria_workload, {_TOTAL} AS dbus_dia FROM u_usage
    GROUP BY 1, 2""")
def _(b):
    return usage.usage_by_day_category(b.usage)


_SHARE = half_up("SUM(CAST(usage_quantity * 1000000 AS HUGEINT))",
                 "(SELECT SUM(CAST(usage_quantity * 10000 AS HUGEINT)) FROM u_usage)", 1)


@check("US4_category_totals", f"""
    SELECT {USAGE_CATEGORY} AS categoria_workload, {_TOTAL} AS total_dbus, {_SHARE} AS pct_total,
      COUNT(DISTINCT usage_date) AS dias_com_uso FROM u_usage GROUP BY 1""")
def _(b):
    return usage.category_totals(b.usage)


@check("US5_estimated_cost", f"""
    SELECT u.sku_name, {USAGE_CATEGORY.replace('sku_name', 'u.sku_name')} AS categoria, {dbl('SUM(u.usage_quantity)')}
      AS total_dbus, {dbl('p.preco')} AS preco_por_dbu,
      CAST(CAST(SUM(u.usage_quantity)::DECIMAL(20,4) * p.preco AS DECIMAL(28,2)) AS DOUBLE) AS custo_estimado_usd
    FROM u_usage u LEFT JOIN u_prices p ON u.sku_name = p.sku_name
      AND u.usage_date BETWEEN p.price_start_time AND coalesce(p.price_end_time, DATE '2099-12-31')
    GROUP BY 1, 2, p.preco""")
def _(b):
    return usage.estimated_cost(b.usage, b.prices)


@check("US6_event_listing", f"""
    SELECT event_id, pipeline_name, event_type, level, {txt('"timestamp"')} AS timestamp FROM u_events
    WHERE pipeline_name LIKE '%flow_1%' ORDER BY u_events."timestamp" DESC, event_id LIMIT 30""")
def _(b):
    return usage.event_listing(b.pipeline_events, "%flow_1%")


@check("US6_event_summary", f"""
    SELECT pipeline_name, event_type, level, COUNT(*) AS total_eventos, {txt('MIN("timestamp")')} AS primeiro_evento,
      {txt('MAX("timestamp")')} AS ultimo_evento FROM u_events WHERE pipeline_name LIKE '%flow%' GROUP BY 1, 2, 3""")
def _(b):
    return usage.event_summary(b.pipeline_events, "%flow%")


@check("US7_usage_overview", f"""
    SELECT {_TOTAL} AS total_dbus, COUNT(DISTINCT usage_date) AS dias_com_uso,
      {half_up('SUM(CAST(usage_quantity * 10000 AS HUGEINT))', '(COUNT(DISTINCT usage_date) * 10000)', 2)} AS media_diaria
    FROM u_usage""")
def _(b):
    return usage.usage_overview(b.usage)


@check("US7_category_summary", f"""
    SELECT {USAGE_CATEGORY} AS categoria, {_TOTAL} AS total, {_SHARE} AS pct FROM u_usage GROUP BY 1""")
def _(b):
    return usage.category_summary(b.usage)


@check("US7_sku_summary", f"SELECT sku_name, {_TOTAL} AS total FROM u_usage GROUP BY 1")
def _(b):
    return usage.sku_summary(b.usage)


@check("US8_active_resources", f"""
    SELECT 'c' || CAST(user_id AS VARCHAR) AS cluster_id, {txt('MIN(ts)')} AS create_time FROM events GROUP BY user_id
    HAVING COUNT(*) FILTER (WHERE event_type = 'error') <= 15""")
def _(b):
    # A resource is a user of the event table; one with many errors counts as deleted at its last error.
    errors = F.col("event_type") == "error"
    resources = b.table("events").groupBy("user_id").agg(
        F.min("ts").alias("create_time"), F.count_if(errors).alias("_n"), F.max(F.when(errors, F.col("ts"))).alias("_last")
    )
    return usage.active_resources(resources.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("cluster_id"), "create_time",
        F.when(F.col("_n") > 15, F.col("_last")).alias("delete_time"),
    ))
