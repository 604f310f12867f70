"""Report queries over the marts. Orderings end in a unique key, so every limit has one answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates, joins
from ..operators.windows import moving_average, share_of_total, top_k

TWO = "decimal(22,2)"


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _sum(column: str, name: str) -> Column:
    return F.sum(column).cast(TWO).alias(name)


def _mean(column: str, digits: int, name: str) -> Column:
    return S.mean_of(column, digits).alias(name)


def executive_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        _sum("gmv", "gmv_total"),
        F.sum("total_pedidos").alias("pedidos_total"),
        S.ratio(F.sum("gmv"), F.sum("total_pedidos"), 2).alias("ticket_medio_geral"),
        _sum("total_frete", "frete_total"),
        F.sum("total_clientes").alias("clientes_total"),
        F.count_distinct("data_venda").alias("dias_operacao"),
    )


def daily_gmv_trend(fact: DataFrame) -> DataFrame:
    """Daily sales with seven-day means. The fact has one row per calendar day, which bounds the ordered window."""
    means = {"gmv_media_7d": "gmv", "pedidos_media_7d": "total_pedidos"}
    trend = moving_average(fact, "data_venda", means, 7)
    columns = ["data_venda", "gmv", "total_pedidos", "ticket_medio", "total_frete", *means]
    return trend.select(*columns).orderBy("data_venda")


def rfm_distribution(rfm: DataFrame) -> DataFrame:
    grouped = rfm.groupBy("rfm_segment").agg(
        _rows("total_clientes"),
        _mean("monetary", 2, "monetary_medio"),
        _mean("frequency", 2, "frequency_media"),
        _mean("recency_days", 0, "recency_media"),
        _mean("avg_ticket", 2, "ticket_medio"),
    )
    return share_of_total(grouped, "total_clientes", few=True).orderBy(F.desc("total_clientes"), "rfm_segment")


def customers_by_state(rfm: DataFrame) -> DataFrame:
    grouped = rfm.groupBy("customer_state").agg(
        _rows("total_clientes"), _sum("monetary", "monetary_total"), _mean("monetary", 2, "monetary_medio"),
        _mean("frequency", 2, "frequency_media"),
    )
    return grouped.orderBy(F.desc("total_clientes"), "customer_state")


def retention_targets(rfm: DataFrame, least_value: float = 200, k: int = 15) -> DataFrame:
    """Valuable customers that are slipping away, by segment and state."""
    leaving = rfm.where(F.col("rfm_segment").isin("At Risk", "Lost") & (F.col("monetary") > least_value))
    grouped = leaving.groupBy("rfm_segment", "customer_state").agg(
        _rows("total"), _mean("monetary", 2, "monetary_medio"), _mean("recency_days", 0, "recency_media")
    )
    return top_k(grouped, [F.desc("monetary_medio"), "rfm_segment", "customer_state"], k)


def seller_tier_distribution(sellers: DataFrame) -> DataFrame:
    grouped = sellers.groupBy("seller_tier").agg(
        _rows("total_sellers"),
        _mean("seller_score", 2, "score_medio"),
        _mean("avg_review_score", 2, "review_medio"),
        _mean("on_time_rate", 1, "on_time_medio"),
        _mean("cancel_rate", 2, "cancel_medio"),
        F.sum("total_orders").alias("pedidos_total"),
    )
    return share_of_total(grouped, "total_sellers", few=True).orderBy(F.desc("score_medio"), "seller_tier")


def critical_sellers(sellers: DataFrame, tier: str = "Critico", least_orders: int = 10, k: int = 15) -> DataFrame:
    chosen = sellers.where((F.col("seller_tier") == tier) & (F.col("total_orders") >= least_orders))
    shown = chosen.select(
        "seller_id", "seller_state", "total_orders", "seller_score", "seller_tier",
        F.col("avg_review_score").alias("avg_review"), "negative_reviews",
        F.round("on_time_rate", 1).alias("on_time_pct"), F.col("cancel_rate").alias("cancel_pct"),
    )
    return top_k(shown, [F.asc("seller_score"), "seller_id"], k)


def seller_score_points(sellers: DataFrame, least_orders: int = 5) -> DataFrame:
    return sellers.where(F.col("total_orders") >= least_orders).select(
        "seller_id", "seller_state", "seller_score", "total_orders", "avg_review_score", "seller_tier"
    )


def product_status_distribution(products: DataFrame) -> DataFrame:
    grouped = products.groupBy("product_status").agg(
        _rows("total_produtos"),
        _sum("total_revenue", "revenue_total"),
        _mean("avg_review_score", 2, "review_medio"),
        _mean("negative_review_rate", 1, "neg_review_pct_media"),
    )
    return share_of_total(grouped, "total_produtos", few=True).orderBy(F.desc("total_produtos"), "product_status")


def top_categories(products: DataFrame, k: int = 10) -> DataFrame:
    grouped = products.groupBy("product_category").agg(
        _rows("total_produtos"), F.sum("total_orders").alias("pedidos_total"), _sum("total_revenue", "revenue_total"),
        _mean("avg_review_score", 2, "review_medio"),
    )
    return top_k(grouped, [F.desc("revenue_total"), F.asc_nulls_last("product_category")], k)


def idle_products(
    products: DataFrame, status: str = "Inativo", least_revenue: float = 500, k: int = 15
) -> DataFrame:
    idle = products.where((F.col("product_status") == status) & (F.col("total_revenue") > least_revenue))
    shown = idle.select(
        "product_id", "product_category", "total_orders", "total_revenue", "avg_review_score",
        "days_since_last_sale", "product_status",
    )
    return top_k(shown, [F.desc("total_revenue"), "product_id"], k)


def _high() -> Column:
    return F.col("risco_atraso") == "alto"


def _late() -> Column:
    return F.col("label") == 1


def prediction_kpis(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("modelo_versao").agg(
        _rows("total_scored"),
        S.count_where(_high()).alias("risco_alto"),
        S.percent_where(_high()).alias("pct_risco_alto"),
        F.round(F.avg("probabilidade_falha"), 4).alias("prob_media"),
        S.percent_where(F.col("predicao_atraso") == F.col("label")).alias("accuracy_pct"),
    )


def probability_histogram(predictions: DataFrame, per_unit: int = 20) -> DataFrame:
    edge = F.round(aggregates.bucket_floor(F.col("probabilidade_falha"), per_unit), 2).alias("faixa_prob")
    grouped = predictions.groupBy(edge).agg(
        _rows("total_pedidos"), S.count_where(_late()).alias("realmente_atrasados"),
        _mean("total_pago", 2, "ticket_medio"),
    )
    return grouped.orderBy("faixa_prob")


def risk_distribution(predictions: DataFrame) -> DataFrame:
    grouped = predictions.groupBy("risco_atraso").agg(
        _rows("total_pedidos"),
        S.count_where(_late()).alias("realmente_atrasados"),
        S.percent_where(_late()).alias("taxa_atraso_real_pct"),
        F.round(F.avg("probabilidade_falha"), 4).alias("prob_media"),
        _sum("total_pago", "valor_total_em_risco"),
    )
    return share_of_total(grouped, "total_pedidos", few=True).orderBy(F.desc("prob_media"), "risco_atraso")


def risk_by_state(predictions: DataFrame, least: int = 50) -> DataFrame:
    grouped = predictions.groupBy("customer_state").agg(
        _rows("total_pedidos"), S.count_where(_high()).alias("risco_alto"),
        S.percent_where(_high()).alias("pct_risco_alto"), F.round(F.avg("probabilidade_falha"), 4).alias("prob_media"),
    )
    return grouped.where(F.col("total_pedidos") >= least).orderBy(F.desc("pct_risco_alto"), "customer_state")


def alert_list(predictions: DataFrame, k: int = 20) -> DataFrame:
    shown = predictions.select(
        "order_id", "customer_state", "seller_state", F.round("total_pago", 2).alias("total_pago"), "qtd_itens",
        F.round("peso_medio_kg", 2).alias("peso_kg"), F.round("probabilidade_falha", 4).alias("probabilidade_falha"),
        "risco_atraso", "predicao_atraso", F.col("label").alias("atraso_real"),
        F.col("probabilidade_falha").alias("_p"),
    )
    return top_k(shown, [F.desc("_p"), "order_id"], k).drop("_p")


def risk_by_segment(predictions: DataFrame, orders: DataFrame, rfm: DataFrame) -> DataFrame:
    joined = joins.join_risk_segment(predictions, orders, rfm)
    grouped = joined.groupBy("rfm_segment", "risco_atraso").agg(
        _rows("total_pedidos"), F.round(F.avg("probabilidade_falha"), 4).alias("prob_media"),
        _mean("total_pago", 2, "ticket_medio"),
    )
    return grouped.orderBy("rfm_segment", "risco_atraso")


def prescriptive_list(predictions: DataFrame, orders: DataFrame, rfm: DataFrame) -> DataFrame:
    """Every high-risk order with the buyer's segment, most likely first."""
    high = joins.join_risk_segment(predictions.where(_high()), orders, rfm)
    shown = high.select(
        "order_id", "customer_state", "seller_state", "total_pago", "probabilidade_falha", "risco_atraso", "rfm_segment"
    )
    return shown.orderBy(F.desc("probabilidade_falha"), "order_id")


def risk_band_kpis(predictions: DataFrame) -> DataFrame:
    grouped = predictions.groupBy("risco_atraso").agg(
        _rows("total_pedidos"), F.round(F.avg("probabilidade_falha"), 3).alias("prob_media"),
        _mean("total_pago", 2, "ticket_medio"), S.count_where(_late()).alias("realmente_atrasados"),
        S.percent_where(_late()).alias("taxa_atraso_real_pct"),
    )
    return grouped.orderBy("risco_atraso")


def comment_coverage(reviews: DataFrame) -> DataFrame:
    said = S.has_text("review_message")
    return reviews.agg(
        _rows("total_reviews"), S.count_where(said).alias("com_comentario"),
        S.percent_where(said).alias("pct_com_comentario"),
    )


def commented_score_share(reviews: DataFrame) -> DataFrame:
    grouped = reviews.where(S.has_text("review_message")).groupBy("review_score").agg(_rows("total"))
    return share_of_total(grouped, "total", few=True).orderBy("review_score")


# Columns each serving dataset exposes.
SERVING: dict[str, Sequence[str]] = {
    "vendas_diarias": ["data_venda", "total_pedidos", "total_clientes", "gmv", "ticket_medio", "total_frete"],
    "clientes_rfm": [
        "customer_unique_id", "customer_state", "customer_city", "frequency", "monetary", "recency_days",
        "avg_ticket", "first_purchase", "last_purchase", "rfm_segment",
    ],
    "sellers_score": [
        "seller_id", "seller_city", "seller_state", "total_orders", "delivered_orders", "canceled_orders",
        "avg_review_score", "on_time_rate", "cancel_rate", "seller_score", "seller_tier",
    ],
    "produtos_performance": [
        "product_id", "product_category", "total_orders", "total_revenue", "avg_price", "days_since_last_sale",
        "avg_review_score", "total_reviews", "negative_review_rate", "product_status",
    ],
    "predicoes": [
        "order_id", "customer_id", "customer_state", "seller_state", "total_pago", "total_frete", "qtd_itens",
        "peso_medio_kg", "label", "predicao_atraso", "probabilidade_falha", "risco_atraso", "modelo_versao",
        "scored_at",
    ],
}


def serving_dataset(mart: DataFrame, name: str) -> DataFrame:
    """The declared columns; one that the mart lacks is an error."""
    return mart.select(*SERVING[name])
