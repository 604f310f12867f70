"""Marts. "Today" is always an argument, so a rerun gives the same table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, ladders
from ..functions import scalars as S
from ..operators import aggregates, joins, rows, versions
from ..operators.windows import surrogate_key
from ..session import cut_lineage
from ..sources.files import write_partitioned

# Declared tests per mart (not null, unique, accepted values).
TESTS = {
    "dim_tempo": (["data_id", "trimestre"], ["data_id"], {"sazonalidade_varejo": ["Alta", "Media", "Baixa"]}),
    "dim_localizacao": (
        ["localizacao_id", "estado", "regiao"], ["localizacao_id"],
        {"regiao": ["Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Outros"]},
    ),
    "dim_clientes_rfm": (
        ["customer_unique_id", "rfm_segment"], ["customer_unique_id"],
        {"rfm_segment": ["Champions", "Loyal", "New", "At Risk", "Lost", "Hibernating"]},
    ),
    "dim_produtos_performance": (
        ["product_id"], ["product_id"], {"product_status": ["Ativo", "Moderado", "Baixo", "Inativo"]},
    ),
    "dim_sellers_score": (
        ["seller_id"], ["seller_id"], {"seller_tier": ["Excelente", "Bom", "Regular", "Critico"]},
    ),
    "fato_vendas_diarias": (["data_venda", "gmv"], ["data_venda"], {}),
    "features_ml": (["order_id", "label", "tempo_aprovacao_seg", "customer_state"], ["order_id"], {"label": [0, 1]}),
}


def _days_to(as_of: date, ts: Column) -> Column:
    return F.datediff(F.lit(as_of), ts)


def calendar_columns(day: str) -> dict[str, Column]:
    """Calendar parts, names and labels of a date column."""
    d = F.col(day)
    year, month, quarter, weekday = F.year(d), F.month(d), F.quarter(d), S.weekday_number(d)
    return {
        "ano": year,
        "mes": month,
        "dia": F.dayofmonth(d),
        "trimestre": quarter,
        "dia_semana_num": weekday,
        "dia_semana_nome": ladders.label_at(weekday, fixed.WEEKDAY_NAMES),
        "is_fim_de_semana": weekday.isin(0, 6),
        "mes_nome": ladders.label_at(month - 1, fixed.MONTH_NAMES),
        "ano_trimestre": F.concat_ws("-Q", year.cast("string"), quarter.cast("string")),
        "ano_mes": F.date_format(d, "yyyy-MM"),
        "sazonalidade_varejo": ladders.season(month),
    }


def dim_tempo(orders: DataFrame) -> DataFrame:
    """One row per day with a sale."""
    days = orders.select(F.to_date("order_purchase_timestamp").alias("data_id")).dropna().distinct()
    return days.withColumns(calendar_columns("data_id")).orderBy("data_id")


def places(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct (state, city) of buyers and sellers; rows without a state are left out."""
    parts = [
        df.select(F.col(f"{who}_state").alias("estado"), F.col(f"{who}_city").alias("cidade"))
        for df, who in ((customers, "customer"), (sellers, "seller"))
    ]
    return rows.union_distinct(*[p.where("estado IS NOT NULL") for p in parts])


def dim_localizacao(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    numbered = surrogate_key(places(customers, sellers), ["estado", "cidade"], "localizacao_id")
    state = F.col("estado")
    return numbered.withColumns({"regiao": ladders.region(state), "tier_mercado": ladders.market_tier(state)})


def dim_clientes_rfm(
    orders: DataFrame, customers: DataFrame, items: DataFrame, as_of: date, by_person: bool = False
) -> DataFrame:
    """Recency, frequency and value of delivered orders, with a segment.

    The grain is person and address. ``by_person`` gives one row per person, under the address of the latest order.
    Items are summed per order before any join, so the widest table is shuffled once, already reduced.
    """
    delivered = orders.where(F.col("order_status") == "delivered").select(
        "order_id", "customer_id", "order_purchase_timestamp"
    )
    who = customers.select("customer_id", "customer_unique_id", "customer_state", "customer_city")
    bought = joins.join_customer_orders(who, delivered, aggregates.order_values(items))
    ts = F.col("order_purchase_timestamp")
    measures = [
        F.count_distinct("order_id").alias("frequency"),
        F.sum("order_total").cast("decimal(22,2)").alias("monetary"),
        F.min(ts).alias("first_purchase"),
        F.max(ts).alias("last_purchase"),
        S.mean_of("order_total", 2).alias("avg_ticket"),
    ]
    address = ["customer_state", "customer_city"]
    if by_person:
        latest = F.struct(ts, F.col("order_id"))
        grouped = bought.groupBy("customer_unique_id").agg(
            *[F.max_by(c, latest).alias(c) for c in address], *measures
        )
    else:
        grouped = bought.groupBy("customer_unique_id", *address).agg(*measures)
    recent = grouped.withColumn("recency_days", _days_to(as_of, F.col("last_purchase")))
    segment = ladders.rfm_segment(F.col("frequency"), F.col("recency_days"))
    return recent.withColumn("rfm_segment", segment)


def dim_produtos_performance(
    products: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame, as_of: date
) -> DataFrame:
    """Sales, staleness and review quality of every product with a delivered sale."""
    delivered = orders.select("order_id", "order_status", "order_purchase_timestamp")
    sold = joins.join_items_orders(items, delivered, ["delivered"])
    sales = sold.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_item_value").cast("decimal(22,2)").alias("total_revenue"),
        S.mean_of("price", 2).alias("avg_price"),
        F.max("order_purchase_timestamp").alias("last_sale_date"),
    )
    judged = joins.join_items_reviews(items, reviews, "product_id")
    goods = products.select("product_id", "product_category", "product_weight_kg")
    joined = joins.left_then_require(goods, sales, judged, "product_id", F.col("total_orders") > 0)
    idle = joined.withColumn("days_since_last_sale", _days_to(as_of, F.col("last_sale_date")))
    return idle.select(
        *goods.columns, "total_orders", "total_revenue", "avg_price", "last_sale_date", "days_since_last_sale",
        S.ratio(F.col("score_sum"), F.col("scored_reviews"), 2).alias("avg_review_score"),
        "total_reviews",
        S.percent(F.col("negative_reviews"), F.col("total_reviews"), 2).alias("negative_review_rate"),
        ladders.staleness(F.col("days_since_last_sale")).alias("product_status"),
    )


def seller_metrics(items: DataFrame, orders: DataFrame, order_grain: bool = False) -> DataFrame:
    """Orders per seller and how they went.

    Delivered, cancelled and on-time figures count item lines, as the score was defined; ``order_grain`` counts each
    order once per seller instead. Lines are first counted per (order, seller).
    """
    lines = items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("_lines"))
    state = orders.select("order_id", "order_status", "status_entrega", "delta_entrega_dias")
    n = F.lit(1).cast("bigint") if order_grain else F.col("_lines")
    delay = F.col("delta_entrega_dias")

    def tally(test: Column) -> Column:
        return F.sum(F.when(test, n).otherwise(0))

    delays = F.sum(F.when(delay.isNotNull(), n))
    return lines.join(state, "order_id").groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        tally(F.col("order_status") == "delivered").alias("delivered_orders"),
        tally(F.col("order_status") == "canceled").alias("canceled_orders"),
        tally(F.col("status_entrega") == "no_prazo").alias("on_time_orders"),
        S.ratio(F.sum(delay * n), delays, 2).alias("avg_delivery_delta"),
    )


def dim_sellers_score(
    sellers: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame, order_grain: bool = False
) -> DataFrame:
    """Weighted score of 0 to 100 per seller with an order, and its tier. Missing shares count as neutral."""
    metrics = seller_metrics(items, orders, order_grain)
    judged = joins.join_items_reviews(items, reviews, "seller_id")
    shop = sellers.select("seller_id", "seller_city", "seller_state")
    joined = joins.left_then_require(shop, metrics, judged, "seller_id", F.col("total_orders") > 0)
    neutral = F.lit(fixed.SCORE_NEUTRAL).cast("decimal(3,2)")

    def share(top: Column, bottom: Column, missing: Column) -> Column:
        return F.coalesce(F.try_divide(S.exact(top), bottom.cast("decimal(16,0)")), missing)

    total = F.col("total_orders")
    cancelled = share(F.col("canceled_orders"), total, F.lit(0).cast("decimal(1,0)"))
    volume = F.least(total, F.lit(fixed.SCORE_VOLUME_CAP)).cast("decimal(16,0)") / fixed.SCORE_VOLUME_CAP
    parts = {
        "review": share(F.col("score_sum"), F.col("scored_reviews") * 5, neutral),
        "on_time": share(F.col("on_time_orders"), F.col("delivered_orders"), neutral),
        "kept": F.lit(1) - cancelled,
        "volume": volume,
    }
    score = F.lit(0).cast("decimal(3,0)")
    for name, part in parts.items():
        score = score + part.cast("decimal(24,12)") * fixed.SCORE_WEIGHTS[name]
    # The shares are repeating decimals; nine digits settle sums such as 63.1249999999 before the final rounding.
    scored = joined.select(
        *shop.columns, "total_orders", "delivered_orders", "canceled_orders",
        S.ratio(F.col("score_sum"), F.col("scored_reviews"), 2).alias("avg_review_score"),
        "negative_reviews",
        S.percent(F.col("on_time_orders"), F.col("delivered_orders"), 2).alias("on_time_rate"),
        S.percent(F.col("canceled_orders"), total, 2).alias("cancel_rate"),
        F.round(F.round(score, 9), 2).alias("seller_score"),
    )
    return scored.withColumn("seller_tier", ladders.seller_tier(F.col("seller_score")))


def fato_vendas_diarias(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per day; ``orders`` has one row per order. The mean is per item line.

    Items are reduced to one row per order before the join, and orders to one row per day and customer before the day,
    so that customers are counted without repeating every row.
    """
    per_order = items.groupBy("order_id").agg(
        F.sum("total_item_value").alias("_value"), F.sum("freight_value").alias("_freight"),
        F.count("total_item_value").alias("_lines"),
    )
    sold = rows.filter_in(orders, "order_status", fixed.SALE_STATUSES).select(
        "order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("data_venda")
    )
    per_customer = sold.join(per_order, "order_id").groupBy("data_venda", "customer_id").agg(
        F.count("order_id").alias("_orders"), *[F.sum(c).alias(c) for c in ("_value", "_freight", "_lines")]
    )
    return per_customer.groupBy("data_venda").agg(
        F.sum("_orders").alias("total_pedidos"),
        F.count("customer_id").alias("total_clientes"),
        F.sum("_value").cast("decimal(22,2)").alias("gmv"),
        S.ratio(F.sum("_value"), F.sum("_lines"), 2).alias("ticket_medio"),
        F.sum("_freight").cast("decimal(22,2)").alias("total_frete"),
    )


def fato_vendas_incremental(fact: DataFrame, orders: DataFrame, items: DataFrame, days: int = 3) -> DataFrame:
    """The fact after reprocessing the last days: days with new figures are replaced whole, the rest stays.

    For a stored fact use ``refresh_fato_vendas``, which leaves all other days unread.
    """
    return versions.delete_insert_by_key(fact, cut_lineage(_recent_sales(fact, orders, items, days), "recent"), "data_venda")


def refresh_fato_vendas(path: str, orders: DataFrame, items: DataFrame, days: int = 3) -> None:
    """Reprocess the last days of a fact stored by ``data_venda``: only partitions with new figures are rewritten."""
    fact = orders.sparkSession.read.parquet(path)
    write_partitioned(_recent_sales(fact, orders, items, days), path, "data_venda", mode="overwrite")


def _recent_sales(fact: DataFrame, orders: DataFrame, items: DataFrame, days: int) -> DataFrame:
    """The item side is cut to the recent orders before it is aggregated, so a run costs the recent days only."""
    recent = versions.lookback(orders, "order_purchase_timestamp", fact, "data_venda", days)
    return fato_vendas_diarias(recent, joins.semi_join_in(items, recent, "order_id"))


def features_ml(orders_enriched: DataFrame, items_enriched: DataFrame) -> DataFrame:
    """Order-level label and features of every order with a known delivery outcome and an approval time."""
    known = orders_enriched.where(
        F.col("status_entrega").isin("no_prazo", "atrasado") & F.col("tempo_aprovacao_seg").isNotNull()
    )
    joined = joins.join_features(known, aggregates.items_feature_agg(items_enriched))
    group = F.col("grupo_pagamento_principal")

    def given(column: str, default: int, kind: str) -> Column:
        return F.coalesce(F.col(column).cast(kind), F.lit(default).cast(kind)).alias(column)

    return joined.select(
        "order_id", "customer_id",
        S.flag(F.col("status_entrega") == "atrasado").alias("label"),
        given("tempo_aprovacao_seg", 0, "bigint"), given("tempo_postagem_seg", 0, "bigint"),
        given("total_pago", 0, "decimal(22,2)"), given("max_parcelas", 1, "int"),
        S.flag(group == "cartao").alias("pag_cartao"), S.flag(group == "boleto").alias("pag_boleto"),
        "customer_state",
        given("total_itens_valor", 0, "decimal(22,2)"), given("total_frete", 0, "decimal(22,2)"),
        given("peso_medio_kg", 0, "decimal(12,4)"), given("volume_medio_cm3", 0, "decimal(22,2)"),
        given("qtd_itens", 1, "bigint"),
        "seller_state", "delta_entrega_dias", "status_entrega", "order_status",
    )
