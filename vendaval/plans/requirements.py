"""Marts that stakeholders asked for on top of the core ones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, ladders
from ..functions import scalars as S
from ..operators import joins
from .gold import calendar_columns


def dim_pagamento(payments: DataFrame) -> DataFrame:
    """One row per payment type seen, with its group and a label."""
    kinds = payments.where("payment_type IS NOT NULL").select("payment_type", "payment_group").distinct()
    label = F.coalesce(*[F.when(F.col("payment_type") == k, F.lit(v)) for k, v in fixed.PAYMENT_LABELS.items()],
                       F.initcap(S.underscores_to_spaces("payment_type")))
    return kinds.withColumn("descricao", label)


def _order_score(reviews: DataFrame) -> DataFrame:
    """Latest score per order."""
    newest = F.struct("review_creation_date", "review_id")
    return reviews.groupBy("order_id").agg(F.max_by("review_score", newest).alias("review_score"))


def fato_vendas(orders_enriched: DataFrame, items_enriched: DataFrame, reviews: DataFrame) -> DataFrame:
    """Item-grain fact with keys to date, customer, product, seller, place and payment type."""
    order = orders_enriched.select(
        "order_id", "customer_unique_id", "customer_zip_code", "metodo_pagamento_principal", "delta_entrega_dias",
        "status_entrega", F.date_format("order_purchase_timestamp", "yyyyMMdd").cast("int").alias("date_key"),
    )
    lines = items_enriched.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "total_item_value"
    )
    joined = lines.join(order, "order_id").join(_order_score(reviews), "order_id", "left")
    return joined.select(
        "order_id", "order_item_id", "date_key",
        F.col("customer_unique_id").alias("customer_key"), F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"), F.col("customer_zip_code").alias("location_key"),
        F.col("metodo_pagamento_principal").alias("payment_type"),
        "price", "freight_value", "total_item_value", "review_score", "delta_entrega_dias", "status_entrega",
    )


def gmv_categoria_estado(orders_enriched: DataFrame, items_enriched: DataFrame) -> DataFrame:
    """Sales, orders, lines and mean line value per day, category and buyer state.

    An order is counted where the first of its lines in a category meets the first of its rows with a day and state, in the
    order that the join sorts by anyhow, so no task holds a hash table with an entry for each order.
    """
    sold = orders_enriched.where(F.col("order_status").isin(fixed.SALE_STATUSES)).select(
        "order_id", "customer_state", F.to_date("order_purchase_timestamp").alias("data_venda")
    )
    lines = items_enriched.select("order_id", "product_category", "total_item_value")
    joined = _first_marked(lines, ["product_category"], "_line").join(
        _first_marked(sold, ["customer_state", "data_venda"], "_order"), "order_id"
    )
    return joined.groupBy("data_venda", "product_category", "customer_state").agg(
        F.sum("total_item_value").cast("decimal(22,2)").alias("gmv"),
        S.count_where(F.col("_line") & F.col("_order")).alias("total_pedidos"),
        F.count(F.lit(1)).alias("volume"),
        S.mean_of("total_item_value", 2).alias("ticket_medio"),
    )


def _first_marked(df: DataFrame, columns: Sequence[str], mark: str) -> DataFrame:
    """Rows that have an order, one of those alike in order and ``columns`` marked."""
    alike = Window.partitionBy("order_id").orderBy(*columns)
    return df.where("order_id IS NOT NULL").withColumn(mark, F.rank().over(alike) == F.row_number().over(alike))


def serie_horaria(orders: DataFrame, holidays: Sequence[date] = ()) -> DataFrame:
    """Orders per hour from the first to the last day, hours without orders included, with calendar marks.

    The hour grid comes from the data's own range: one row per day, exploded to 24, so it is built in parallel.
    """
    hour = F.date_trunc("hour", "order_purchase_timestamp")
    counted = orders.where("order_purchase_timestamp IS NOT NULL").groupBy(hour.alias("hora")).agg(
        F.count(F.lit(1)).alias("pedidos")
    )
    span = counted.agg(F.to_date(F.min("hora")).alias("a"), F.to_date(F.max("hora")).alias("b")).where("a IS NOT NULL")
    days = span.select(F.explode(F.sequence("a", "b")).alias("dia"))
    start = F.unix_timestamp(F.col("dia").cast("timestamp"))
    hours = days.select("dia", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    grid = hours.select("dia", F.timestamp_seconds(start + F.col("h") * 3600).alias("hora"))
    calendar = calendar_columns("dia")
    holiday = F.col("dia").isin(list(holidays)) if holidays else F.lit(False)
    return grid.join(counted, "hora", "left").select(
        "hora", F.coalesce("pedidos", F.lit(0)).alias("pedidos"),
        calendar["dia_semana_num"].alias("dia_semana_num"), calendar["is_fim_de_semana"].alias("is_fim_de_semana"),
        holiday.alias("is_feriado"),
    )


def features_fraude(orders_enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """Account age, zip match, purchases on the day and 30-day mean payment of the person behind each order.

    Totals per person and day are computed first and joined back, and the 30-day window runs over those daily rows,
    so one person with very many orders is a window of at most one row per day.
    """
    bought = orders_enriched.where("customer_unique_id IS NOT NULL").select(
        "order_id", "customer_id", "customer_unique_id", "customer_zip_code", "total_pago",
        F.to_date("order_purchase_timestamp").alias("dia"),
    )
    keys = ["customer_unique_id", "dia"]
    daily = bought.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("daily_purchase_count"), F.sum("total_pago").alias("_paid"),
        F.count("total_pago").alias("_n"),
    )
    person = Window.partitionBy("customer_unique_id").orderBy(F.unix_date("dia"))
    month = person.rangeBetween(-29, 0)
    so_far = person.rowsBetween(Window.unboundedPreceding, 0)
    daily = daily.withColumns({
        "customer_age_days": F.datediff("dia", F.min("dia").over(so_far)),
        "avg_payment_value_30d": S.ratio(F.sum("_paid").over(month), F.sum("_n").over(month), 2),
    }).drop("_paid", "_n")
    home = customers.groupBy("customer_unique_id").agg(
        F.min_by("customer_zip_code", "customer_id").alias("_home_zip")
    )
    joined = bought.join(daily, keys).join(home, "customer_unique_id", "left")
    match = F.coalesce(F.col("customer_zip_code") == F.col("_home_zip"), F.lit(False))
    return joined.select(
        "order_id", "customer_unique_id", "customer_age_days",
        match.alias("payment_zip_vs_customer_zip_match"), "daily_purchase_count", "avg_payment_value_30d",
    )


def features_churn(
    orders_enriched: DataFrame, items_enriched: DataFrame, reviews: DataFrame, as_of: date
) -> DataFrame:
    """Purchase history, reviews, preferred category and delivery experience per person."""
    per_order = orders_enriched.where("customer_unique_id IS NOT NULL").select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "delta_entrega_dias", "status_entrega",
        "total_pago",
    )
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("_s"), F.count("review_score").alias("_n"),
        F.sum("tempo_resposta_seg").alias("_rs"), F.count("tempo_resposta_seg").alias("_rn"),
    )
    last = F.struct("order_purchase_timestamp", "order_id")
    history = per_order.join(scores, "order_id", "left").groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        F.datediff(F.lit(as_of), F.max("order_purchase_timestamp")).alias("recency_days"),
        F.coalesce(F.sum("total_pago"), F.lit(0)).cast("decimal(22,2)").alias("total_gasto"),
        S.ratio(F.sum("_s"), F.sum("_n"), 2).alias("avg_review_score"),
        S.ratio(F.sum("_rs"), F.sum("_rn"), 0).alias("tempo_resposta_medio_seg"),
        S.count_where(F.col("status_entrega") == "atrasado").alias("pedidos_atrasados"),
        F.max_by("delta_entrega_dias", last).alias("ultimo_delta_entrega"),
    )
    owner = per_order.select("order_id", "customer_unique_id")
    by_category = items_enriched.where("product_category IS NOT NULL").select("order_id", "product_category").join(
        owner, "order_id"
    ).groupBy("customer_unique_id", "product_category").agg(F.count(F.lit(1)).alias("_n"))
    # Most bought category; on a tie the one first in the alphabet.
    favourite = by_category.groupBy("customer_unique_id").agg(
        F.min_by("product_category", F.struct(-F.col("_n"), F.col("product_category"))).alias("categoria_preferida")
    )
    return history.join(favourite, "customer_unique_id", "left")


def penetracao_estado(customers: DataFrame, orders_enriched: DataFrame, geo: DataFrame) -> DataFrame:
    """Customers, sales and customers per mapped place, by state and city."""
    place = ["customer_state", "customer_city"]
    people = customers.groupBy(*place).agg(F.count_distinct("customer_unique_id").alias("clientes"))
    sales = orders_enriched.where(F.col("order_status").isin(fixed.SALE_STATUSES)).groupBy(*place).agg(
        F.coalesce(F.sum("total_pago"), F.lit(0)).cast("decimal(22,2)").alias("gmv"),
        F.count(F.lit(1)).alias("pedidos"),
    )
    density = geo.groupBy(
        F.col("geolocation_state").alias("customer_state"), F.col("geolocation_city").alias("customer_city")
    ).agg(
        F.count_distinct("geolocation_zip_code_prefix").alias("ceps"), F.sum("num_registros").alias("pontos")
    )
    joined = people.join(sales, place, "left").join(density, place, "left")
    filled = joined.fillna(0, ["gmv", "pedidos", "ceps", "pontos"])
    return filled.withColumn("clientes_por_cep", S.ratio(F.col("clientes"), F.col("ceps"), 2))


def causa_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Cause class of bad reviews (score 2 or less) against the delivery outcome."""
    bad = reviews.where(F.col("review_score") <= 2)
    classed = bad.select("order_id", "review_score", ladders.review_cause(F.col("review_message")).alias("causa"))
    joined = joins.join_reviews_delivery(classed, orders)
    return joined.groupBy("causa", "status_entrega").agg(
        F.count(F.lit(1)).alias("total"), S.mean_of("delta_entrega_dias", 1).alias("delta_medio_dias"),
        S.mean_of("review_score", 2).alias("score_medio"),
    )


def fato_logistica(orders_enriched: DataFrame, items_enriched: DataFrame) -> DataFrame:
    """Delay and lead time by seller, seller state and category. Orders count once per line."""
    done = orders_enriched.where("tempo_total_seg IS NOT NULL").select(
        "order_id", "delta_entrega_dias", "tempo_total_seg", "status_entrega"
    )
    lines = items_enriched.select("order_id", "seller_id", "seller_state", "product_category")
    return lines.join(done, "order_id").groupBy("seller_id", "seller_state", "product_category").agg(
        F.count(F.lit(1)).alias("itens"),
        S.mean_of("delta_entrega_dias", 2).alias("delta_medio_dias"),
        S.ratio(F.sum("tempo_total_seg"), F.count("tempo_total_seg") * 86400, 2).alias("lead_time_medio_dias"),
        F.max("delta_entrega_dias").alias("delta_max_dias"),
        S.percent_where(F.col("status_entrega") == "no_prazo", 2).alias("pct_no_prazo"),
    )


def lead_time_quantiles(orders_enriched: DataFrame, at: Sequence[float] = (0.5, 0.9, 0.95)) -> DataFrame:
    """Lead-time quantiles in seconds per buyer state, as mergeable sketches."""
    done = orders_enriched.where("tempo_total_seg IS NOT NULL")
    sketch = F.percentile_approx("tempo_total_seg", list(at), 10000)
    return done.groupBy("customer_state").agg(F.count(F.lit(1)).alias("pedidos"), sketch.alias("quantis_seg"))


def fato_pagamentos(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments by day, type and group."""
    dated = orders.select("order_id", F.to_date("order_purchase_timestamp").alias("data"))
    return payments.join(dated, "order_id").groupBy("data", "payment_type", "payment_group").agg(
        F.count(F.lit(1)).alias("pagamentos"),
        F.sum("payment_value").cast("decimal(22,2)").alias("valor_total"),
        S.mean_of("payment_installments", 2).alias("parcelas_media"),
    )


def receita_por_produto(orders: DataFrame, items: DataFrame) -> DataFrame:
    sold = joins.join_items_orders(items, orders.select("order_id", "order_status"), fixed.SALE_STATUSES)
    return sold.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("itens"),
        F.sum("total_item_value").cast("decimal(22,2)").alias("receita"),
        F.sum("freight_value").cast("decimal(22,2)").alias("frete"),
    )


def produtos_90d(orders: DataFrame, items: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Revenue of the last days, share of cancelled lines and days since the last sale per product."""
    state = orders.select("order_id", "order_status", F.to_date("order_purchase_timestamp").alias("_day"))
    joined = items.select("order_id", "product_id", "total_item_value").join(state, "order_id")
    sale = F.col("order_status").isin(fixed.SALE_STATUSES)
    age = F.datediff(F.lit(as_of), F.col("_day"))
    recent = sale & age.between(0, days)
    return joined.groupBy("product_id").agg(
        F.coalesce(F.sum(F.when(recent, F.col("total_item_value"))), F.lit(0)).cast("decimal(22,2)").alias(
            "total_revenue_90d"
        ),
        S.percent_where(F.col("order_status") == "canceled", 2).alias("return_rate"),
        F.min(F.when(sale, age)).alias("days_since_last_sale"),
    )
