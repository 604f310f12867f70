"""Aggregations (A1-A19), windows (WF1-WF4), top-k and samples (SL1-SL5), sets (ST1-ST3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, rows, windows
from .oracle import dbl, half_up, mean, pct, txt
from .registry import check
from .tables import PLACES


@check("A1_order_payment_totals", f"""
    SELECT order_id, {dbl('SUM(payment_value)')} AS total_order_value,
      array_to_string(list_sort(list(payment_type)), ',') AS payment_types,
      MAX(payment_installments) AS max_installments, COUNT(*) AS num_payment_methods FROM b_payments GROUP BY 1""")
def _(b):
    totals = aggregates.order_payment_totals(b.raw_payments)
    return totals.withColumn("payment_types", F.array_join("payment_types", ","))


@check("A2_payment_summary", f"""
    SELECT order_id, {dbl('total_pago')} AS total_pago, max_parcelas, num_pagamentos, metodo_pagamento_principal,
      grupo_pagamento_principal FROM s_paid""")
def _(b):
    return aggregates.payment_summary(b.payments)


@check("A3_geo_centroids", "SELECT * FROM s_geolocation")
def _(b):
    return aggregates.geo_centroids(b.raw_geolocation)


@check("A4_order_values", f"SELECT order_id, {dbl('SUM(total_item_value)')} AS order_total FROM s_items GROUP BY 1")
def _(b):
    return aggregates.order_values(b.items)


@check("A5_items_feature_agg", f"""
    SELECT order_id, {dbl('total_itens_valor')} AS total_itens_valor, {dbl('total_frete')} AS total_frete, peso_medio_kg,
      volume_medio_cm3, qtd_itens, seller_state FROM g_items_agg""")
def _(b):
    return aggregates.items_feature_agg(b.items_enriched)


@check("A6_count_distinct_by", """
    SELECT seller_id, COUNT(DISTINCT order_id) AS pedidos, COUNT(DISTINCT product_id) AS produtos FROM s_items GROUP BY 1""")
def _(b):
    return aggregates.count_distinct_by(b.items, ["seller_id"], {"pedidos": "order_id", "produtos": "product_id"})


@check("A7_conditional_count", """
    SELECT customer_id, COUNT(*) FILTER (WHERE order_status = 'delivered') AS entregues,
      COUNT(*) FILTER (WHERE status_entrega = 'atrasado') AS atrasados FROM s_orders GROUP BY 1""")
def _(b):
    return aggregates.conditional_count(b.orders, ["customer_id"], {
        "entregues": F.col("order_status") == "delivered", "atrasados": F.col("status_entrega") == "atrasado",
    })


@check("A8_safe_ratio", f"""
    SELECT customer_id, {pct("COUNT(*) FILTER (WHERE status_entrega = 'atrasado')",
                             "COUNT(*) FILTER (WHERE order_status = 'delivered')", 2)} AS pct_atraso
    FROM s_orders GROUP BY 1""")
def _(b):
    counts = aggregates.conditional_count(b.orders, ["customer_id"], {
        "entregues": F.col("order_status") == "delivered", "atrasados": F.col("status_entrega") == "atrasado",
    })
    rate = aggregates.safe_ratio(F.col("atrasados"), F.col("entregues"))
    return counts.select("customer_id", rate.alias("pct_atraso"))


@check("A9_frequency_table", "SELECT order_status, COUNT(*) AS count FROM b_orders GROUP BY 1")
def _(b):
    return aggregates.frequency_table(b.raw_orders, "order_status")


@check("A10_payment_type_stats", f"""
    SELECT payment_type, COUNT(*) AS total, {mean('payment_value', 4)} AS avg_value FROM s_payments GROUP BY 1""")
def _(b):
    return aggregates.payment_type_stats(b.payments)


@check("A11_having_filter", """
    SELECT customer_state, COUNT(*) AS total FROM s_customers GROUP BY 1 HAVING COUNT(*) >= 55""")
def _(b):
    return aggregates.having_filter(b.customers, ["customer_state"], 55)


@check("A12_global_kpis", f"""
    SELECT {dbl('SUM(gmv)')} AS gmv_total, CAST(SUM(total_pedidos) AS BIGINT) AS pedidos_total,
      {half_up('CAST(SUM(gmv) * 100 AS HUGEINT)', '(SUM(total_pedidos) * 100)', 2)} AS ticket_medio_geral,
      COUNT(DISTINCT data_venda) AS dias_operacao FROM g_fact""")
def _(b):
    from ..plans.reports import executive_kpis

    kpis = executive_kpis(b.fact)
    return kpis.select("gmv_total", "pedidos_total", "ticket_medio_geral", "dias_operacao")


@check("A13_min_max_range", f"""
    SELECT {txt('MIN(order_purchase_timestamp)')} AS min_order_purchase_timestamp,
      {txt('MAX(order_purchase_timestamp)')} AS max_order_purchase_timestamp FROM s_orders""")
def _(b):
    return aggregates.min_max_range(b.orders, "order_purchase_timestamp")


@check("A14_histogram", """
    SELECT round(floor(probabilidade_falha * 20) / 20, 4) AS bucket, COUNT(*) AS total FROM g_predictions GROUP BY 1""")
def _(b):
    return aggregates.histogram(b.predictions, "probabilidade_falha", 20)


@check("A15_cross_tab", """
    SELECT review_score, sentimento_modelo, COUNT(*) AS total FROM t_labelled GROUP BY 1, 2""")
def _(b):
    return aggregates.cross_tab(b.labelled_reviews, "review_score", "sentimento_modelo")


def _stats_sql(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, COUNT({column}) AS count, round(avg({column}), 6) AS mean, "
            f"round(stddev({column}), 6) AS stddev, MIN({column}) AS min, MAX({column}) AS max FROM orders")


@check("A16_describe_numeric", f"{_stats_sql('o_totalprice')} UNION ALL {_stats_sql('CAST(o_custkey AS DOUBLE)')}"
       .replace("'CAST(o_custkey AS DOUBLE)'", "'o_custkey'"))
def _(b):
    described = aggregates.describe_numeric(b.table("orders"), ["o_totalprice", "o_custkey"])
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@check("A17_group_stats", """
    SELECT risco_atraso, COUNT(*) AS total, round(MIN(probabilidade_falha), 4) AS probabilidade_falha_min,
      round(avg(probabilidade_falha), 4) AS probabilidade_falha_avg,
      round(MAX(probabilidade_falha), 4) AS probabilidade_falha_max,
      round(stddev(probabilidade_falha), 4) AS probabilidade_falha_stddev FROM g_predictions GROUP BY 1""")
def _(b):
    return aggregates.group_stats(b.predictions, "risco_atraso", "probabilidade_falha")


AGREE = """(sentimento_modelo = 'Positive' AND sentimento_regra = 'positivo')
    OR (sentimento_modelo = 'Negative' AND sentimento_regra = 'negativo')
    OR (sentimento_modelo = 'Neutral' AND sentimento_regra = 'neutro')"""


@check("A18_agreement_rate", f"""
    SELECT {pct(f"COUNT(*) FILTER (WHERE {AGREE})", "COUNT(*)", 1)} AS taxa_concordancia_pct,
      COUNT(*) AS total_avaliados FROM t_labelled""")
def _(b):
    from ..plans.text import compare_labels

    return compare_labels(b.labelled_reviews)


@check("A19_approx_distinct_by", """
    SELECT seller_id, COUNT(DISTINCT order_id) AS exato, true AS dentro_do_erro FROM s_items GROUP BY 1""")
def _(b):
    # Within three standard errors of the sketch, next to the exact count.
    sketched = aggregates.approx_distinct_by(b.items, ["seller_id"], {"pedidos": "order_id"})
    exact = aggregates.count_distinct_by(b.items, ["seller_id"], {"exato": "order_id"})
    near = F.abs(F.col("pedidos") - F.col("exato")) <= F.greatest(F.lit(1.0), F.col("exato") * 0.06)
    return sketched.join(exact, "seller_id").select("seller_id", "exato", near.alias("dentro_do_erro"))


# ---- windows --------------------------------------------------------------------------------------------------------

@check("WF1_dedupe_latest", """
    SELECT * EXCLUDE (rn) FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
          l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def _(b):
    lines = b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return windows.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


@check("WF2_surrogate_key", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS linha, o_orderkey, CAST(o_orderdate AS VARCHAR)
      AS o_orderdate FROM orders""")
def _(b):
    orders = b.table("orders").select("o_orderkey", "o_orderdate")
    return windows.surrogate_key(orders, ["o_orderdate", "o_orderkey"], "linha")


@check("WF3_moving_average", f"""
    SELECT {txt('data_venda')} AS data_venda,
      {half_up('(SUM(CAST(gmv * 100 AS HUGEINT)) OVER w)', '((COUNT(gmv) OVER w) * 100)', 4)} AS gmv_media_7d
    FROM g_fact WINDOW w AS (ORDER BY data_venda ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(b):
    averaged = windows.moving_average(b.fact, "data_venda", {"gmv_media_7d": "gmv"}, 7)
    return averaged.select("data_venda", "gmv_media_7d")


@check("WF3_moving_average_blocks", f"""
    SELECT o_orderkey,
      {half_up('(SUM(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS HUGEINT)) OVER w)',
               '((COUNT(o_totalprice) OVER w) * 100)', 4)} AS media
    FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(b):
    orders = b.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    averaged = windows.moving_average_blocks(
        orders, ["o_orderdate", "o_orderkey"], {"media": "o_totalprice"}, 7, block=1000
    )
    return averaged.select("o_orderkey", "media")


@check("WF4_share_of_total", f"""
    SELECT customer_id, COUNT(*) AS total, {half_up('(COUNT(*) * 100)', '(SELECT COUNT(*) FROM s_orders)', 4)} AS pct
    FROM s_orders GROUP BY 1""")
def _(b):
    return windows.group_share(b.orders, ["customer_id"], digits=4)


# ---- top-k, order, samples ------------------------------------------------------------------------------------------

@check("SL1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(b):
    orders = b.table("orders").select("o_orderkey", "o_totalprice")
    return windows.top_k(orders, [F.desc("o_totalprice"), "o_orderkey"], 20)


@check("SL2_sort_by", f"SELECT {txt('data_venda')} AS data_venda, total_pedidos FROM g_fact ORDER BY data_venda")
def _(b):
    return windows.sort_by(b.fact.select("data_venda", "total_pedidos"), "data_venda")


@check("SL3_sample_random_n", """
    SELECT review_id, review_score FROM s_scores ORDER BY md5('42|' || CAST(review_id AS VARCHAR)), review_id LIMIT 1000""")
def _(b):
    return windows.sample_random_n(b.scores.select("review_id", "review_score"), 1000, ["review_id"])


@check("SL4_sample_stratified")
def _(b):
    scores = b.scores.select("review_id", "review_score")
    return windows.sample_stratified(scores, "review_score", {s: 0.1 for s in range(1, 6)})


@check("SL4_sample_all_or_none", "SELECT review_id, review_score FROM s_scores WHERE review_score IN (1, 4)")
def _(b):
    scores = b.scores.select("review_id", "review_score")
    return windows.sample_stratified(scores, "review_score", {1: 1.0, 2: 0.0, 4: 1.0})


@check("SL5_train_test_split", "SELECT COUNT(*) AS linhas, COUNT(DISTINCT order_id) AS pedidos FROM g_features")
def _(b):
    train, test = windows.train_test_split(b.features, ["order_id"], 0.2, stratify="label")
    # The two sides are disjoint and together hold every row.
    both = train.select("order_id").unionByName(test.select("order_id"))
    return both.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct("order_id").alias("pedidos"))


@check("SL5_train_test_sides", "SELECT label, COUNT(*) AS linhas, true AS parte_certa FROM g_features GROUP BY 1")
def _(b):
    # Every label has its fifth on the test side, to one row in a hundred.
    train, test = windows.train_test_split(b.features, ["order_id"], 0.2, stratify="label")
    both = rows.union_all(train.select("label", F.lit(0).alias("t")), test.select("label", F.lit(1).alias("t")))
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("linhas"), (F.abs(F.avg("t") - 0.2) <= 0.01).alias("parte_certa")
    )


# ---- sets -----------------------------------------------------------------------------------------------------------

@check("ST1_union_distinct", PLACES)
def _(b):
    from ..plans.gold import places

    return places(b.customers, b.sellers)


@check("ST2_union_all", """
    SELECT customer_state AS estado, 'cliente' AS origem FROM s_customers
    UNION ALL SELECT seller_state, 'vendedor' FROM s_sellers""")
def _(b):
    return rows.union_all(
        b.customers.select(F.col("customer_state").alias("estado"), F.lit("cliente").alias("origem")),
        b.sellers.select(F.col("seller_state").alias("estado"), F.lit("vendedor").alias("origem")),
    )


@check("ST3_distinct_rows", "SELECT DISTINCT customer_state, customer_city FROM s_customers")
def _(b):
    return rows.distinct_rows(b.customers, ["customer_state", "customer_city"])
