"""Scalar functions: SF1-SF26."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, ladders
from ..functions import scalars as S
from .oracle import REGION, TIER, USAGE_CATEGORY, dbl, txt
from .registry import check


@check("SF1_clean_code", """
    SELECT customer_id, lower(trim(customer_city)) AS cidade, upper(trim(customer_state)) AS estado FROM b_customers""")
def _(b):
    return b.raw_customers.select(
        "customer_id", S.clean_lower("customer_city").alias("cidade"), S.clean_upper("customer_state").alias("estado")
    )


@check("SF2_pad_zip", """
    SELECT o_orderkey, lpad(CAST(o_orderkey * 97 AS VARCHAR), 5, '0') AS zip FROM orders""")
def _(b):
    return b.table("orders").select("o_orderkey", S.pad_zip(F.col("o_orderkey") * 97).alias("zip"))


@check("SF2_pad_zip_keep_longer", """
    SELECT o_orderkey, CASE WHEN length(z) < 5 THEN lpad(z, 5, '0') ELSE z END AS zip
    FROM (SELECT o_orderkey, CAST(o_orderkey * 97 AS VARCHAR) AS z FROM orders)""")
def _(b):
    return b.table("orders").select("o_orderkey", S.pad_zip(F.col("o_orderkey") * 97, keep_longer=True).alias("zip"))


@check("SF3_underscores_to_spaces", """
    SELECT product_id, replace(product_category_name, '_', ' ') AS nome FROM b_products""")
def _(b):
    return b.raw_products.select("product_id", S.underscores_to_spaces("product_category_name").alias("nome"))


@check("SF4_coalesce_defaults", """
    SELECT product_id, coalesce(product_category_name, 'N/A') AS categoria, coalesce(product_weight_g, 0) AS peso
    FROM b_products""")
def _(b):
    return b.raw_products.select(
        "product_id", S.text_or("product_category_name", "N/A").alias("categoria"),
        F.coalesce("product_weight_g", F.lit(0)).alias("peso"),
    )


@check("SF5_text_length_flags", """
    SELECT review_id, length(review_comment_message) AS n, coalesce(length(review_comment_message) > 0, FALSE)
      AS has_comment, coalesce(length(trim(review_comment_message)) > 10, FALSE) AS longo FROM b_reviews""")
def _(b):
    text = "review_comment_message"
    return b.raw_reviews.select(
        "review_id", F.length(text).alias("n"), S.has_text(text).alias("has_comment"),
        S.longer_than(text, 10).alias("longo"),
    )


@check("SF6_concat_document", """
    SELECT product_id, 'Categoria: ' || product_category_name AS linha,
      concat_ws('|', product_id, product_category_name, product_weight_g) AS chave FROM b_products""")
def _(b):
    return b.raw_products.select(
        "product_id", F.concat(F.lit("Categoria: "), "product_category_name").alias("linha"),
        F.concat_ws("|", "product_id", "product_category_name", F.col("product_weight_g").cast("string")).alias("chave"),
    )


@check("SF7_like_category", f"""
    SELECT {txt('usage_date')} AS usage_date, sku_name, {dbl('usage_quantity')} AS usage_quantity,
      {USAGE_CATEGORY} AS categoria FROM u_usage""")
def _(b):
    return b.usage.select(
        "usage_date", "sku_name", "usage_quantity", ladders.usage_category(F.col("sku_name")).alias("categoria")
    )


@check("SF8_date_labels", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
      AS ano_trimestre, strftime(o_orderdate, '%Y-%m') AS ano_mes FROM orders""")
def _(b):
    from ..plans.gold import calendar_columns

    labels = calendar_columns("o_orderdate")
    return b.table("orders").select(
        "o_orderkey", *[labels[n].alias(n) for n in ("ano_trimestre", "ano_mes")]
    )


@check("SF9_parse_timestamps", f"""
    SELECT o_orderkey, {txt('o_orderdate')} AS quando, {txt('CAST(o_orderdate AS DATE)')} AS dia,
      CAST(NULL AS VARCHAR) AS quebrado FROM orders""")
def _(b):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return b.table("orders").select(
        "o_orderkey", S.to_ts(text).alias("quando"), F.to_date(text).alias("dia"),
        S.to_ts(F.concat(text, F.lit("x"))).alias("quebrado"),
    )


@check("SF10_delay_days", """
    SELECT order_id, date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS dias FROM b_orders""")
def _(b):
    delay = S.delay_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return b.raw_orders.select("order_id", delay.alias("dias"))


@check("SF11_elapsed_seconds", """
    SELECT order_id, tempo_aprovacao_seg, tempo_postagem_seg, tempo_transporte_seg, tempo_total_seg FROM s_orders""")
def _(b):
    return b.orders.select(
        "order_id", "tempo_aprovacao_seg", "tempo_postagem_seg", "tempo_transporte_seg", "tempo_total_seg"
    )


@check("SF12_extract_parts", """
    SELECT event_id, year(ts) AS ano, month(ts) AS mes, day(ts) AS dia, quarter(ts) AS trimestre,
      extract(dow FROM ts) AS dia_semana FROM events""")
def _(b):
    return b.table("events").select(
        "event_id", F.year("ts").alias("ano"), F.month("ts").alias("mes"), F.dayofmonth("ts").alias("dia"),
        F.quarter("ts").alias("trimestre"), S.weekday_number("ts").alias("dia_semana"),
    )


@check("SF13_month_start", "SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS mes FROM orders")
def _(b):
    return b.table("orders").select("o_orderkey", F.date_trunc("month", "o_orderdate").cast("date").alias("mes"))


@check("SF14_date_lookback", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 3 AS VARCHAR) AS desde FROM orders")
def _(b):
    return b.table("orders").select("o_orderkey", F.date_sub(F.to_date("o_orderdate"), 3).alias("desde"))


@check("SF15_decimal_round", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS DOUBLE) AS c2,
      CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,1)) AS DOUBLE) AS c1
    FROM lineitem""")
def _(b):
    product = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
    return b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(product, 2).alias("c2"),
        F.round(product, 1).alias("c1"),
    )


@check("SF16_unit_conversion", f"""
    SELECT product_id, {dbl('product_weight_kg')} AS peso_kg, {dbl('product_volume_cm3')} AS volume FROM s_products""")
def _(b):
    return b.products.select(
        "product_id", F.col("product_weight_kg").alias("peso_kg"), F.col("product_volume_cm3").alias("volume")
    )


@check("SF17_least_nullif_floor", """
    SELECT p_partkey, least(p_size / 25.0, 1.0) AS teto, nullif(p_size % 7, 0) AS sem_zero,
      CAST(floor(p_retailprice / 10) AS BIGINT) AS faixa FROM part""")
def _(b):
    size = F.col("p_size")
    return b.table("part").select(
        "p_partkey", F.least(size.cast("double") / 25.0, F.lit(1.0)).alias("teto"),
        F.nullif(size % 7, F.lit(0)).alias("sem_zero"), F.floor(F.col("p_retailprice") / 10).alias("faixa"),
    )


@check("SF18_order_ladders", """
    SELECT order_id, CASE WHEN delta_entrega_dias IS NULL THEN 'sem_informacao'
        WHEN delta_entrega_dias <= -3 THEN 'muito_adiantado' WHEN delta_entrega_dias <= 0 THEN 'no_prazo'
        WHEN delta_entrega_dias <= 5 THEN 'atraso_leve' ELSE 'atraso_grave' END AS escala5, status_entrega FROM s_orders""")
def _(b):
    scale = ladders.delay_scale(F.col("delta_entrega_dias"))
    return b.orders.select("order_id", scale.alias("escala5"), "status_entrega")


@check("SF18_product_ladders", """
    SELECT product_id, CASE WHEN product_weight_g <= 500 THEN 'pequeno' WHEN product_weight_g <= 5000 THEN 'medio'
      ELSE 'grande' END AS porte FROM b_products""")
def _(b):
    return b.raw_products.select("product_id", ladders.size_class(F.col("product_weight_g")).alias("porte"))


@check("SF18_place_ladders", f"""
    SELECT customer_id, {REGION.replace('estado', 'customer_state')} AS regiao,
      {TIER.replace('estado', 'customer_state')} AS tier FROM s_customers""")
def _(b):
    state = F.col("customer_state")
    return b.customers.select(
        "customer_id", ladders.region(state).alias("regiao"), ladders.market_tier(state).alias("tier")
    )


@check("SF18_payment_ladders", "SELECT order_id, payment_sequential, payment_group FROM s_payments")
def _(b):
    group = ladders.payment_group(F.col("payment_type"))
    return b.payments.select("order_id", "payment_sequential", group.alias("payment_group"))


@check("SF19_calendar_names", """
    SELECT o_orderkey, ['Domingo','Segunda','Terça','Quarta','Quinta','Sexta','Sábado'][extract(dow FROM o_orderdate) + 1]
        AS dia, ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro',
        'Dezembro'][month(o_orderdate)] AS mes FROM orders""")
def _(b):
    return b.table("orders").select(
        "o_orderkey", ladders.label_at(S.weekday_number("o_orderdate"), fixed.WEEKDAY_NAMES).alias("dia"),
        ladders.label_at(F.month("o_orderdate") - 1, fixed.MONTH_NAMES).alias("mes"),
    )


@check("SF20_one_hot", """
    SELECT order_id, payment_sequential, CASE WHEN payment_group = 'cartao' THEN 1 ELSE 0 END AS pag_cartao,
      CASE WHEN payment_group = 'boleto' THEN 1 ELSE 0 END AS pag_boleto FROM s_payments""")
def _(b):
    group = F.col("payment_group")
    return b.payments.select(
        "order_id", "payment_sequential", S.flag(group == "cartao").alias("pag_cartao"),
        S.flag(group == "boleto").alias("pag_boleto"),
    )


@check("SF21_array_total", f"""
    SELECT o.order_id, {dbl('SUM(p.payment_value)')} AS total FROM b_orders o JOIN b_payments p ON o.order_id = p.order_id
    GROUP BY 1""")
def _(b):
    total = S.array_total("payments", lambda p: p["value"])
    return b.documents.select("order_id", F.round(total, 2).alias("total"))


@check("SF22_array_size", """
    SELECT o.order_id, COUNT(i.order_id) AS num_items FROM b_orders o LEFT JOIN b_items i ON o.order_id = i.order_id
    GROUP BY 1""")
def _(b):
    return b.documents.select("order_id", F.size("items").alias("num_items"))


@check("SF23_collect_sorted_list", """
    SELECT customer_id, array_to_string(list_sort(list(DISTINCT status_entrega)), ',') AS situacoes FROM s_orders
    GROUP BY 1""")
def _(b):
    lists = b.orders.groupBy("customer_id").agg(F.sort_array(F.collect_set("status_entrega")).alias("situacoes"))
    return lists.withColumn("situacoes", F.array_join("situacoes", ","))


@check("SF24_nested_field", f"""
    SELECT cluster_id, warehouse_id, job_id, {dbl('SUM(usage_quantity)')} AS total FROM u_usage GROUP BY 1, 2, 3""")
def _(b):
    fields = ["cluster_id", "warehouse_id", "job_id"]
    keys = [F.col(f"usage_metadata.{f}").alias(f) for f in fields]
    return b.usage.groupBy(*keys).agg(F.sum("usage_quantity").alias("total"))


@check("SF25_json_text", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      '{"id":' || CAST(event_id AS VARCHAR) || ',"tipo":"' || event_type || '"}' AS doc FROM events""")
def _(b):
    parsed = F.from_json("props", "k bigint")
    doc = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("tipo")))
    return b.table("events").select("event_id", parsed["k"].alias("k"), doc.alias("doc"))


@check("SF26_regex_match", f"""
    SELECT doc_id, regexp_matches(text, '{fixed.PII_VALUE_PATTERNS["EMAIL"]}') AS tem_email,
      len(regexp_extract_all(text, '[0-9]+')) AS numeros FROM documents""")
def _(b):
    return b.table("documents").select(
        "doc_id", F.col("text").rlike(fixed.PII_VALUE_PATTERNS["EMAIL"]).alias("tem_email"),
        F.size(F.regexp_extract_all("text", F.lit("[0-9]+"), 0)).alias("numeros"),
    )
