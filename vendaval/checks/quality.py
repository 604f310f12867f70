"""Quality checks (DQ1-DQ14) and governance (GV1-GV6)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import governance, profiles, quality
from ..plans import gold, silver
from ..session import scratch_path
from .bound import Bound
from .oracle import NORTE, dbl, half_up, mean, pct, pct_where
from .registry import check


@check("DQ1_expect_or_drop", f"SELECT order_id, payment_sequential, {dbl('payment_value')} AS payment_value FROM s_payments")
def _(b):
    clean = silver.payments(b.raw_payments)
    kept = quality.expect_or_drop(clean, silver.RULES["payments"].drop)
    return kept.select("order_id", "payment_sequential", "payment_value")


@check("DQ2_expect_or_fail", "SELECT order_id, order_item_id, product_id FROM s_items_enriched")
def _(b):
    guarded = quality.expect_or_fail(b.items_enriched, silver.RULES["items_enriched"].fail)
    return guarded.select("order_id", "order_item_id", "product_id")


@check("DQ3_expect_warn", """
    SELECT COUNT(*) AS linhas, COUNT(*) FILTER (WHERE NOT (delta_entrega_dias <= 30 OR delta_entrega_dias IS NULL))
      AS violacoes FROM s_orders""")
def _(b):
    watch = Observation("orders_warn")
    rules = silver.RULES["orders"].warn
    apart = Bound(b.spark.newSession(), b.folder)  # see the note on observations in quality.py
    observed = quality.expect_warn(silver.orders(apart.raw_orders), rules, watch)
    observed.write.format("noop").mode("overwrite").save()
    # The observed counts next to the table they were taken from.
    return b.raw_orders.agg(F.count(F.lit(1)).alias("linhas")).withColumn(
        "violacoes", F.lit(watch.get["Entrega_Atraso_Alerta"])
    )


_RULES = {
    "atraso": "delta_entrega_dias <= 30 OR delta_entrega_dias IS NULL",
    "aprovado": "order_approved_at IS NOT NULL",
    "status": "order_status IN ('delivered','shipped','canceled')",
}


@check("DQ4_violation_report", " UNION ALL ".join(
    f"SELECT '{name}' AS rule, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE NOT coalesce({sql}, FALSE)) AS violations,"
    f" {pct(f'COUNT(*) FILTER (WHERE coalesce({sql}, FALSE))', 'COUNT(*)', 4)} AS pass_rate FROM s_orders"
    for name, sql in _RULES.items()))
def _(b):
    return quality.violation_report(b.orders, _RULES)


_NULLABLE = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_id"]


@check("DQ5_null_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS nulls,"
    f" {pct(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)', 2)} AS null_pct FROM s_orders" for c in _NULLABLE))
def _(b):
    return quality.null_report(b.orders, _NULLABLE)


@check("DQ6_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, COUNT(*) AS registros, 'OK' AS status FROM s_{t}"
    for t in ("orders", "customers", "items", "payments")))
def _(b):
    return quality.table_counts({
        "orders": b.orders, "customers": b.customers, "items": b.items, "payments": b.payments,
    })


@check("DQ7_referential_check", """
    SELECT *, parent_keys = child_keys AS same_count, CASE WHEN only_child = 0 THEN 'OK' ELSE 'DIVERGENTE' END AS status
    FROM (
      SELECT (SELECT COUNT(DISTINCT order_id) FROM s_orders) AS parent_keys,
        (SELECT COUNT(DISTINCT order_id) FROM s_items) AS child_keys,
        (SELECT COUNT(*) FROM (SELECT order_id FROM s_orders EXCEPT SELECT order_id FROM s_items)) AS only_parent,
        (SELECT COUNT(*) FROM (SELECT order_id FROM s_items EXCEPT SELECT order_id FROM s_orders)) AS only_child)""")
def _(b):
    return quality.referential_check(b.orders, b.items, "order_id")


_KEYS = {
    "orders": "order_id", "customers": "customer_id", "items": "order_id", "payments": "order_id",
    "reviews": "review_id", "products": "product_id", "sellers": "seller_id",
}


@check("DQ8_pk_null_check", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, '{k}' AS pk, COUNT(*) - COUNT({k}) AS nulos, 'OK' AS status FROM s_{t}"
    for t, k in _KEYS.items()))
def _(b):
    return quality.pk_null_check({t: (getattr(b, t), k) for t, k in _KEYS.items()})


def _tests_sql(table: str, name: str, declared=gold.TESTS) -> str:
    not_null, unique, accepted = declared[name]
    parts = [f"SELECT 'not_null:{c}' AS test, COUNT(*) - COUNT({c}) AS failures FROM {table}" for c in not_null]
    parts += [
        f"SELECT 'unique:{c}', COUNT(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
        for c in unique
    ]
    parts += [
        f"SELECT 'accepted_values:{c}', COUNT(DISTINCT {c}) FROM {table} WHERE {c} NOT IN ({', '.join(repr(v) for v in vs)})"
        for c, vs in accepted.items()
    ]
    return " UNION ALL ".join(parts)


for _name, _table, _attr in (
    ("dim_clientes_rfm", "g_rfm", "rfm"), ("dim_produtos_performance", "g_products", "product_mart"),
    ("dim_sellers_score", "g_sellers", "seller_mart"), ("fato_vendas_diarias", "g_fact", "fact"),
    ("features_ml", "g_features", "features"),
):
    check(f"DQ9_column_tests_{_name}", _tests_sql(_table, _name))(
        lambda b, n=_name, a=_attr: quality.column_tests(getattr(b, a), *gold.TESTS[n])
    )


_CALENDAR = "(SELECT CAST(d AS VARCHAR) AS data_id, quarter(d) AS trimestre, CASE WHEN month(d) IN (11, 12, 1, 2) THEN 'Alta'" \
    " WHEN month(d) IN (5, 6, 7, 8) THEN 'Baixa' ELSE 'Media' END AS sazonalidade_varejo" \
    " FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS d FROM s_orders WHERE order_purchase_timestamp IS NOT NULL))"
_PLACES = "(SELECT row_number() OVER (ORDER BY estado, cidade) AS localizacao_id, estado, 'Norte' AS regiao FROM" \
    " (SELECT customer_state AS estado, customer_city AS cidade FROM s_customers UNION SELECT seller_state, seller_city FROM s_sellers))"


@check("DQ9_column_tests_dim_tempo", _tests_sql(_CALENDAR, "dim_tempo"))
def _(b):
    return quality.column_tests(gold.dim_tempo(b.orders), *gold.TESTS["dim_tempo"])


@check("DQ9_column_tests_dim_localizacao", _tests_sql(_PLACES, "dim_localizacao"))
def _(b):
    return quality.column_tests(gold.dim_localizacao(b.customers, b.sellers), *gold.TESTS["dim_localizacao"])


@check("DQ9_column_tests_odd_values", """
    SELECT 'not_null:o_orderstatus' AS test, 0 AS failures
    UNION ALL SELECT 'unique:o_custkey', COUNT(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'accepted_values:o_orderstatus', COUNT(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F')
    UNION ALL SELECT 'accepted_values:o_orderpriority', COUNT(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def _(b):
    return quality.column_tests(b.table("orders"), ["o_orderstatus"], ["o_custkey"], {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT", "5-LOW"]})


@check("DQ10_reconcile_counts", """
    SELECT 'items' AS tabela, (SELECT COUNT(*) FROM b_items) AS origem, (SELECT COUNT(*) FROM s_items_enriched) AS destino,
      'OK' AS status
    UNION ALL SELECT 'payments', (SELECT COUNT(*) FROM b_payments), (SELECT COUNT(*) FROM s_payments), 'DIVERGENTE'""")
def _(b):
    return quality.reconcile_counts({
        "items": (b.raw_items, b.items_enriched), "payments": (b.raw_payments, b.payments),
    })


_PROFILED = ["o_totalprice", "o_custkey", "o_orderstatus"]


def _profile_sql(c: str, numeric: bool) -> str:
    n = f"CAST({c} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT '{c}' AS column_name, COUNT(*) AS num_rows, COUNT(*) - COUNT({c}) AS num_nulls,"
        f" COUNT(DISTINCT {c}) AS num_distinct, MIN({n}) AS min, MAX({n}) AS max, round(avg({n}), 4) AS mean,"
        f" round(stddev({n}), 2) AS stddev, {pct(f'COUNT(*) FILTER (WHERE {n} = 0)', 'COUNT(*)', 4)} AS percent_zeros"
        " FROM orders"
    )


@check("DQ11_profile", " UNION ALL ".join(_profile_sql(c, c != "o_orderstatus") for c in _PROFILED))
def _(b):
    report = profiles.profile(b.table("orders"), _PROFILED)
    return report.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 2)})


@check("DQ11_profile_quantiles")
def _(b):
    report = profiles.quantiles(b.table("orders"), ["o_totalprice", "o_custkey"])
    return report.withColumn("quantiles", F.array_join(F.col("quantiles").cast("array<string>"), ","))


@check("DQ11_quantile_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS num_values, CAST({at} AS DOUBLE) AS at, TRUE AS within FROM orders"
    for c in ("o_totalprice", "o_custkey") for at in (0.25, 0.5, 0.75)))
def _(b):
    """``within``: the rank of the quantile in all rows is off by 1 % at most."""
    orders, path = b.table("orders"), scratch_path(b.spark, "quantile_sketches")
    columns = ["o_totalprice", "o_custkey"]
    profiles.quantile_sketches(orders, "o_orderdate", columns).write.parquet(path)
    found = profiles.merged_quantiles(b.spark.read.parquet(path))
    cells = profiles.melt(orders, columns).where("number IS NOT NULL")
    # As many quantiles as were asked for meet each row's column.
    ranks = cells.join(found, "column_name").groupBy("column_name", "num_values", "at").agg(
        F.count_if(F.col("number") < F.col("quantile")).alias("below"), F.count_if(F.col("number") <= F.col("quantile")).alias("upto")
    )
    near = (F.col("below") / F.col("num_values") <= F.col("at") + 0.01) & (F.col("upto") / F.col("num_values") >= F.col("at") - 0.01)
    return ranks.select("column_name", "num_values", "at", near.alias("within"))


@check("DQ11_profile_top_values", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS frequency FROM orders GROUP BY 2
        ORDER BY 3 DESC, 2 LIMIT 1)""" for c in ("o_orderstatus", "o_orderpriority")))
def _(b):
    return profiles.top_values(b.table("orders"), ["o_orderstatus", "o_orderpriority"])


for _name in silver.TESTS:
    check(f"DQ9_staging_tests_{_name}", _tests_sql(f"s_{_name}", _name, silver.TESTS))(
        lambda b, n=_name: quality.column_tests(getattr(b, n), *silver.TESTS[n])
    )


# Windows of 30 days from the epoch.
_W = "TIMESTAMP '1970-01-01' + INTERVAL 30 DAY * CAST(floor(epoch(o_orderdate) / 2592000) AS INTEGER)"


@check("DQ11_profile_by_window", " UNION ALL ".join(
    f"""SELECT CAST({_W} AS VARCHAR) AS window_start, CAST({_W} + INTERVAL 30 DAY AS VARCHAR) AS window_end, '{c}' AS column_name,
      '{kind}' AS data_type, COUNT(*) AS num_rows, COUNT(*) - COUNT({c}) AS num_nulls, MIN({n}) AS min, MAX({n}) AS max,
      round(avg({n}), 3) AS mean, round(stddev({n}), 2) AS stddev FROM orders GROUP BY {_W}"""
    for c, kind, n in (
        ("o_totalprice", "double", "CAST(o_totalprice AS DOUBLE)"), ("o_orderstatus", "string", "CAST(NULL AS DOUBLE)"))))
def _(b):
    report = profiles.profile_by_window(b.table("orders"), "o_orderdate", ["o_totalprice", "o_orderstatus"])
    return report.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 2)})


@check("DQ12_drift_by_window", f"""
    WITH n AS (SELECT {_W} AS w, 'o_orderpriority' AS column_name, o_orderpriority AS value, COUNT(*) AS n FROM orders GROUP BY 1, 3),
    nexts AS (SELECT w, lead(w) OVER (ORDER BY w) AS nw FROM (SELECT DISTINCT w FROM n)),
    freq AS (SELECT w, column_name, value, SUM(b) AS b, SUM(c) AS c FROM (
        SELECT w, column_name, value, 0 AS b, n AS c FROM n
        UNION ALL SELECT nw, column_name, value, n, 0 FROM n JOIN nexts USING (w) WHERE nw IS NOT NULL) GROUP BY 1, 2, 3),
    shares AS (SELECT *, SUM(b) OVER (PARTITION BY w) AS bt, SUM(c) OVER (PARTITION BY w) AS ct FROM freq),
    pq AS (SELECT *, greatest(CAST(c AS DOUBLE) / ct, 1e-6) AS p, greatest(CAST(b AS DOUBLE) / bt, 1e-6) AS q,
             CAST(b + c AS DOUBLE) * bt / (bt + ct) AS eb, CAST(b + c AS DOUBLE) * ct / (bt + ct) AS ec FROM shares WHERE bt > 0 AND ct > 0)
    SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 30 DAY AS VARCHAR) AS window_end, column_name,
      round(SUM(p * ln(p / q)), 8) AS kl_divergence,
      round(sqrt(SUM((p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2)), 8) AS js_distance,
      round(SUM(pow(b - eb, 2) / eb + pow(c - ec, 2) / ec), 6) AS chi_squared, COUNT(*) - 1 AS degrees,
      'CONSECUTIVE' AS drift_type FROM pq GROUP BY w, column_name""")
def _(b):
    report = profiles.drift_by_window(b.table("orders"), "o_orderdate", ["o_orderpriority"])
    return report.withColumns({c: F.round(c, d) for c, d in (("kl_divergence", 8), ("js_distance", 8), ("chi_squared", 6))})


_DRIFT = """
    WITH base AS (SELECT o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    cur AS (SELECT o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    freq AS (
      SELECT column_name, value, SUM(b) AS b, SUM(c) AS c FROM (
        SELECT 'o_orderstatus' AS column_name, s AS value, 1 AS b, 0 AS c FROM base
        UNION ALL SELECT 'o_orderpriority', p, 1, 0 FROM base
        UNION ALL SELECT 'o_orderstatus', s, 0, 1 FROM cur UNION ALL SELECT 'o_orderpriority', p, 0, 1 FROM cur)
      GROUP BY 1, 2),
    shares AS (SELECT *, SUM(b) OVER (PARTITION BY column_name) AS bt, SUM(c) OVER (PARTITION BY column_name) AS ct FROM freq),
    pq AS (SELECT *, greatest(CAST(c AS DOUBLE) / ct, 1e-6) AS p, greatest(CAST(b AS DOUBLE) / bt, 1e-6) AS q,
             CAST(b + c AS DOUBLE) * bt / (bt + ct) AS eb, CAST(b + c AS DOUBLE) * ct / (bt + ct) AS ec FROM shares)
    SELECT column_name, round(SUM(p * ln(p / q)), 8) AS kl_divergence,
      round(sqrt(SUM((p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2)), 8) AS js_distance,
      round(SUM(pow(b - eb, 2) / eb + pow(c - ec, 2) / ec), 6) AS chi_squared, COUNT(*) - 1 AS degrees
    FROM pq GROUP BY 1"""


@check("DQ12_drift", _DRIFT)
def _(b):
    orders = b.table("orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    report = profiles.drift(orders.where(early), orders.where(~early), ["o_orderstatus", "o_orderpriority"])
    digits = {"kl_divergence": 8, "js_distance": 8, "chi_squared": 6}
    return report.withColumns({c: F.round(c, n) for c, n in digits.items()})


# The density of the chi variable (the root of chi-squared) by Simpson's rule: another way than the operator's finite sum.
@check("DQ12_drift_test", f"""
    WITH d AS ({_DRIFT}), points AS (SELECT column_name, chi_squared, degrees, i, sqrt(chi_squared) * i / 2000 AS u,
      CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM d, generate_series(0, 2000) AS g(i))
    SELECT column_name, chi_squared, degrees,
      round(1 - SUM(w * 2 * pow(u, degrees - 1) * exp(-u * u / 2) / (pow(2, degrees / 2.0) * gamma(degrees / 2.0)))
        * sqrt(chi_squared) / 6000, 6) AS p_value,
      1 - SUM(w * 2 * pow(u, degrees - 1) * exp(-u * u / 2) / (pow(2, degrees / 2.0) * gamma(degrees / 2.0)))
        * sqrt(chi_squared) / 6000 < 0.05 AS drifted
    FROM points GROUP BY column_name, chi_squared, degrees""")
def _(b):
    orders = b.table("orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    tested = profiles.drift_test(profiles.drift(orders.where(early), orders.where(~early), ["o_orderstatus", "o_orderpriority"]))
    return tested.select("column_name", F.round("chi_squared", 6).alias("chi_squared"), "degrees", F.round("p_value", 6).alias("p_value"), "drifted")


@check("DQ13_quality_gate", """
    SELECT 3 AS total_checks, CAST(SUM(n) AS BIGINT) AS failed,
      coalesce(string_agg(CASE WHEN n > 0 THEN t END, ',' ORDER BY t), '') AS details,
      CASE WHEN SUM(n) > 0 THEN 'FALHA' ELSE 'OK' END AS status
    FROM (SELECT 'payments' AS t, (COUNT(*) > (SELECT COUNT(*) FROM s_payments))::INT AS n FROM b_payments
      UNION ALL SELECT 'orders', 0 UNION ALL SELECT 'customers', 0)""")
def _(b):
    counts = quality.reconcile_counts({
        "orders": (b.raw_orders, b.orders), "customers": (b.raw_customers, b.customers),
        "payments": (b.raw_payments, b.payments),
    })
    return quality.quality_gate(counts, F.col("status") != "OK", "tabela")


@check("DQ14_recompute_check", """
    SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE total_item_value IS NOT DISTINCT FROM price + freight_value)
      AS corretos, COUNT(*) FILTER (WHERE total_item_value IS DISTINCT FROM price + freight_value) AS divergentes
    FROM s_items""")
def _(b):
    return quality.recompute_check(b.items, "total_item_value", F.round(F.col("price") + F.col("freight_value"), 2))


@check("DQ14_rebuild_fact_from_clean", f"""
    SELECT CAST(CAST(o.order_purchase_timestamp AS DATE) AS VARCHAR) AS data_venda,
      {dbl('SUM(i.total_item_value)')} AS gmv_da_silver, {mean('i.total_item_value', 2)} AS ticket_da_silver,
      {dbl('SUM(i.total_item_value)')} AS gmv, TRUE AS confere
    FROM s_orders o JOIN s_items i ON o.order_id = i.order_id
    WHERE o.order_status IN ('delivered','invoiced','processing','shipped') GROUP BY 1""")
def _(b):
    from ..functions import scalars as S
    from ..operators import joins

    dated = b.orders.select("order_id", "order_status", F.to_date("order_purchase_timestamp").alias("data_venda"))
    rebuilt = joins.join_items_orders(b.items, dated, joins.SALE_STATUSES).groupBy("data_venda").agg(
        F.sum("total_item_value").cast("decimal(22,2)").alias("gmv_da_silver"),
        S.mean_of("total_item_value", 2).alias("ticket_da_silver"),
    )
    both = rebuilt.join(b.fact.select("data_venda", "gmv"), "data_venda")
    return both.withColumn("confere", F.col("gmv") == F.col("gmv_da_silver"))


# ---- governance -----------------------------------------------------------------------------------------------------

def _pii_sql(table: str, column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS coluna, '{kind}' AS categoria, COUNT(*) AS total_rows,"
        f" COUNT(*) FILTER (WHERE regexp_matches({column}, '{p}')) AS hits,"
        f" {pct_where(f'''regexp_matches({column}, '{p}')''', 4)} AS hit_rate FROM {table}"
        for kind, p in fixed.PII_VALUE_PATTERNS.items()
    )


for _table, _column in (("documents", "text"), ("pages", "html"), ("conversations", "text")):
    check(f"GV1_pii_scan_values_{_table}", _pii_sql(_table, _column))(
        lambda b, t=_table, c=_column: governance.pii_scan_values(b.table(t), [c])
    )


@check("GV1_pii_scan_names", """
    SELECT 'customer_id' AS coluna, COUNT(*) AS present, 'CPF_HASH' AS categoria FROM s_customers
    UNION ALL SELECT 'customer_unique_id', COUNT(*), 'CPF_HASH' FROM s_customers
    UNION ALL SELECT 'customer_zip_code', COUNT(*), 'CEP' FROM s_customers
    UNION ALL SELECT 'customer_city', COUNT(*), 'LOCALIZACAO' FROM s_customers""")
def _(b):
    return governance.pii_scan_names(b.customers)


@check("GV2_pii_classify", f"""
    SELECT coluna, categoria, hits, CASE categoria WHEN 'CEP' THEN 'QUASI_IDENTIFICADOR'
        WHEN 'COORDENADA_GPS' THEN 'QUASI_IDENTIFICADOR' WHEN 'CARTAO' THEN 'DADO_FINANCEIRO'
        ELSE 'IDENTIFICADOR_DIRETO' END AS tipo_pii,
      CASE WHEN categoria = 'CEP' THEN 'REVIEW' ELSE 'MASKING' END AS acao_recomendada
    FROM ({_pii_sql('documents', 'text')}) WHERE hit_rate > 0""")
def _(b):
    scan = governance.pii_scan_values(b.table("documents"), ["text"])
    return governance.pii_classify(scan).drop("total_rows", "hit_rate")


@check("GV3_column_view_customers", """
    SELECT CAST(customer_zip_code_prefix AS BIGINT) AS customer_zip_code_prefix, customer_city, customer_state FROM b_customers""")
def _(b):
    return governance.column_view(b.raw_customers, "raw.customers", "analista_jr")


@check("GV3_column_view_reviews", """
    SELECT review_id, order_id, review_score, CAST(review_creation_date AS VARCHAR) AS review_creation_date,
      CAST(review_answer_timestamp AS VARCHAR) AS review_answer_timestamp FROM b_reviews""")
def _(b):
    return governance.column_view(b.raw_reviews, "raw.reviews", "analista_jr")


@check("GV3_column_view_clean_customers", "SELECT * EXCLUDE (customer_id, customer_unique_id) FROM s_customers")
def _(b):
    return governance.column_view(b.customers, "clean.customers", "analista_jr")


@check("GV3_column_view_clean_sellers", "SELECT * EXCLUDE (seller_id) FROM s_sellers")
def _(b):
    return governance.column_view(b.sellers, "clean.sellers", "analista_jr")


@check("GV4_row_filter_orders", f"""
    SELECT order_id, customer_state FROM s_orders_enriched WHERE customer_state IN {NORTE}""")
def _(b):
    seen = b.orders_enriched.select("order_id", "customer_state")
    return governance.row_filter(seen, "customer_state", ["Regiao_Norte"])


@check("GV4_row_filter_sellers", f"SELECT * FROM s_sellers WHERE seller_state IN {NORTE}")
def _(b):
    return governance.row_filter(b.sellers, "seller_state", ["Regiao_Norte"])


@check("GV4_row_filter_customers", f"SELECT * FROM s_customers WHERE customer_state IN {NORTE}")
def _(b):
    return governance.row_filter(b.customers, "customer_state", ["Regiao_Norte"])


@check("GV4_row_filter_two_groups", f"SELECT * FROM s_customers WHERE customer_state IN {NORTE} OR customer_state IN ('PR', 'RS', 'SC')")
def _(b):
    groups = {"Regiao_Norte": fixed.REGION_STATES["Norte"], "Regiao_Sul": fixed.REGION_STATES["Sul"]}
    return governance.row_filter(b.customers, "customer_state", ["Regiao_Norte", "Regiao_Sul"], groups)


def _filtered(b, df, column, name, groups):
    governance.sql_row_filters(b.spark, groups)
    return df.where(F.call_function(name, F.col(column)))


@check("GV4_filter_function_orders", f"SELECT order_id, customer_state FROM s_orders_enriched WHERE customer_state IN {NORTE}")
def _(b):
    return _filtered(b, b.orders_enriched.select("order_id", "customer_state"), "customer_state", "filtro_regiao_norte", ["Regiao_Norte"])


@check("GV4_filter_function_customers", f"SELECT * FROM s_customers WHERE customer_state IN {NORTE}")
def _(b):
    return _filtered(b, b.customers, "customer_state", "filtro_regiao_norte_customers", ["Regiao_Norte", "others"])


@check("GV4_filter_function_sellers", f"SELECT * FROM s_sellers WHERE seller_state IN {NORTE}")
def _(b):
    return _filtered(b, b.sellers, "seller_state", "filtro_regiao_norte_sellers", ["Regiao_Norte"])


@check("GV4_filter_function_unrestricted", "SELECT * FROM s_sellers")
def _(b):
    return _filtered(b, b.sellers, "seller_state", "filtro_regiao_norte_sellers", ["others"])


@check("GV4_row_filter_unrestricted", "SELECT * FROM s_customers")
def _(b):
    return governance.row_filter(b.customers, "customer_state", ["admins"])


@check("GV4_row_filter_by_grant", "SELECT * FROM s_customers WHERE customer_state IN (SELECT seller_state FROM s_sellers WHERE seller_city = 'city 3')")
def _(b):
    grants = b.sellers.where("seller_city = 'city 3'").select(F.lit("ana").alias("user"), F.col("seller_state").alias("value"))
    return governance.row_filter_by_grant(b.customers, "customer_state", grants, "ana")


@check("GV5_mask_columns", """
    SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, round(c_acctbal, 0)
      AS c_acctbal, c_mktsegment FROM customer""")
def _(b):
    shown = b.table("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return governance.mask_columns(shown, {"c_custkey": "hash", "c_name": "null", "c_acctbal": "round"}, round_digits=0)


def _redacted(column: str) -> str:
    for kind, p in fixed.PII_VALUE_PATTERNS.items():
        column = f"regexp_replace({column}, '{p}', '<{kind}>', 'g')"
    return column


@check("GV5_redact_text", f"SELECT doc_id, {_redacted('text')} AS text FROM documents")
def _(b):
    return governance.mask_columns(b.table("documents").select("doc_id", "text"), {"text": "redact"})


@check("GV6_region_access_report", f"""
    SELECT COUNT(*) AS total_admin, COUNT(*) FILTER (WHERE customer_state IN {NORTE}) AS total_regiao,
      COUNT(*) FILTER (WHERE customer_state NOT IN {NORTE}) AS bloqueados,
      {pct_where(f'customer_state IN {NORTE}', 2)} AS pct_visivel FROM s_orders_enriched""")
def _(b):
    return governance.region_access_report(b.orders_enriched)


@check("GV6_region_state_report", f"""
    SELECT customer_state, COUNT(*) AS total_pedidos, {mean('total_pago', 2)} AS ticket_medio,
      {half_up('SUM(tempo_total_seg)', '(COUNT(tempo_total_seg) * 86400)', 1)} AS tempo_medio_entrega_dias
    FROM s_orders_enriched WHERE customer_state IN {NORTE} GROUP BY 1""")
def _(b):
    return governance.region_state_report(b.orders_enriched)
