"""Raw, clean and mart tables on small fixtures with the awkward rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vendaval import schemas
from vendaval.operators import aggregates, joins, quality, rows
from vendaval.plans import bronze, gold, requirements, silver

AS_OF = date(2020, 6, 30)


@pytest.fixture
def documents(spark):
    item = ("p1", "s1", "2020-01-05 00:00:00", 10.0, 1.0)
    done = ("2020-01-01 10:00:00", "2020-01-01 11:00:00", "2020-01-02 00:00:00", "2020-01-09 00:00:00", "2020-01-10 00:00:00")
    person = ("c1", "u1", "1001", "sp", "SP")
    return spark.createDataFrame([
        ("o1", "delivered", person, done, [(1, *item), (2, *item)], [(1, "boleto", 1, 5.0), (2, "voucher", 3, None)],
         ("r1", 5, None, "bom", "2020-01-12 00:00:00", None)),
        ("o2", "weird", person, (None, "not a date", None, None, None), [], [], None),
        ("o3", "shipped", None, (None,) * 5, None, None, None),
    ], schemas.order_document())


def test_order_without_items_or_payments_stays(documents, rows_of):
    lines = bronze.order_lines(documents)
    got = {(r.order_id, r.order_item_id): r for r in lines.collect()}
    assert set(got) == {("o1", 1), ("o1", 2), ("o2", None), ("o3", None)}
    assert got["o1", 1].total_order_value == 5.0
    assert got["o1", 1].payment_types == ["boleto", "voucher"]
    assert (got["o1", 1].max_installments, got["o1", 1].num_payment_methods) == (3, 2)
    # The empty payment list explodes to one empty row, which the count includes.
    assert (got["o2", None].num_payment_methods, got["o2", None].total_order_value) == (1, None)
    assert got["o3", None].num_payment_methods == 1
    assert got["o2", None].approved_ts is None
    # Undelivered orders count as not on time.
    assert (got["o1", 1].entregue_no_prazo, got["o2", None].entregue_no_prazo) == (True, False)
    assert got["o1", 1].delta_entrega_dias == -1


def test_both_forms_of_document_totals_agree(documents, rows_of):
    assert rows_of(bronze.order_lines(documents)) == rows_of(
        bronze.order_lines(documents, repeated=True).select(*bronze.order_lines(documents).columns)
    )


def test_key_choice_decides_whether_a_second_line_survives(documents):
    lines = bronze.order_lines(documents)
    assert bronze.clean_order_lines(lines).where("order_id = 'o1'").count() == 2
    assert bronze.clean_order_lines(lines, keys=("order_id", "product_id")).where("order_id = 'o1'").count() == 1


def test_clean_lines_domain_and_required_ids(documents, rows_of):
    clean = bronze.clean_order_lines(bronze.order_lines(documents))
    assert rows_of(clean.select("order_id", "order_status").distinct()) == [("o1", "delivered"), ("o2", "unknown")]


def test_products_zero_or_median(frame, rows_of):
    schema = "product_id string, product_category_name string, " + ", ".join(f"{m} int" for m in bronze.MEASURES)
    raw = frame(schema, ("a", " Toys ", 10, 1, 1, 1), ("b", "toys", 30, 1, 1, 1), ("c", "TOYS", None, 1, 1, 1),
                ("d", None, None, 2, 2, 2), (None, "toys", 1, 1, 1, 1))
    zero = {r.product_id: r for r in bronze.clean_products(raw).collect()}
    assert set(zero) == {"a", "b", "c", "d"}
    assert (zero["c"].product_weight_g, zero["d"].sem_categoria, zero["a"].product_category_name) == (0, True, "toys")
    median = {r.product_id: r.product_weight_g for r in bronze.clean_products(raw, fill="median").collect()}
    assert median["c"] in (10, 30) and median["d"] is None


def test_payment_rule_edges(frame, rows_of):
    raw = frame(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ("a", 1, " Boleto ", 1, 0.0), ("b", 1, "boleto", 1, 0.01), ("c", 1, "x", 1, 99999.99), ("d", 1, "x", 1, 100000.0),
        ("e", 1, "x", 1, None), (None, 1, "x", 1, 5.0),
    )
    clean = quality.apply_rules(silver.payments(raw), silver.RULES["payments"])
    assert rows_of(clean, "order_id", "payment_group") == [("b", "boleto"), ("c", "outro")]


def test_main_method_is_the_first_in_sequence(frame):
    paid = frame(
        "order_id string, payment_sequential int, payment_type string, payment_group string, payment_installments int, "
        "payment_value decimal(10,2)",
        ("a", 2, "voucher", "voucher", 1, Decimal("1.10")), ("a", 1, "boleto", "boleto", 4, Decimal("2.20")),
    )
    row = aggregates.payment_summary(paid).first()
    assert (row.metodo_pagamento_principal, row.total_pago, row.max_parcelas, row.num_pagamentos) == (
        "boleto", Decimal("3.30"), 4, 2)


def test_category_falls_back_to_the_key(frame, rows_of):
    schema = "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, " \
             "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"
    raw = frame(schema, ("a", "casa_mesa", 1, 1, 1, 501, 2, 3, 4), ("b", "x_y", 1, 1, 1, None, None, 3, 4), ("c", None, 1, 1, 1, 1, 1, 1, 1))
    translation = frame("product_category_name string, product_category_name_english string", ("casa_mesa", "house"))
    got = {r.product_id: r for r in silver.products(raw, translation).collect()}
    assert [got[k].product_category for k in "abc"] == ["house", "x y", None]
    assert (got["a"].product_weight_kg, got["a"].product_volume_cm3, got["a"].porte_produto) == (Decimal("0.50"), Decimal("24.0"), "medio")
    assert (got["b"].porte_produto, got["b"].product_volume_cm3) == ("grande", None)


def test_rules_drop_warn_fail(spark):
    apart = spark.newSession()  # observations and model training do not share a session
    df = apart.createDataFrame([("a", 1), ("b", None), (None, 50)], "id string, n int")
    watch = Observation()
    rules = quality.RuleSet(drop={"id": "id IS NOT NULL"}, warn={"small": "n < 10"})
    assert quality.apply_rules(df, rules, watch).count() == 2
    assert watch.get == {"rows": 3, "id": 1, "small": 2}  # NULL breaks a rule
    with pytest.raises(Exception, match="expectation failed: has_n"):
        quality.expect_or_fail(df, {"has_n": "n IS NOT NULL"}).count()
    assert quality.expect_or_fail(df, {"fine": "n IS NULL OR n > 0"}).count() == 3


def test_report_counts_and_gate(frame, rows_of):
    df = frame("id string, n int", ("a", 1), ("b", None), (None, 50))
    report = quality.violation_report(df, {"id": "id IS NOT NULL", "all": "true"})
    assert rows_of(report, "rule", "total_rows", "violations") == [("all", 3, 0), ("id", 3, 1)]
    gate = quality.quality_gate(report, F.col("violations") > 0, "rule").first()
    assert (gate.status, gate.failed, gate.details) == ("FALHA", 1, "id")
    assert quality.quality_gate(report.where("violations = 0"), F.col("violations") > 0, "rule").first().status == "OK"


def test_column_tests_find_a_person_with_two_addresses(frame, rows_of):
    mart = frame("customer_unique_id string, rfm_segment string", ("u1", "New"), ("u1", "Lost"), ("u2", "Odd"), ("u3", None))
    got = dict(rows_of(quality.column_tests(mart, *gold.TESTS["dim_clientes_rfm"])))
    assert got == {
        "not_null:customer_unique_id": 0, "not_null:rfm_segment": 1, "unique:customer_unique_id": 1,
        "accepted_values:rfm_segment": 1,
    }


@pytest.fixture
def shop(frame, at):
    """Two persons; one bought under two addresses."""
    orders = frame(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "status_entrega string, delta_entrega_dias int",
        ("o1", "c1", "delivered", at("2020-06-01T10:00:00"), "no_prazo", -1),
        ("o2", "c2", "delivered", at("2020-06-10T10:00:00"), "atrasado", 3),
        ("o3", "c3", "canceled", at("2020-06-11T10:00:00"), "pendente", None),
        ("o4", "c3", "delivered", at("2019-01-01T10:00:00"), "no_prazo", 0),
    )
    customers = frame(
        "customer_id string, customer_unique_id string, customer_state string, customer_city string",
        ("c1", "u1", "SP", "x"), ("c2", "u1", "RJ", "y"), ("c3", "u2", "AM", "z"),
    )
    items = frame(
        "order_id string, order_item_id int, product_id string, seller_id string, price decimal(10,2), "
        "freight_value decimal(10,2), total_item_value decimal(11,2)",
        ("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.00"), Decimal("11.00")),
        ("o1", 2, "p1", "s1", Decimal("10.00"), Decimal("1.00"), Decimal("11.00")),
        ("o2", 1, "p2", "s1", Decimal("5.00"), Decimal("0.00"), Decimal("5.00")),
        ("o3", 1, "p2", "s2", Decimal("7.00"), Decimal("0.50"), Decimal("7.50")),
        ("o4", 1, "p1", "s1", Decimal("1.00"), Decimal("0.00"), Decimal("1.00")),
    )
    reviews = frame(
        "review_id string, order_id string, review_score int, review_creation_date timestamp",
        ("r1", "o1", 1, None), ("r2", "o1", 5, None), ("r3", "o2", None, None),
    )
    sellers = frame("seller_id string, seller_city string, seller_state string", ("s1", "x", "SP"), ("s2", "y", "RJ"), ("s3", "z", "AM"))
    products = frame("product_id string, product_category string, product_weight_kg decimal(10,2)", ("p1", "a", None), ("p2", "b", None), ("p3", "c", None))
    return dict(orders=orders, customers=customers, items=items, reviews=reviews, sellers=sellers, products=products)


def test_rfm_grain(shop, rows_of):
    args = (shop["orders"], shop["customers"], shop["items"], AS_OF)
    by_address = gold.dim_clientes_rfm(*args)
    assert rows_of(by_address, "customer_unique_id", "customer_state", "frequency", "recency_days", "rfm_segment") == [
        ("u1", "RJ", 1, 20, "New"), ("u1", "SP", 1, 29, "New"), ("u2", "AM", 1, 546, "Lost")]
    by_person = gold.dim_clientes_rfm(*args, by_person=True)
    assert rows_of(by_person, "customer_unique_id", "customer_state", "frequency", "monetary", "rfm_segment") == [
        ("u1", "RJ", 2, Decimal("27.00"), "Loyal"), ("u2", "AM", 1, Decimal("1.00"), "Lost")]


def test_review_counts_once_per_line(shop):
    got = {r.product_id: r for r in joins.join_items_reviews(shop["items"], shop["reviews"], "product_id").collect()}
    # Order o1 has two lines of p1 and two reviews: four pairs.
    assert (got["p1"].total_reviews, got["p1"].score_sum, got["p1"].negative_reviews) == (4, 12, 2)
    assert (got["p2"].total_reviews, got["p2"].scored_reviews) == (1, 0)


def test_product_mart(shop):
    got = {r.product_id: r for r in gold.dim_produtos_performance(
        shop["products"], shop["items"], shop["orders"], shop["reviews"], AS_OF).collect()}
    assert set(got) == {"p1", "p2"}
    assert (got["p1"].total_orders, got["p1"].total_revenue, got["p1"].product_status) == (2, Decimal("23.00"), "Ativo")
    assert (got["p1"].negative_review_rate, got["p1"].avg_review_score) == (Decimal("50.00"), Decimal("3.00"))
    assert got["p2"].avg_review_score is None


def test_seller_score_neutral_defaults_and_grain(shop):
    mart = gold.dim_sellers_score(shop["sellers"], shop["items"], shop["orders"], shop["reviews"])
    got = {r.seller_id: r for r in mart.collect()}
    assert set(got) == {"s1", "s2"}
    # No delivered order and no review: 0.5 for both; all cancelled; one order of a hundred.
    assert got["s2"].seller_score == Decimal("35.10") and got["s2"].seller_tier == "Critico"
    assert (got["s1"].delivered_orders, got["s1"].total_orders) == (4, 3)  # lines, orders
    per_order = {r.seller_id: r for r in gold.seller_metrics(shop["items"], shop["orders"], order_grain=True).collect()}
    assert per_order["s1"].delivered_orders == 3


def test_daily_sales_mean_is_per_line(shop, rows_of):
    fact = gold.fato_vendas_diarias(shop["orders"], shop["items"])
    assert rows_of(fact.where("data_venda = '2020-06-01'"), "total_pedidos", "gmv", "ticket_medio") == [
        (1, Decimal("22.00"), Decimal("11.00"))]
    assert fact.where("data_venda = '2020-06-11'").count() == 0  # cancelled


def test_incremental_fact_corrects_recent_days_only(shop, frame, at, rows_of):
    fact = gold.fato_vendas_diarias(shop["orders"], shop["items"])
    late = frame(
        shop["orders"].schema.simpleString()[7:-1].replace(":", " "),
        ("n1", "c1", "delivered", at("2020-06-08T00:00:00"), "no_prazo", 0),
        ("n2", "c1", "delivered", at("2020-06-05T00:00:00"), "no_prazo", 0),
    )
    lines = shop["items"].where("order_id = 'o2'")
    items = shop["items"].unionByName(lines.withColumn("order_id", F.lit("n1"))).unionByName(lines.withColumn("order_id", F.lit("n2")))
    days = {str(r[0]) for r in gold.fato_vendas_incremental(fact, shop["orders"].unionByName(late), items).select("data_venda").collect()}
    assert days == {"2019-01-01", "2020-06-01", "2020-06-08", "2020-06-10"}  # 5 June lies before the three days
    empty = fact.limit(0)
    assert gold.fato_vendas_incremental(empty, shop["orders"], shop["items"]).count() == fact.count()


def test_places_are_numbered_in_order(shop, rows_of):
    got = rows_of(gold.dim_localizacao(shop["customers"], shop["sellers"]), "localizacao_id", "estado", "cidade", "regiao")
    assert got == [(1, "AM", "z", "Norte"), (2, "RJ", "y", "Sudeste"), (3, "SP", "x", "Sudeste")]


def test_hourly_series_fills_gaps(shop):
    series = requirements.serie_horaria(shop["orders"].where("order_id IN ('o1', 'o2')"), [date(2020, 6, 2)])
    assert series.count() == 10 * 24
    assert series.agg(F.sum("pedidos")).first()[0] == 2
    assert series.where("is_feriado").count() == 24


def test_mart_outputs_pass_declared_tests(shop):
    mart = gold.dim_produtos_performance(shop["products"], shop["items"], shop["orders"], shop["reviews"], AS_OF)
    assert quality.column_tests(mart, *gold.TESTS["dim_produtos_performance"]).where("failures > 0").count() == 0
    tempo = gold.dim_tempo(shop["orders"])
    assert quality.column_tests(tempo, *gold.TESTS["dim_tempo"]).where("failures > 0").count() == 0


def test_staging_projection_has_the_declared_columns(shop):
    assert rows.select_staging(shop["sellers"].withColumn("seller_zip_code", F.lit("1")), "sellers").columns == rows.STAGING["sellers"]


def test_guard_is_not_copied_to_the_other_side_of_a_join(frame, at):
    orders = frame(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp", ("o1", "c1", "delivered", at("2020-01-01"), None, None, None, None))
    people = frame(
        "customer_id string, customer_unique_id string, customer_zip_code string, customer_city string, customer_state string",
        ("c1", "u1", "1", "x", "SP"), (None, "u2", "1", "x", "SP"))
    paid = silver.payments(frame(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ("o1", 1, "boleto", 1, 5.0), (None, 1, "boleto", 1, 5.0)))
    enriched = silver.orders_enriched(silver.orders(orders), people, paid)
    guarded = quality.apply_rules(enriched, silver.RULES["orders_enriched"])
    assert [r.customer_unique_id for r in guarded.collect()] == ["u1"]
    broken = silver.orders_enriched(silver.orders(orders.withColumn("customer_id", F.lit(None).cast("string"))), people, paid)
    with pytest.raises(Exception, match="Customer_ID_Obrigatorio: o1"):
        quality.apply_rules(broken, silver.RULES["orders_enriched"]).collect()


def test_sketches_stay_close(spark):
    df = spark.range(20_000).select((F.col("id") % 2 == 0).cast("int").alias("customer_state"), F.col("id").alias("tempo_total_seg"))
    for row in requirements.lead_time_quantiles(df).collect():
        assert all(abs(q - want) < 200 for q, want in zip(row.quantis_seg, (10_000, 18_000, 19_000), strict=True))
    near = aggregates.approx_distinct_by(df, ["customer_state"], {"n": "tempo_total_seg"})
    assert all(abs(r.n - 10_000) < 800 for r in near.collect())


def test_one_hot_order_does_not_change_results(spark):
    """A third of all lines in one order, one product and one seller."""
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit(Decimal("1.00")).alias("price"), F.lit(Decimal("0.10")).alias("freight_value"),
        F.lit(Decimal("1.10")).alias("total_item_value"),
    )
    heads = lines.groupBy("order_id").agg(F.min("order_item_id").alias("n")).select(
        "order_id", F.lit("c").alias("customer_id"), F.lit("delivered").alias("order_status"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("n") * 60).alias("order_purchase_timestamp"))
    fact = gold.fato_vendas_diarias(heads, lines).agg(F.sum("gmv").alias("gmv"), F.sum("total_pedidos").alias("n")).first()
    assert (fact.gmv, fact.n) == (Decimal("9900.00"), 6001)
    reviews = heads.select(F.concat(F.lit("r"), "order_id").alias("review_id"), "order_id", F.lit(1).alias("review_score"))
    judged = joins.join_items_reviews(lines, reviews, "product_id")
    assert judged.where("product_id = 'hot'").first().total_reviews == 3000


def test_orders_of_a_category_are_counted_without_a_table_of_orders(frame, rows_of):
    t = "timestamp '2024-01-05 10:00:00'"
    orders = frame("order_id string, customer_state string, order_status string",
                   ("a", "SP", "delivered"), ("a", "SP", "delivered"), ("a", "RJ", "delivered"), ("b", "SP", "delivered"),
                   (None, "SP", "delivered"), ("c", None, "delivered")).withColumn("order_purchase_timestamp", F.expr(t))
    items = frame("order_id string, product_category string, total_item_value string",
                  ("a", "x", "1.00"), ("a", "x", "2.00"), ("a", None, "4.00"), ("b", "x", None), (None, "x", "9.00"), ("c", "x", "5.50"))
    items = items.withColumn("total_item_value", F.col("total_item_value").cast("decimal(12,2)"))
    got = requirements.gmv_categoria_estado(orders, items)
    D = Decimal
    assert rows_of(got, "product_category", "customer_state", "gmv", "total_pedidos", "volume", "ticket_medio") == sorted([
        ("x", "SP", D("6.00"), 2, 5, D("1.50")), ("x", "RJ", D("3.00"), 1, 2, D("1.50")), ("x", None, D("5.50"), 1, 1, D("5.50")),
        (None, "SP", D("8.00"), 1, 2, D("4.00")), (None, "RJ", D("4.00"), 1, 1, D("4.00")),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate(keys=" in line and "order_id" in line]
