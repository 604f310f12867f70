"""Streaming: IO13-IO16, J10, W1-W9. Streams run to the end of their input and the landed result is read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from ..plans import silver
from ..schemas import order_document
from ..session import scratch_path
from ..sources import streams
from ..sources.documents import write_json
from ..streaming import changes, orders
from .bound import Bound
from .oracle import dbl, txt
from .registry import check

RECORDS = f"""
    SELECT o.order_id, o.order_status, c.customer_unique_id, c.customer_state, c.customer_city,
      o.order_purchase_timestamp AS purchase_ts, o.order_estimated_delivery_date AS estimated_delivery_ts,
      p.total AS total_order_value, coalesce(i.n, 0) AS num_items, coalesce(r.review_score <= 2, FALSE)
      AS review_negativo, r.review_score, CAST(o.order_purchase_timestamp AS DATE) AS purchase_date
    FROM b_orders o LEFT JOIN b_customers c ON o.customer_id = c.customer_id
      LEFT JOIN (SELECT order_id, SUM(payment_value) AS total FROM b_payments GROUP BY 1) p ON o.order_id = p.order_id
      LEFT JOIN (SELECT order_id, COUNT(*) AS n FROM b_items GROUP BY 1) i ON o.order_id = i.order_id
      LEFT JOIN b_reviews r ON o.order_id = r.order_id"""
RECORDS_OUT = f"""SELECT order_id, order_status, customer_unique_id, customer_state, customer_city,
    {txt('purchase_ts')} AS purchase_ts, {txt('estimated_delivery_ts')} AS estimated_delivery_ts,
    {dbl('total_order_value')} AS total_order_value, num_items, review_negativo, review_score,
    {txt('purchase_date')} AS purchase_date FROM ({RECORDS})"""


def _gmv_sql(unit: str) -> str:
    return f"""SELECT {txt(f"date_trunc('{unit}', purchase_ts)")} AS inicio,
      {txt(f"CAST(date_trunc('{unit}', purchase_ts) AS DATE)")} AS data, customer_state, COUNT(order_id) AS total_pedidos,
      {dbl('SUM(total_order_value)')} AS gmv, floor({dbl('SUM(total_order_value)')} / COUNT(total_order_value) * 1000 + 0.500001) / 1000
      AS ticket_medio, COUNT(*) FILTER (WHERE review_negativo) AS reviews_negativos,
      COUNT(DISTINCT customer_unique_id) AS clientes_unicos FROM ({RECORDS}) GROUP BY ALL"""


def _thousandths(value: Column) -> Column:
    """Three digits; a tie that binary sums miss by a hair still rounds up."""
    return F.floor(value * 1000 + 0.500001) / 1000.0


def _settled(gmv: DataFrame) -> DataFrame:
    """Sums of binary doubles, brought back to cents; ``date_trunc`` prints a day without its time."""
    out = gmv.withColumns({"gmv": F.round("gmv", 2), "ticket_medio": _thousandths(F.col("ticket_medio"))})
    return out.withColumn("inicio", F.col("inicio").cast("string")) if "inicio" in out.columns else out


def _document_files(b: Bound) -> str:
    path = scratch_path(b.spark, "documents")
    write_json(b.documents, path)
    return path


def _document_stream(b: Bound) -> DataFrame:
    return streams.stream_json_source(b.spark, _document_files(b), order_document(streaming=True))


def _landed(b: Bound, stream: DataFrame, by: str | None = None) -> DataFrame:
    path = scratch_path(b.spark, "landed")
    streams.run_available(streams.stream_append_sink(stream, path, scratch_path(b.spark, "cp"), by))
    return b.spark.read.parquet(path)


@check("IO13_stream_json_source", f"""
    SELECT order_id, order_status, num_items, review_score FROM ({RECORDS})""")
def _(b):
    return _landed(b, _document_stream(b).select(
        "order_id", "order_status", F.size("items").alias("num_items"), F.col("review.score").alias("review_score")
    ))


@check("IO14_stream_table_source", f"SELECT event_id, {txt('ts')} AS ts, user_id, event_type, value, props FROM events")
def _(b):
    return _landed(b, streams.stream_table_source(b.spark, b.stream_path("events")))


@check("IO15_stream_append_sink", "SELECT event_id, user_id, value, event_type FROM events")
def _(b):
    source = streams.stream_table_source(b.spark, b.stream_path("events")).select("event_id", "user_id", "value", "event_type")
    return _landed(b, source, by="event_type")


@check("IO16_stream_complete_sink", f"""
    SELECT event_type, COUNT(*) AS eventos, {dbl('SUM(CAST(value AS DECIMAL(14,4)))')} AS total FROM events GROUP BY 1""")
def _(b):
    source = streams.stream_table_source(b.spark, b.stream_path("events"))
    totals = source.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("eventos"), F.sum(F.col("value").cast("decimal(14,4)")).alias("total")
    )
    path = scratch_path(b.spark, "complete")
    streams.run_available(streams.stream_complete_sink(totals, path, scratch_path(b.spark, "cp")))
    return streams.latest_batch(b.spark, path)


@check("J10_stream_static_lookup", """
    SELECT product_id, coalesce(t.product_category_name_english, replace(p.product_category_name, '_', ' '))
      AS product_category FROM b_products p LEFT JOIN b_translation t ON p.product_category_name = t.product_category_name""")
def _(b):
    path = scratch_path(b.spark, "products")
    b.raw_products.write.parquet(path)
    stream = streams.stream_table_source(b.spark, path)
    named = joins.stream_static_lookup(
        stream, b.raw_translation, "product_category_name", "product_category_name_english", "product_category"
    )
    return _landed(b, named.select("product_id", "product_category"))


@check("W1_stream_enrich", RECORDS_OUT)
def _(b):
    records = orders.stream_enrich(b.documents)
    return records.withColumn("total_order_value", F.round("total_order_value", 2))


@check("W1_stream_enrich_landed", RECORDS_OUT)
def _(b):
    records = _landed(b, orders.stream_enrich(_document_stream(b)), by="order_status")
    return records.withColumn("total_order_value", F.round("total_order_value", 2))


@check("W2_watermark", """
    SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS inicio, event_type, COUNT(*) AS eventos FROM events GROUP BY 1, 2""")
def _(b):
    source = orders.watermark(streams.stream_table_source(b.spark, b.stream_path("events")), "ts", "10 minutes")
    counts = source.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("eventos"))
    path = scratch_path(b.spark, "windows")
    flat = counts.select(F.col("window.start").alias("inicio"), "event_type", "eventos")
    streams.run_available(streams.stream_complete_sink(flat, path, scratch_path(b.spark, "cp")))
    return streams.latest_batch(b.spark, path)


@check("W3_daily_gmv_by_state", f"SELECT * EXCLUDE (inicio) FROM ({_gmv_sql('day')})")
def _(b):
    return _settled(orders.daily_gmv_by_state(orders.stream_enrich(b.documents), exact=True))


@check("W3_daily_gmv_stream_exact", f"SELECT * EXCLUDE (inicio) FROM ({_gmv_sql('day')})")
def _(b):
    rows = orders.customer_days(orders.stream_enrich(_document_stream(b)))
    path = scratch_path(b.spark, "days")
    streams.run_available(streams.stream_complete_sink(rows, path, scratch_path(b.spark, "cp")))
    return _settled(orders.roll_up_customer_days(streams.latest_batch(b.spark, path)).drop("inicio"))


@check("W3_daily_gmv_stream_approximate")
def _(b):
    gmv = orders.daily_gmv_by_state(orders.stream_enrich(_document_stream(b)))
    path = scratch_path(b.spark, "gmv")
    streams.run_available(streams.stream_complete_sink(gmv, path, scratch_path(b.spark, "cp")))
    return _settled(streams.latest_batch(b.spark, path))


@check("W3_customer_sketches", f"""
    SELECT {txt("date_trunc('month', purchase_ts)")} AS inicio, customer_state, COUNT(order_id) AS pedidos,
      COUNT(DISTINCT customer_unique_id) AS clientes_exatos, TRUE AS within FROM ({RECORDS}) WHERE purchase_ts IS NOT NULL GROUP BY ALL""")
def _(b):
    """Hours from the stream, days from hours, months from days; ``within``: off by 5 % or by one customer at most."""
    hours, days = scratch_path(b.spark, "hours"), scratch_path(b.spark, "days")
    sketches = orders.customer_sketches(orders.stream_enrich(_document_stream(b)))
    streams.run_available(streams.stream_complete_sink(sketches, hours, scratch_path(b.spark, "cp")))
    orders.roll_up_sketches(streams.latest_batch(b.spark, hours), "day").write.parquet(days)
    months = orders.unique_customers(orders.roll_up_sketches(b.spark.read.parquet(days), "month"))
    records = orders.stream_enrich(b.documents).where("purchase_ts IS NOT NULL")
    people = records.select(F.date_trunc("month", F.col("purchase_ts").cast("timestamp")).alias("inicio"), "customer_state", "customer_unique_id").distinct()
    exact = people.groupBy("inicio", "customer_state").agg(F.count("customer_unique_id").alias("clientes_exatos"))
    off = F.abs(F.col("clientes_unicos") - F.col("clientes_exatos"))
    on = months["inicio"].eqNullSafe(exact["inicio"]) & months["customer_state"].eqNullSafe(exact["customer_state"])
    joined = months.join(exact, on).select(months["inicio"], months["customer_state"], "pedidos", "clientes_unicos", "clientes_exatos")
    return joined.withColumn("within", off <= F.greatest(F.lit(1.0), 0.05 * F.col("clientes_exatos"))).drop("clientes_unicos")


@check("W4_hourly_gmv_by_state", _gmv_sql("hour"))
def _(b):
    return _settled(orders.hourly_gmv_by_state(orders.stream_enrich(b.documents), exact=True))


@check("W5_run_available", "SELECT event_id, event_type FROM events")
def _(b):
    source, target, state = (scratch_path(b.spark, n) for n in ("arriving", "landed", "cp"))
    events = b.table("events").select("event_id", "event_type")
    late = F.col("event_type").isin("error", "signup")
    # Two arrivals, two runs with one checkpoint: the second run reads only the new files.
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(source)
        stream = streams.stream_table_source(b.spark, source, events.schema)
        streams.run_available(streams.stream_append_sink(stream, target, state))
    return b.spark.read.parquet(target)


# ---- change feeds: three rows per key, whose sequence follows from the key's length ----------------------------------

FEEDS = {
    "customers": ("raw_customers", "customer_id", "customer_zip_code_prefix"),
    "sellers": ("raw_sellers", "seller_id", "seller_zip_code_prefix"),
    "products": ("raw_products", "product_id", "product_photos_qty"),
    "category_translation": ("raw_translation", "product_category_name", "product_category_name_english"),
}


def feed(b: Bound, entity: str) -> DataFrame:
    attribute, key, changed = FEEDS[entity]
    base = getattr(b, attribute)
    rows = base.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2))))
    text = base.schema[changed].dataType.typeName() == "string"
    value = F.concat(changed, F.lit(" v"), F.col("n").cast("string")) if text else F.col(changed) + F.col("n")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + (F.length(key) * 31 + F.col("n") * 17) % 100 * 3600)
    return rows.withColumns({
        changed: value, "_ingestao_ts": at, "_fonte": F.lit("feed"), "_versao_ingestao": F.lit("v1"),
    }).drop("n")


def cleaned(b: Bound, entity: str, raw: DataFrame) -> DataFrame:
    if entity == "products":
        return silver.products(raw, b.raw_translation)
    return getattr(silver, entity)(raw)


def _feed_sql(entity: str) -> str:
    """The cleaned feed in SQL, with ``n`` (row of the key) and ``seq``."""
    seq = "(length({k}) * 31 + n * 17) % 100"
    spine = "(VALUES (0), (1), (2)) AS v(n)"
    if entity == "customers":
        return f"""SELECT customer_id, customer_unique_id, lpad(CAST(customer_zip_code_prefix + n AS VARCHAR), 5, '0')
            AS customer_zip_code, lower(trim(customer_city)) AS customer_city, upper(trim(customer_state))
            AS customer_state, {seq.format(k='customer_id')} AS seq FROM b_customers, {spine}"""
    if entity == "sellers":
        return f"""SELECT seller_id, lpad(CAST(seller_zip_code_prefix + n AS VARCHAR), 5, '0') AS seller_zip_code,
            lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state,
            {seq.format(k='seller_id')} AS seq FROM b_sellers, {spine}"""
    if entity == "products":
        return f"""SELECT product_id, product_category, product_photos_qty + n AS product_photos_qty, porte_produto,
            {seq.format(k='product_id')} AS seq FROM s_products, {spine}"""
    return f"""SELECT product_category_name, product_category_name_english || ' v' || CAST(n AS VARCHAR)
        AS product_category_name_english, {seq.format(k='product_category_name')} AS seq FROM b_translation, {spine}"""


_AT = "CAST(to_timestamp(1700000000 + seq * 3600)::TIMESTAMP AS VARCHAR) AS _ingestao_ts"


def _shown(entity: str, df: DataFrame) -> DataFrame:
    if entity == "products":
        df = df.select("product_id", "product_category", "product_photos_qty", "porte_produto", "_ingestao_ts")
    return df.drop("_fonte", "_versao_ingestao")


def _feed_stream(b: Bound, entity: str, reverse: bool = False) -> DataFrame:
    """The feed in three files that arrive one per batch, newest sequence last, or first when ``reverse``."""
    path = scratch_path(b.spark, "feed")
    rows = feed(b, entity)
    hour = F.unix_timestamp("_ingestao_ts") - F.lit(1_700_000_000)
    parts = [rows.where(hour < 33 * 3600), rows.where((hour >= 33 * 3600) & (hour < 66 * 3600)), rows.where(hour >= 66 * 3600)]
    for part in reversed(parts) if reverse else parts:
        part.write.mode("append").parquet(path)
    return streams.stream_table_source(b.spark, path, rows.schema, files_per_trigger=4)


def _cdc(b: Bound, entity: str, reverse: bool) -> DataFrame:
    table = changes.ChangeTable(scratch_path(b.spark, "cdc"), changes.ENTITY_KEYS[entity], "_ingestao_ts")
    query = changes.cdc_scd1(
        _feed_stream(b, entity, reverse), table, scratch_path(b.spark, "cp"), lambda raw: cleaned(b, entity, raw)
    )
    streams.run_available(query)
    return _shown(entity, table.current(b.spark))


for _entity in FEEDS:
    _key = FEEDS[_entity][1]
    check(f"W6_cdc_scd1_{_entity}", f"""
        SELECT * EXCLUDE (seq, rn), {_AT} FROM (SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY seq DESC) AS rn
          FROM ({_feed_sql(_entity)})) WHERE rn = 1""")(
        lambda b, e=_entity: _cdc(b, e, reverse=e in ("customers", "products"))
    )
    check(f"W7_change_view_{_entity}", f"SELECT * EXCLUDE (seq), {_AT} FROM ({_feed_sql(_entity)})")(
        lambda b, e=_entity: _shown(e, _landed(b, cleaned(b, e, _feed_stream(b, e))))
    )


@check("W8_late_data_policy", """
    WITH first_run AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'),
    edge AS (SELECT MAX(ts) - INTERVAL 1 DAY AS w FROM first_run)
    SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS inicio, event_type, COUNT(*) AS eventos
    FROM first_run, edge GROUP BY date_trunc('hour', ts), event_type, w
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= w""")
def _(b):
    source, target, state = (scratch_path(b.spark, n) for n in ("arriving", "landed", "cp"))
    events = b.table("events").select("event_id", "ts", "event_type")
    late = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    # The second arrival is older than the watermark the first one set, so none of it may appear.
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(source)
        stream = orders.watermark(streams.stream_table_source(b.spark, source, events.schema), "ts", "1 day")
        counts = stream.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("eventos"))
        flat = counts.select(F.col("window.start").alias("inicio"), "event_type", "eventos")
        streams.run_available(streams.stream_append_sink(flat, target, state))
    return b.spark.read.parquet(target)


@check("W9_stream_load_report", f"""
    SELECT customer_state, {dbl('SUM(total_order_value)')} AS gmv_total, COUNT(order_id) AS pedidos FROM ({RECORDS})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(b):
    gmv = orders.daily_gmv_by_state(orders.stream_enrich(b.documents), exact=True)
    return orders.stream_load_report(gmv).withColumn("gmv_total", F.round("gmv_total", 2))


@check("W9_monthly_load_report", f"""
    SELECT {txt("CAST(date_trunc('month', purchase_ts) AS DATE)")} AS mes, COUNT(order_id) AS total_pedidos,
      {dbl('SUM(total_order_value)')} AS gmv, floor({dbl('SUM(total_order_value)')} / COUNT(total_order_value) * 1000 + 0.500001) / 1000
      AS ticket_medio FROM ({RECORDS}) GROUP BY 1""")
def _(b):
    report = orders.monthly_load_report(orders.stream_enrich(b.documents))
    return report.withColumns({
        "mes": F.to_date("mes"), "gmv": F.round("gmv", 2), "ticket_medio": _thousandths(F.col("ticket_medio")),
    })
