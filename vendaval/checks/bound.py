"""The test tables read as marketplace tables.

Raw tables carry the dirt the clean layer removes: mixed case, blanks, unknown codes, missing dates, values outside
their range. Everything is a function of the given rows, so the work grows with them. ``oracle.py`` states the same
expressions in SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ladders import risk_band
from ..operators.quality import apply_rules
from ..plans import gold, silver
from ..session import scratch_path
from ..sources.documents import assemble_orders, read_nested_json, write_json
from ..sources.files import read_table

AS_OF = date(2001, 8, 15)
STAMP = datetime(2024, 6, 1, 12, 0, 0)
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
    "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
SKUS = {
    "view": "STANDARD_DLT_CORE", "click": "SERVERLESS_SQL_COMPUTE", "purchase": "MODEL_SERVING",
    "signup": "SERVERLESS_COMPUTE_INTERACTIVE", "error": "STORAGE",
}
PRIORITIES = {
    "1-URGENT": "credit_card", "2-HIGH": "boleto", "3-MEDIUM": "voucher", "4-NOT SPECIFIED": " Debit_Card ",
}


def _case(value: Column, mapping: dict[str, str], other: str) -> Column:
    out = None
    for key, label in mapping.items():
        out = F.when(value == key, label) if out is None else out.when(value == key, label)
    return out.otherwise(other)


def _state(nation: str) -> Column:
    return F.lower(F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col(nation) + 1))


def _later(ts: Column, hours: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) + hours * 3600)


class Bound:
    """Canonical frames over one folder of test tables. Plans are built once per instance and never cached as data."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def stream_path(self, table: str) -> str:
        """The same table as a pattern: a file stream takes a folder or a pattern, and the table may be one file."""
        return f"{self.folder}/{table[:-1]}[{table[-1]}].parquet"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    # ---- raw -----------------------------------------------------------------------------------------------------

    @cached_property
    def raw_orders(self) -> DataFrame:
        return raw_orders(self.table("orders"))

    @cached_property
    def raw_customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.cast("string").alias("customer_id"),
            F.concat(F.lit("u"), F.floor(k / 2).cast("string")).alias("customer_unique_id"),
            ((k * 37) % 100000).cast("int").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("customer_city"),
            F.concat(_state("c_nationkey"), F.lit(" ")).alias("customer_state"),
        )

    @cached_property
    def raw_sellers(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            k.cast("string").alias("seller_id"),
            ((k * 53) % 100000).cast("int").alias("seller_zip_code_prefix"),
            F.concat(F.lit(" City "), (k % 40).cast("string")).alias("seller_city"),
            _state("s_nationkey").alias("seller_state"),
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        return self.table("part").select(
            k.cast("string").alias("product_id"),
            F.when(k % 41 != 0, _category()).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (size * 10).alias("product_description_lenght"),
            (size % 6).alias("product_photos_qty"),
            F.when(k % 31 != 0, size * 150).alias("product_weight_g"),
            (size + 10).alias("product_length_cm"),
            (k % 20 + 5).cast("int").alias("product_height_cm"),
            (k % 15 + 8).cast("int").alias("product_width_cm"),
        )

    @cached_property
    def raw_translation(self) -> DataFrame:
        known = self.table("part").where(F.col("p_type") != "ECONOMY").select(_category().alias("product_category_name"))
        english = F.concat(F.lit("en "), F.translate("product_category_name", "_", " "))
        return known.distinct().withColumn("product_category_name_english", english)

    @cached_property
    def raw_items(self) -> DataFrame:
        price, tax = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_tax").cast("decimal(4,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (price * tax).cast("decimal(10,2)").alias("freight_value"),
        )

    @cached_property
    def raw_payments(self) -> DataFrame:
        k, total = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)")
        split = k % 5 == 0
        parts = F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        rows = self.table("orders").withColumn("seq", F.explode(parts))
        share = F.when(~split, F.lit("0.25")).when(F.col("seq") == 1, F.lit("0.15")).otherwise(F.lit("0.10"))
        kind = F.when(F.col("seq") == 2, "voucher").otherwise(_case(F.col("o_orderpriority"), PRIORITIES, "not_defined"))
        return rows.select(
            k.cast("string").alias("order_id"),
            F.col("seq").alias("payment_sequential"),
            kind.alias("payment_type"),
            (k % 10 + 1).cast("int").alias("payment_installments"),
            (total * share.cast("decimal(3,2)")).cast("decimal(10,2)").alias("payment_value"),
        )

    def _raw_reviews(self, orders: DataFrame, text: Column) -> DataFrame:
        k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        created = _later(day, (k % 40 + 10) * 24)
        score = F.when(k % 97 == 0, None).when(k % 89 == 0, 6).otherwise((k * 7) % 11 % 5 + 1)
        return orders.where(k % 4 != 3).select(
            F.concat(F.lit("r"), k.cast("string")).alias("review_id"),
            k.cast("string").alias("order_id"),
            score.cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            text.alias("review_comment_message"),
            created.alias("review_creation_date"),
            _later(created, k % 100).alias("review_answer_timestamp"),
        )

    @cached_property
    def raw_reviews(self) -> DataFrame:
        """Reviews with the text of the document of the same number, where there is one."""
        texts = self.table("documents").select(F.col("doc_id").alias("o_orderkey"), "text")
        return self._raw_reviews(self.table("orders").join(texts, "o_orderkey", "left"), F.col("text"))

    @cached_property
    def raw_scores(self) -> DataFrame:
        """The same reviews without text, for marts that read only the score."""
        return self._raw_reviews(self.table("orders"), F.lit(None).cast("string"))

    @cached_property
    def raw_geolocation(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            (k % 300).cast("int").alias("geolocation_zip_code_prefix"),
            F.col("c_acctbal").alias("geolocation_lat"),
            (F.col("c_nationkey") * 1.5).alias("geolocation_lng"),
            F.concat(F.lit(" "), "c_mktsegment").alias("geolocation_city"),
            _state("c_nationkey").alias("geolocation_state"),
        )

    def with_lineage(self, df: DataFrame, key: str) -> DataFrame:
        """Lineage columns whose sequence follows from the key."""
        step = (F.crc32(F.col(key)) % 1000).cast("bigint")
        return df.withColumns({
            "_ingestao_ts": F.timestamp_seconds(F.lit(1_700_000_000) + step), "_fonte": F.lit("feed"),
            "_versao_ingestao": F.lit("v1"),
        })

    @cached_property
    def documents(self) -> DataFrame:
        """Nested order documents."""
        return assemble_orders(
            self.raw_orders, self.raw_customers, self.raw_items, self.raw_payments, self.raw_scores
        )

    @cached_property
    def json_documents(self) -> DataFrame:
        """The same documents, landed as JSON lines and read back."""
        path = scratch_path(self.spark, "landing")
        write_json(self.documents, path)
        return read_nested_json(self.spark, path)

    # ---- clean ---------------------------------------------------------------------------------------------------

    def _ruled(self, df: DataFrame, table: str) -> DataFrame:
        return apply_rules(df, silver.RULES[table])

    @cached_property
    def orders(self) -> DataFrame:
        return self._ruled(silver.orders(self.raw_orders), "orders")

    @cached_property
    def customers(self) -> DataFrame:
        return self._ruled(silver.customers(self.raw_customers), "customers")

    @cached_property
    def sellers(self) -> DataFrame:
        return self._ruled(silver.sellers(self.raw_sellers), "sellers")

    @cached_property
    def items(self) -> DataFrame:
        return self._ruled(silver.items(self.raw_items), "items")

    @cached_property
    def payments(self) -> DataFrame:
        return self._ruled(silver.payments(self.raw_payments), "payments")

    @cached_property
    def reviews(self) -> DataFrame:
        return self._ruled(silver.reviews(self.raw_reviews), "reviews")

    @cached_property
    def scores(self) -> DataFrame:
        return self._ruled(silver.reviews(self.raw_scores), "reviews")

    @cached_property
    def translation(self) -> DataFrame:
        return self._ruled(silver.category_translation(self.raw_translation), "category_translation")

    @cached_property
    def products(self) -> DataFrame:
        return self._ruled(silver.products(self.raw_products, self.raw_translation), "products")

    @cached_property
    def geolocation(self) -> DataFrame:
        return self._ruled(silver.geolocation(self.raw_geolocation), "geolocation")

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return self._ruled(silver.orders_enriched(self.orders, self.customers, self.payments), "orders_enriched")

    @cached_property
    def items_enriched(self) -> DataFrame:
        return self._ruled(silver.items_enriched(self.items, self.products, self.sellers), "items_enriched")

    # ---- marts ---------------------------------------------------------------------------------------------------

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fato_vendas_diarias(self.orders, self.items)

    @cached_property
    def rfm(self) -> DataFrame:
        return gold.dim_clientes_rfm(self.orders, self.customers, self.items, AS_OF)

    @cached_property
    def product_mart(self) -> DataFrame:
        return gold.dim_produtos_performance(self.products, self.items, self.orders, self.scores, AS_OF)

    @cached_property
    def seller_mart(self) -> DataFrame:
        return gold.dim_sellers_score(self.sellers, self.items, self.orders, self.scores)

    @cached_property
    def features(self) -> DataFrame:
        return gold.features_ml(self.orders_enriched, self.items_enriched)

    @cached_property
    def predictions(self) -> DataFrame:
        """Predictions of a fixed rule, so that reports on them can be checked in SQL."""
        k = F.col("order_id").cast("bigint")
        late = F.col("label") * 300
        p = ((k * 7919) % 701 + late).cast("double") / 1024.0
        scored = self.features.withColumn("probabilidade_falha", p)
        return scored.withColumns({
            "predicao_atraso": (F.col("probabilidade_falha") > 0.5).cast("int"),
            "risco_atraso": risk_band(F.col("probabilidade_falha")),
            "modelo_versao": F.concat(F.lit("v"), (k % 3 + 1).cast("string")),
            "scored_at": F.lit(STAMP).cast("timestamp"),
        })

    @cached_property
    def labelled_reviews(self) -> DataFrame:
        """Reviews with a rule sentiment and a second labelling that departs from it now and then."""
        k = F.substring("review_id", 2, 20).cast("bigint")
        base = self.scores.select(
            "review_id", "order_id", "review_score", F.col("review_sentiment").alias("sentimento_regra")
        )
        return base.withColumn("sentimento_modelo", _relabel(k))

    # ---- usage ---------------------------------------------------------------------------------------------------

    @cached_property
    def usage(self) -> DataFrame:
        user = F.col("user_id")
        sku = _case(F.col("event_type"), SKUS, "OTHER")
        return self.table("events").select(
            F.to_date(F.col("ts")).alias("usage_date"),
            sku.alias("sku_name"),
            F.concat(F.lit("ORIGIN_"), (user % 3).cast("string")).alias("billing_origin_product"),
            F.col("value").cast("decimal(14,4)").alias("usage_quantity"),
            F.struct(
                F.concat(F.lit("c"), (user % 7).cast("string")).alias("cluster_id"),
                F.concat(F.lit("w"), (user % 4).cast("string")).alias("warehouse_id"),
                F.concat(F.lit("j"), (user % 5).cast("string")).alias("job_id"),
            ).alias("usage_metadata"),
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Two dated prices per sku, from the range of its usage: ten days, then open-ended."""
        span = self.usage.groupBy("sku_name").agg(F.min("usage_date").alias("a"))
        base = (F.length("sku_name") % 5 + 1).cast("decimal(4,0)") * F.lit("0.07").cast("decimal(3,2)")
        first = F.struct(
            base.cast("decimal(8,4)").alias("preco"), F.col("a").alias("s"), F.date_add("a", 9).alias("e")
        )
        second = F.struct(
            (base * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(8,4)").alias("preco"),
            F.date_add("a", 10).alias("s"), F.lit(None).cast("date").alias("e"),
        )
        both = span.select("sku_name", F.inline(F.array(first, second)))
        return both.select(
            "sku_name", F.struct(F.col("preco").alias("default")).alias("pricing"),
            F.col("s").alias("price_start_time"), F.col("e").alias("price_end_time"),
        )

    @cached_property
    def pipeline_events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.concat(F.lit("flow_"), (F.col("user_id") % 4).cast("string")).alias("pipeline_name"),
            "event_type",
            F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )


def _category() -> Column:
    return F.concat_ws("_", F.lower("p_type"), F.translate(F.lower("p_brand"), "#", "_"))


def _relabel(k: Column) -> Column:
    same = _case(F.col("sentimento_regra"), {"positivo": "Positive", "negativo": "Negative"}, "Neutral")
    return F.when(k % 10 == 0, "Mixed").when(k % 10 == 1, "Positive").when(k % 10 == 2, "Negative").otherwise(same)


def raw_orders(orders: DataFrame) -> DataFrame:
    """Orders with event times from the key: purchase hour, approval (missing for some), carrier, delivery."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    flag = F.col("o_orderstatus")
    status = (
        F.when(k % 50 == 7, "weird").when(k % 50 == 8, "processing").when(k % 50 == 9, "invoiced")
        .when(flag == "F", " Delivered ").when(flag == "O", "shipped").otherwise("CANCELED")
    )
    bought = _later(day, k % 24)
    approved = F.when(k % 23 != 0, _later(bought, k % 48))
    carrier = F.when(flag != "P", _later(bought, k % 5 * 24 + 60))
    delivered = F.when(flag == "F", _later(bought, (k % 70 + 5) * 24 + k % 3))
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _later(day, F.lit(30 * 24)).alias("order_estimated_delivery_date"),
    )
