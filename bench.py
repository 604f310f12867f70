"""Headline queries, timed. Prints one JSON line.

Each name says what runs. Inputs that a query needs in another form (JSON documents, a stored fact) are written before its
timer starts; ``document_assembly`` times the making of the documents by itself.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from vendaval.checks import callables
from vendaval.checks.bound import Bound
from vendaval.plans import bronze, gold
from vendaval.session import build_session, scratch_path
from vendaval.sources.documents import read_nested_json

HEADLINE = {
    "filter_delivered": "PF9_filter_in",
    "csv_write_and_ingest": "IO1_read_csv",
    "batch_orders_ingest_parquet": "B3_batch_orders_ingest",
    "document_assembly": "IO9_assemble_orders",
    "customers_geo_join": "J15_join_geo",
    "dedupe_latest": "WF1_dedupe_latest",
    "orders_enriched": "SV10_silver_orders_enriched",
    "items_enriched": "SV11_silver_items_enriched",
    "daily_sales": "GF1_fato_vendas_diarias",
    "rfm": "GD3_dim_clientes_rfm",
    "product_performance": "GD4_dim_produtos_performance",
    "seller_score": "GD5_dim_sellers_score",
    "places": "GD2_dim_localizacao",
    "ml_features": "GF2_features_ml",
    "category_state": "GF4_gmv_categoria_estado",
    "fraud_features": "GF6_features_fraude",
    "upsert": "TM1_upsert",
    "profile": "DQ11_profile",
    "pii_scan": "GV1_pii_scan_values_documents",
    "gmv_trend": "RP2_daily_gmv_trend",
    "risk_by_segment": "RP17_risk_by_segment",
    "usage_cost": "US5_estimated_cost",
    "similar_top_k": "TX6_similar_top_k",
    "order_stream_with_fixtures": "W1_stream_enrich_landed",
    "cdc_customers": "W6_cdc_scd1_customers",
}


def prepared(spark, folder: str) -> dict:
    """Headlines whose input is written here, outside their timers."""
    b = Bound(spark, folder)
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    b.documents.write.json(landing)
    then = b.orders.where(F.col("order_purchase_timestamp") < F.lit("2001-07-20").cast("timestamp"))
    gold.fato_vendas_diarias(then, b.items).write.parquet(stored)
    return {
        "nested_json_explode": lambda: bronze.order_lines(read_nested_json(spark, landing)),
        "daily_sales_incremental": lambda: gold.fato_vendas_incremental(spark.read.parquet(stored), b.orders, b.items),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    registered = callables()

    def timed(make) -> float:
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed(lambda: registered["GF1_fato_vendas_diarias"](spark, folder))  # starts the JVM's code paths; not counted
    times = {name: timed(lambda q=query: registered[q](spark, folder)) for name, query in HEADLINE.items()}
    times |= {name: timed(make) for name, make in prepared(spark, folder).items()}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale,
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
