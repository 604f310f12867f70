"""Upserts, incremental loads, snapshots and layout: TM1-TM9."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import versions
from ..plans import gold
from ..session import scratch_path
from ..sources.files import write_partitioned
from .bound import Bound
from .oracle import txt
from .registry import check
from .tables import FACT_SQL

# Existing customers of one state move; suppliers arrive as new customers.
CHANGES = """
    SELECT customer_id, customer_unique_id, '00001' AS customer_zip_code, 'curitiba' AS customer_city,
      'PR' AS customer_state FROM s_customers WHERE customer_state = 'RJ'
    UNION ALL SELECT 'n' || seller_id, 'n' || seller_id, seller_zip_code, seller_city, seller_state FROM s_sellers"""
AFTER = f"""
    SELECT customer_id, coalesce(t.customer_unique_id, s.customer_unique_id) AS customer_unique_id,
      coalesce(t.customer_zip_code, s.customer_zip_code) AS customer_zip_code,
      coalesce(s.customer_city, t.customer_city) AS customer_city,
      coalesce(s.customer_state, t.customer_state) AS customer_state
    FROM s_customers t FULL JOIN ({CHANGES}) s USING (customer_id)"""


def _changes(b: Bound) -> DataFrame:
    moved = b.customers.where("customer_state = 'RJ'").withColumns({
        "customer_zip_code": F.lit("00001"), "customer_city": F.lit("curitiba"), "customer_state": F.lit("PR"),
    })
    new_id = F.concat(F.lit("n"), "seller_id")
    arrived = b.sellers.select(
        new_id.alias("customer_id"), new_id.alias("customer_unique_id"), F.col("seller_zip_code").alias("customer_zip_code"),
        F.col("seller_city").alias("customer_city"), F.col("seller_state").alias("customer_state"),
    )
    return moved.unionByName(arrived)


def _after(b: Bound) -> DataFrame:
    return versions.upsert(b.customers, _changes(b), ["customer_id"], ["customer_city", "customer_state"])


@check("TM1_upsert", AFTER)
def _(b):
    return _after(b)


@check("TM1_upsert_by_sequence", """
    SELECT k AS id, CASE WHEN k % 3 <> 0 THEN 'novo' ELSE 'velho' END AS estado,
      CASE WHEN k % 3 <> 0 THEN 5 + k % 3 ELSE 6 END AS seq FROM b_orders""")
def _(b):
    k = F.col("o_orderkey")
    orders = b.table("orders")
    target = orders.select(k.alias("id"), F.lit("velho").alias("estado"), F.lit(6).cast("bigint").alias("seq"))
    source = orders.select(k.alias("id"), F.lit("novo").alias("estado"), (k % 3 + 5).alias("seq"))
    return versions.upsert(target, source, ["id"], ["estado", "seq"], sequence="seq")


@check("TM2_make_change_set", """
    SELECT customer_id, customer_unique_id, CASE customer_id WHEN '1' THEN '00001' ELSE '20000' END AS customer_zip_code,
      CASE customer_id WHEN '1' THEN 'curitiba' ELSE 'niteroi' END AS customer_city,
      CASE customer_id WHEN '1' THEN 'PR' ELSE 'RJ' END AS customer_state FROM s_customers WHERE customer_id IN ('1', '2')
    UNION ALL VALUES ('NOVO_1', 'U_1', '90000', 'porto alegre', 'RS'), ('NOVO_2', 'U_2', '40000', 'salvador', 'BA')""")
def _(b):
    return versions.make_change_set(
        b.customers, "customer_id",
        {
            "1": {"customer_zip_code": "00001", "customer_city": "curitiba", "customer_state": "PR"},
            "2": {"customer_zip_code": "20000", "customer_city": "niteroi", "customer_state": "RJ"},
        },
        [
            {"customer_id": "NOVO_1", "customer_unique_id": "U_1", "customer_zip_code": "90000",
             "customer_city": "porto alegre", "customer_state": "RS"},
            {"customer_id": "NOVO_2", "customer_unique_id": "U_2", "customer_zip_code": "40000",
             "customer_city": "salvador", "customer_state": "BA"},
        ],
    )


@check("TM3_delete_insert_by_key", f"SELECT {FACT_SQL} FROM g_fact")
def _(b):
    # The fact as it stood in July, then one incremental run that sees all orders.
    then = b.orders.where(F.col("order_purchase_timestamp") < F.lit("2001-07-20").cast("timestamp"))
    stored = scratch_path(b.spark, "fact")
    gold.fato_vendas_diarias(then, b.items).write.parquet(stored)
    return gold.fato_vendas_incremental(b.spark.read.parquet(stored), b.orders, b.items)


@check("TM3_refresh_touched_days", f"SELECT {FACT_SQL} FROM g_fact")
def _(b):
    # The same run on a fact stored by day: only the partitions of recent days are written again.
    then = b.orders.where(F.col("order_purchase_timestamp") < F.lit("2001-07-20").cast("timestamp"))
    stored = scratch_path(b.spark, "fact")
    write_partitioned(gold.fato_vendas_diarias(then, b.items), stored, "data_venda")
    gold.refresh_fato_vendas(stored, b.orders, b.items)
    fact = b.spark.read.parquet(stored)
    return fact.select("data_venda", *[c for c in fact.columns if c != "data_venda"])


def _history(b: Bound) -> DataFrame:
    """Customers written by versions 0, 1 and 2; version n rewrites every n+1-th customer."""
    k = F.col("c_custkey")
    rows = b.table("customer").withColumn("version", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return rows.where(k % (F.col("version") + 1) == 0).select(
        k.alias("id"), F.concat_ws("_", "c_mktsegment", F.col("version").cast("string")).alias("segmento"), "version"
    )


@check("TM4_snapshot_as_of", """
    SELECT c_custkey AS id, c_mktsegment || '_' || CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS VARCHAR)
      AS segmento, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS version FROM customer""")
def _(b):
    return versions.snapshot_as_of(_history(b), ["id"], 1)


def _published(b: Bound) -> str:
    path = scratch_path(b.spark, "snapshots")
    versions.publish_snapshot(b.customers, path, 0)
    versions.publish_snapshot(_after(b), path, 1)
    return path


@check("TM4_read_snapshot", "SELECT * FROM s_customers")
def _(b):
    return versions.read_snapshot(b.spark, _published(b), 0)


@check("TM5_diff_versions", f"""
    SELECT customer_id, CASE WHEN t.customer_state IS NULL THEN 'added' ELSE 'changed' END AS change,
      t.customer_city AS customer_city_before, s.customer_city AS customer_city_after,
      t.customer_state AS customer_state_before, s.customer_state AS customer_state_after
    FROM s_customers t FULL JOIN ({AFTER}) s USING (customer_id)
    WHERE t.customer_state IS DISTINCT FROM s.customer_state OR t.customer_city IS DISTINCT FROM s.customer_city""")
def _(b):
    return versions.diff_versions(b.customers, _after(b), "customer_id", ["customer_city", "customer_state"])


@check("TM5_label_versions", f"""
    SELECT 'antes' AS versao, customer_id, customer_state FROM s_customers WHERE customer_city = 'curitiba'
    UNION ALL SELECT 'depois', customer_id, customer_state FROM ({AFTER}) WHERE customer_city = 'curitiba'""")
def _(b):
    both = versions.label_versions({"antes": b.customers, "depois": _after(b)})
    return both.where("customer_city = 'curitiba'").select("versao", "customer_id", "customer_state")


@check("TM6_restore_snapshot", "SELECT * FROM s_customers")
def _(b):
    path = _published(b)
    versions.restore_snapshot(b.spark, path, 0, as_version=2)
    return versions.read_snapshot(b.spark, path, 2)


@check("TM7_compact", "SELECT 4 AS arquivos, COUNT(*) AS registros FROM lineitem")
def _(b):
    small, large = scratch_path(b.spark, "small"), scratch_path(b.spark, "large")
    b.table("lineitem").repartition(32).write.parquet(small)
    versions.compact(b.spark.read.parquet(small), large, 4)
    return versions.table_stats(b.spark, {"lineitem": large}).select("arquivos", "registros")


@check("TM8_cluster_by", f"SELECT l_orderkey, l_partkey, l_suppkey, {txt('l_shipdate')} AS l_shipdate FROM lineitem")
def _(b):
    path = scratch_path(b.spark, "clustered")
    lines = b.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    versions.cluster_by(lines, ["l_partkey", "l_shipdate"], 8).write.parquet(path)
    return b.spark.read.parquet(path)


@check("TM9_table_stats", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, COUNT(*) AS registros FROM {t}" for t in ("orders", "lineitem", "events")))
def _(b):
    stats = versions.table_stats(b.spark, {t: b.path(t) for t in ("orders", "lineitem", "events")})
    return stats.select("tabela", "registros")
