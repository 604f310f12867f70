"""Physical plans: what must and must not appear, whatever the size of the data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vendaval.checks import callables
from vendaval.operators import joins, windows
from vendaval.plans import bronze
from vendaval.sources.documents import read_nested_json

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


JOINING = [
    n for n in callables()
    if re.match(r"(J(?!10)|SV1[01]|GD[345]|GF|RP17|US5|DQ12|TM1_upsert$|TX5|IO9)", n)
]


@pytest.mark.parametrize("name", JOINING)
def test_no_pairwise_join(spark, name):
    text = plan(callables()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(callables()["IO4_read_table"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_order_lines_are_narrow(spark, tmp_path):
    path = str(tmp_path / "d")
    callables()  # registry loads
    from vendaval.checks.bound import Bound

    Bound(spark, SMALL).documents.limit(5).write.json(path)
    assert "Exchange" not in plan(bronze.order_lines(read_nested_json(spark, path)))


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    text = plan(windows.dedupe_latest(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert text.count("WindowGroupLimit") >= 2  # one map-side, one after the exchange
    assert text.index("WindowGroupLimit") < text.index("Exchange")


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(windows.top_k(spark.range(1000), [F.desc("id")], 5))


def test_daily_sales_reads_five_columns_of_the_large_table(spark):
    text = plan(callables()["GF1_fato_vendas_diarias"](spark, SMALL))
    schema = re.search(r"ReadSchema: struct<(l_orderkey[^>]*)>", text).group(1)
    assert set(re.findall(r"(l_\w+):", schema)) == {"l_orderkey", "l_partkey", "l_extendedprice", "l_tax"}


def test_review_figures_never_build_the_pairs(spark, frame):
    items = spark.range(1000).select(F.lit("hot").alias("order_id"), (F.col("id") % 5).cast("string").alias("product_id"))
    reviews = spark.range(1000).select(
        F.lit("hot").alias("order_id"), F.col("id").cast("string").alias("review_id"), F.lit(4).alias("review_score"))
    got = joins.join_items_reviews(items, reviews, "product_id")
    assert got.agg(F.sum("total_reviews")).first()[0] == 1_000_000  # counted, from five joined rows
    assert got.select("product_id").count() == 5


def test_recent_orders_reach_the_scan(spark):
    """The cut-off of the incremental fact is a literal, pushed into the parquet scan of the orders."""
    from vendaval.operators import versions

    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    fact = spark.createDataFrame([("1998-07-20",)], "d string").select(F.col("d").cast("date").alias("data_venda"))
    text = plan(versions.lookback(orders, "o_orderdate", fact, "data_venda"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def _rows_by_operator(df, names) -> int:
    """The largest number of rows that any of the named operators put out, adaptive stages included."""
    found, todo = [0], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        if any(n in name for n in names) and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_as_of_prices_cost_their_sum(spark):
    """One key with 20,000 versions and 5,000 days of use: joins and windows put out their sum at most, not their product."""
    start = F.lit("1970-01-01").cast("date")
    prices = spark.range(20_000).select(
        F.lit("hot").alias("sku"), F.date_add(start, F.col("id").cast("int")).alias("s"),
        F.date_add(start, F.col("id").cast("int")).alias("e"), F.col("id").alias("p"))
    use = spark.range(5_000).select(F.lit("hot").alias("sku"), F.date_add(start, (F.col("id") * 3).cast("int")).alias("day"))
    priced = joins.effective_dated_join(use, prices, "sku", "day", "s", "e")
    rows = priced.collect()
    assert len(rows) == 5_000 and all(r.p == (r.day - r.s.replace(year=1970, month=1, day=1)).days for r in rows)
    assert 0 < _rows_by_operator(priced, ("Join", "Window", "Filter")) <= 25_000
