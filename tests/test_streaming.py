"""Streams: restart, lateness, change feeds, and batch twins."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from vendaval import schemas
from vendaval.sources import documents, streams
from vendaval.streaming import changes, orders

EVENT = "id int, ts timestamp, state string"


def test_restart_reads_only_new_files(spark, tmp_path, rows_of):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.createDataFrame([], "id int").schema

    def run():
        streams.run_available(streams.stream_append_sink(streams.stream_table_source(spark, source, schema), out, cp))
        return rows_of(spark.read.parquet(out))

    spark.range(3).select(F.col("id").cast("int")).write.parquet(source)
    assert run() == [(0,), (1,), (2,)]
    assert run() == [(0,), (1,), (2,)]  # nothing new
    spark.range(3, 5).select(F.col("id").cast("int")).write.mode("append").parquet(source)
    assert run() == [(0,), (1,), (2,), (3,), (4,)]


def test_late_rows_do_not_reopen_a_window(spark, tmp_path, frame, at, rows_of):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run(*rows):
        frame(EVENT, *rows).write.mode("append").parquet(source)
        stream = orders.watermark(streams.stream_table_source(spark, source, frame(EVENT).schema), "ts", "1 day")
        counts = stream.groupBy(F.window("ts", "1 day")).agg(F.count("id").alias("n"))
        streams.run_available(streams.stream_append_sink(counts.select(F.to_date("window.start").cast("string").alias("d"), "n"), out, cp))
        return rows_of(spark.read.schema("d string, n long").parquet(out))

    assert run((1, at("2024-01-01T10:00:00"), "a"), (2, at("2024-01-05T10:00:00"), "a")) == [("2024-01-01", 1)]
    # The second run brings a row for a closed day and one for a day that is still open.
    got = run((3, at("2024-01-01T11:00:00"), "a"), (4, at("2024-01-05T12:00:00"), "a"), (5, at("2024-01-09T00:00:00"), "a"))
    assert got == [("2024-01-01", 1), ("2024-01-05", 2)]


def test_change_table_ignores_arrival_order_and_replay(spark, tmp_path, rows_of):
    rnd = random.Random(0)
    feed = [(f"k{rnd.randint(0, 5)}", rnd.randint(0, 4), f"v{i}") for i in range(40)]
    schema = "customer_id string, seq int, v string"
    best = {}
    for k, seq, v in feed:
        best[k] = max(best.get(k, (-1, "")), (seq, v))
    expected = sorted((k, *v) for k, v in best.items())
    for attempt in range(2):
        rnd.shuffle(feed)
        table = changes.ChangeTable(str(tmp_path / f"t{attempt}"), ["customer_id"], "seq")
        for batch in range(4):
            table.apply(spark.createDataFrame(feed[batch * 10:batch * 10 + 10], schema), batch)
        table.apply(spark.createDataFrame(feed[30:], schema), 3)  # the last batch is run again
        assert rows_of(table.current(spark), "customer_id", "seq", "v") == expected
        packed = table.compact(spark, str(tmp_path / f"c{attempt}"))
        assert rows_of(packed.current(spark), "customer_id", "seq", "v") == expected
        packed.apply(spark.createDataFrame([("k0", 99, "new")], schema), 4)
        assert ("k0", 99, "new") in rows_of(packed.current(spark), "customer_id", "seq", "v")


def test_cdc_query_feeds_the_table(spark, tmp_path, rows_of):
    source = str(tmp_path / "in")
    schema = spark.createDataFrame([], "customer_id string, seq int, v string").schema
    table = changes.ChangeTable(str(tmp_path / "t"), ["customer_id"], "seq")

    def run(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(source)
        query = changes.cdc_scd1(streams.stream_table_source(spark, source, schema), table, str(tmp_path / "cp"),
                                 lambda raw: raw.withColumn("v", F.upper("v")))
        streams.run_available(query)
        return rows_of(table.current(spark))

    assert run(("a", 3, "x"), ("b", 1, "y")) == [("a", 3, "X"), ("b", 1, "Y")]
    assert run(("a", 1, "late"), ("b", 2, "z")) == [("a", 3, "X"), ("b", 2, "Z")]


def test_fresh_checkpoint_replaces_no_earlier_batch(spark, tmp_path, rows_of):
    schema = spark.createDataFrame([], "customer_id string, seq int, v string").schema
    table = changes.ChangeTable(str(tmp_path / "t"), ["customer_id"], "seq")
    for n, row in enumerate((("a", 1, "x"), ("b", 1, "y"))):  # the first source is gone when the second run starts
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([row], schema).write.parquet(source)
        streams.run_available(changes.cdc_scd1(streams.stream_table_source(spark, source, schema), table, str(tmp_path / f"cp{n}")))
    assert rows_of(table.current(spark), "customer_id", "seq", "v") == [("a", 1, "x"), ("b", 1, "y")]


def test_complete_sink_keeps_the_newest_results(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(5):
        spark.range(n + 1).write.mode("append").parquet(source)
        counts = streams.stream_table_source(spark, source, spark.range(1).schema).groupBy().count()
        streams.run_available(streams.stream_complete_sink(counts, out, str(tmp_path / "cp")))
        assert streams.latest_batch(spark, out).first()[0] == sum(range(1, n + 2))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batch=3", "batch=4"]


def _docs(spark, n=60):
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        when = f"2024-01-{1 + i % 4:02d} {rnd.randint(0, 23):02d}:00:00"
        pays = [(1, "boleto", 1, float(rnd.randint(1, 100)))] + ([(2, "voucher", 1, None)] if i % 15 == 0 else [])
        rows.append((f"o{i}", "delivered", (f"c{i}", f"u{i % 7}", "1", "x", "SP" if i % 2 else "RJ"),
                     (when, None, None, None, when), [], pays, (f"r{i}", rnd.randint(1, 5), None, None, None, None)))
    return spark.createDataFrame(rows, schemas.order_document())


def test_stream_equals_batch(spark, tmp_path, rows_of):
    docs = _docs(spark)
    path = str(tmp_path / "days")
    documents.write_daily_json(docs, path)
    stream = streams.stream_json_source(spark, path, schemas.order_document(streaming=True), files_per_trigger=3)
    records = orders.stream_enrich(stream)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    streams.run_available(streams.stream_complete_sink(orders.customer_days(records), out, cp))
    measures = ["data", "customer_state", "total_pedidos", "gmv", "reviews_negativos", "clientes_unicos"]
    streamed = orders.roll_up_customer_days(streams.latest_batch(spark, out))
    batch = orders.daily_gmv_by_state(orders.stream_enrich(docs), exact=True)
    assert rows_of(streamed, *measures) == rows_of(batch, *measures)


def test_landed_documents_are_compressed_and_read_back_whole(spark, tmp_path, rows_of):
    docs = _docs(spark)
    for write, name in ((documents.write_json, "flat"), (documents.write_daily_json, "days")):
        write(docs, str(tmp_path / name))
        files = [p for p in (tmp_path / name).rglob("part-*")]
        assert files and all(p.name.endswith(".json.gz") for p in files)
        back = documents.read_nested_json(spark, str(tmp_path / name)).select(docs.columns)
        assert rows_of(back) == rows_of(docs)


def test_null_payment_makes_the_total_null_unless_skipped(spark):
    docs = _docs(spark).where("order_id = 'o0'")
    assert orders.stream_enrich(docs).first().total_order_value is None
    assert orders.stream_enrich(docs, skip_null_payments=True).first().total_order_value > 0
