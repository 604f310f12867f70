"""Windows, versions, governance, retrieval, samples: against plain Python on small inputs."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendaval.operators import aggregates, governance, joins, profiles, quality, retrieval, rows, versions, windows
from vendaval.plans import ml, text, usage


def test_dedupe_latest_takes_the_newest_then_the_tie_break(frame, rows_of):
    df = frame("k string, seq int, v string", ("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), (None, 1, "q"), (None, 2, "r"))
    assert rows_of(windows.dedupe_latest(df, ["k"], ["seq", "v"])) == [("a", 3, "z"), ("b", None, "n"), (None, 2, "r")]


def test_surrogate_key_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(10_000), 3000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r.v: r.n for r in windows.surrogate_key(df, ["v"], "n").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("block", [7, 50, 1000])
def test_moving_average_in_blocks_equals_the_plain_window(spark, block):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i, rnd.randint(0, 500) if i % 9 else None) for i in range(200)], "i int, v int")
    plain = windows.moving_average(df, "i", {"m": "v"}, 7).orderBy("i").collect()
    blocks = windows.moving_average_blocks(df, ["i"], {"m": "v"}, 7, block=block).orderBy("i").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in blocks]


@pytest.mark.parametrize("few", [True, False])
def test_shares_add_up(spark, few):
    df = spark.createDataFrame([(f"g{i % 7}",) for i in range(100)], "g string")
    shares = windows.group_share(df, ["g"], digits=6, few=few)
    assert abs(float(shares.agg(F.sum("pct")).first()[0]) - 100) < 1e-4


def test_samples_repeat_and_splits_cover(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    first = {r.id for r in windows.sample_random_n(df, 100, ["id"]).collect()}
    again = {r.id for r in windows.sample_random_n(df.repartition(9), 100, ["id"]).collect()}
    assert first == again and len(first) == 100
    train, test = windows.train_test_split(df, ["id"], 0.2, stratify="label")
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    for label in (0, 1):
        share = test.where(F.col("label") == label).count() / df.where(F.col("label") == label).count()
        assert abs(share - 0.2) < 0.005
    picked = windows.sample_stratified(df, "label", {0: 0.0, 1: 1.0})
    assert picked.count() == 500


def _upsert_oracle(target, source, sequence):
    state = dict(target)
    for k, (seq, v) in source.items():
        if k not in state or not sequence or seq >= state[k][0]:
            state[k] = (seq, v)
    return sorted((k, *v) for k, v in state.items())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("sequence", [None, "seq"])
def test_upsert_matches_a_dictionary_and_is_idempotent(spark, rows_of, seed, sequence):
    rnd = random.Random(seed)
    target = {k: (rnd.randint(0, 9), f"t{k}") for k in rnd.sample(range(40), 20)}
    source = {k: (rnd.randint(0, 9), f"s{k}") for k in rnd.sample(range(40), 15)}

    def frame_of(d):
        return spark.createDataFrame([(k, *v) for k, v in d.items()], "k int, seq int, v string")

    changes = frame_of(source)
    once = versions.upsert(frame_of(target), changes, ["k"], ["seq", "v"], sequence)
    assert sorted(rows_of(once)) == sorted(_upsert_oracle(target, source, sequence))
    assert rows_of(versions.upsert(once, changes, ["k"], ["seq", "v"], sequence)) == rows_of(once)


def test_upsert_keeps_unlisted_columns_and_rejects_double_keys(frame, rows_of):
    target = frame("k int, a string, b string", (1, "a1", "b1"))
    source = frame("k int, a string, b string", (1, "A", "B"), (2, "A2", "B2"))
    assert rows_of(versions.upsert(target, source, ["k"], ["a"])) == [(1, "A", "b1"), (2, "A2", "B2")]
    with pytest.raises(Exception, match="more than once"):
        versions.upsert(target, source.union(source), ["k"], ["a"]).collect()


@pytest.mark.parametrize("seed", range(3))
def test_merge_latest_does_not_depend_on_order(spark, rows_of, seed):
    rnd = random.Random(seed)
    changes = [(rnd.randint(0, 8), rnd.randint(0, 5), f"v{i}") for i in range(60)]
    states = []
    for _ in range(3):
        rnd.shuffle(changes)
        state = spark.createDataFrame([], "k int, seq int, v string")
        for part in (changes[:20], changes[20:40], changes[40:], changes[:20]):
            state = versions.merge_latest(state, spark.createDataFrame(part, state.schema), ["k"], "seq").coalesce(2)
        states.append(rows_of(state))
    best = {}
    for k, seq, v in changes:
        best[k] = max(best.get(k, (-1, "")), (seq, v))
    assert states == [sorted(((k, *v) for k, v in best.items()), key=lambda r: str(r[0]))] * 3


def test_snapshots(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    for version, rows_ in enumerate(([(1, "a")], [(1, "b"), (2, "c")])):
        versions.publish_snapshot(spark.createDataFrame(rows_, "k int, v string"), path, version)
    versions.restore_snapshot(spark, path, 0, as_version=2)
    assert [rows_of(versions.read_snapshot(spark, path, v)) for v in (0, 1, 2)] == [
        [(1, "a")], [(1, "b"), (2, "c")], [(1, "a")]]
    diff = versions.diff_versions(versions.read_snapshot(spark, path, 0), versions.read_snapshot(spark, path, 1), "k", ["v"])
    assert rows_of(diff) == [(1, "changed", "a", "b"), (2, "added", None, "c")]
    with pytest.raises(Exception, match="exists"):
        versions.publish_snapshot(spark.range(1), path, 1)


def test_layout_jobs(spark, tmp_path):
    df = spark.range(4000).select(F.col("id"), (F.col("id") * 37 % 1000).alias("a"), (F.col("id") * 91 % 1000).alias("b"))
    clustered, plain = str(tmp_path / "z"), str(tmp_path / "p")
    versions.cluster_by(df, ["a", "b"], 16, bits=4).write.parquet(clustered)
    versions.compact(df.repartition(40), plain, 16)
    stats = {r.tabela: r for r in versions.table_stats(spark, {"z": clustered, "p": plain}).collect()}
    assert stats["z"].registros == stats["p"].registros == 4000 and stats["p"].arquivos == 16

    def files_hit(path):
        hits = spark.read.parquet(path).groupBy("_metadata.file_path").agg(
            F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
        return hits.where("a0 <= 100 AND a1 >= 50 AND b0 <= 100 AND b1 >= 50").count()

    assert files_hit(clustered) <= 4 < files_hit(plain)


def test_compact_deals_rows_in_small_parts(spark, tmp_path, monkeypatch, rows_of):
    from pyspark.sql.classic.dataframe import DataFrame

    dealt, usual = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, n, *columns: dealt.append(n) or usual(df, n, *columns))
    df = spark.range(6000).select("id", F.lit("x").alias("_file"), F.when(F.col("id") > 9, F.col("id")).alias("n"))
    path = str(tmp_path / "c")
    versions.compact(df, path, 3)
    assert min(dealt) >= 3 * 8  # no task is dealt a whole file
    files = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
    assert len(files) == 3 and all(1800 < f["count"] < 2200 for f in files)
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    versions.compact(df.where("false"), path, 3)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_effective_dated_join_edges(frame, rows_of):
    from datetime import date

    d = [date(2024, 1, n) for n in range(1, 32)]
    use = frame("sku string, day date", ("a", d[9]), ("a", d[10]), ("a", d[29]), ("b", d[0]))
    prices = frame("sku string, p int, s date, e date", ("a", 1, d[0], d[9]), ("a", 2, d[10], None))
    got = joins.effective_dated_join(use, prices, "sku", "day", "s", "e")
    assert rows_of(got, "sku", "day", "p") == sorted([("a", d[9], 1), ("a", d[10], 2), ("a", d[29], 2), ("b", d[0], None)], key=str)


def test_effective_dated_join_meets_every_valid_price(spark, rows_of):
    """Overlaps, same starts, ends before starts, open ends, gaps and nulls, against the plain interval join."""
    import random
    from datetime import date, timedelta

    rng, day0 = random.Random(5), date(2023, 1, 1)
    days = lambda: None if rng.random() < 0.05 else day0 + timedelta(days=rng.randrange(200))
    keys = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    use = spark.createDataFrame([(i, keys(), days()) for i in range(300)], "n int, sku string, day date")
    prices = spark.createDataFrame([(i, keys(), days(), days()) for i in range(60)], "p int, sku string, s date, e date")
    got = joins.effective_dated_join(use, prices, "sku", "day", "s", "e", slice_days=20)
    assert got.columns == ["n", "sku", "day", "p", "s", "e"]
    on = (F.col("u.sku") == F.col("p.sku")) & (F.col("day") >= F.col("s")) & (F.col("e").isNull() | (F.col("day") <= F.col("e")))
    plain = use.alias("u").join(prices.alias("p"), on, "left").select("n", "u.sku", "day", "p", "s", "e")
    assert rows_of(got) == rows_of(plain)


def test_effective_dated_join_without_prices_or_usage(frame, rows_of):
    from datetime import date

    use = frame("sku string, day date", ("a", date(2024, 1, 1)))
    prices = frame("sku string, p int, s date, e date", ("a", 1, date(2024, 1, 1), None))
    assert rows_of(joins.effective_dated_join(use, prices.limit(0), "sku", "day", "s", "e"), "sku", "p") == [("a", None)]
    assert rows_of(joins.effective_dated_join(use.limit(0), prices, "sku", "day", "s", "e")) == []


def test_usage_categories_and_fragments(frame, rows_of):
    from datetime import date

    day = date(2024, 1, 1)
    meta = ("c1", "w1", "j1")
    schema = "usage_date date, sku_name string, billing_origin_product string, usage_quantity decimal(14,4), " \
             "usage_metadata struct<cluster_id:string,warehouse_id:string,job_id:string>"
    df = frame(schema, (day, "X_DLT_1", "A", Decimal("1"), meta), (day, "SERVERLESS_SQL", "A", Decimal("3"), meta), (day, "OTHER", "PIPELINES", Decimal("4"), meta))
    assert dict((r[0], float(r[1])) for r in usage.category_totals(df).select("categoria_workload", "pct_total").collect()) == {
        "DLT Pipelines": 12.5, "SQL Warehouse": 37.5, "Outros": 50.0}
    assert {r.sku_name for r in usage.workload_usage(df, "dlt").collect()} == {"X_DLT_1", "OTHER"}
    assert {r.sku_name for r in usage.workload_usage(df, "notebook").collect()} == set()


def test_row_and_column_access(frame, rows_of):
    df = frame("seller_id string, seller_state string", ("a", "AM"), ("b", "SP"), ("c", None))
    assert rows_of(governance.row_filter(df, "seller_state", ["Regiao_Norte"])) == [("a", "AM")]
    assert governance.row_filter(df, "seller_state", []).count() == 3
    assert governance.column_view(df, "clean.sellers", "analista_jr").columns == ["seller_state"]
    assert governance.column_view(df, "clean.sellers", "admin").columns == df.columns
    with pytest.raises(ValueError):
        governance.column_view(df, "clean.sellers", "somebody")
    with pytest.raises(ValueError):
        governance.column_view(df, "clean.reviews", "analista_jr")
    both = {"n": ["AM"], "s": ["SP"]}
    assert governance.row_filter(df, "seller_state", ["n", "s"], both).count() == 2


def test_pii_values_and_masks(frame):
    df = frame("t string", ("mail a.b@c.com now",), ("call (11) 98765-4321",), ("id 123.456.789-09",), ("zip 01310-100",), ("plain",), (None,))
    hits = {r.categoria: r.hits for r in governance.pii_scan_values(df, ["t"]).collect()}
    assert (hits["EMAIL"], hits["TELEFONE"], hits["DOCUMENTO"], hits["CEP"], hits["CARTAO"]) == (1, 1, 1, 1, 0)
    masked = [r.t for r in governance.mask_columns(df, {"t": "redact"}).collect()]
    cases = {
        "pay 4111 1111 1111 1111 now": "pay <CARTAO> now", "4111-1111-1111-1111.": "<CARTAO>.", "n 4111111111111111": "n <CARTAO>",
        "cpf 123.456.789-09, tel 11 98765-4321": "cpf <DOCUMENTO>, tel <TELEFONE>", "(11) 1234-5678": "<TELEFONE>", "41111111111111112222": "41111111111111112222",
    }
    got = governance.mask_columns(frame("t string, u string", *[(t, t) for t in cases]), {"u": "redact"}).collect()
    assert {r.t: r.u for r in got} == cases
    cards = frame("t string", *[(t,) for t in list(cases)[:3]])
    assert {r.categoria: r.hits for r in governance.pii_scan_values(cards, ["t"]).collect()}["TELEFONE"] == 0
    assert masked[0] == "mail <EMAIL> now" and masked[4] == "plain" and masked[5] is None
    kinds = {r.categoria: (r.tipo_pii, r.acao_recomendada) for r in governance.pii_classify(governance.pii_scan_values(df, ["t"])).collect()}
    assert kinds["CEP"] == ("QUASI_IDENTIFICADOR", "REVIEW") and kinds["EMAIL"] == ("IDENTIFICADOR_DIRETO", "MASKING")


def _brute(vectors, queries, k):
    unit = {i: np.array(v) / (np.linalg.norm(v) or 1) for i, v in vectors}
    out = set()
    for q in queries:
        scored = sorted(((-round(float(unit[q] @ u), 9), i) for i, u in unit.items() if i != q))[:k]
        out |= {(q, i, n + 1) for n, (_, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("rows", [2048, 7])
def test_similar_top_k_is_exact_in_any_blocks(spark, rows):
    rnd = random.Random(3)
    vectors = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(60)] + [(60, [0.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    wanted = list(range(0, 60, 6))
    found = retrieval.similar_top_k(df.where(F.col("vec_id").isin(wanted)), df, 4, query_rows=rows, corpus_rows=rows)
    assert {(r.query_id, r.neighbour_id, r["rank"]) for r in found.collect()} == _brute(vectors, wanted, 4)


def test_similar_top_k_groups_stay_bounded(spark, monkeypatch):
    """Ten times the corpus makes more groups, not larger ones, and nothing is pulled to the driver."""
    sizes = []
    keep = retrieval._best
    monkeypatch.setattr(retrieval.DataFrame, "toPandas", lambda self: 1 / 0, raising=False)
    for n in (100, 1000):
        df = spark.range(n).selectExpr("id AS vec_id", "array(sin(id), cos(id)) AS embedding")
        plan = retrieval.similar_top_k(df.limit(5), df, 2, query_rows=5, corpus_rows=50)
        slices = df.selectExpr(f"pmod(xxhash64(vec_id, embedding, 7), {-(-n // 50)}) AS s").groupBy("s").count().agg(F.max("count")).first()[0]
        sizes.append(slices)
        assert plan.count() == 10
    assert keep is retrieval._best and max(sizes) < 2 * 50 and sizes[1] < 2 * sizes[0]


def test_similar_top_k_sends_no_row_more_often_than_copies(spark, monkeypatch):
    """Small blocks asked for on large tables grow, so that rows are not sent once for each of hundreds of blocks."""
    monkeypatch.setattr(retrieval, "COPIES", 3)
    df = spark.range(90).selectExpr("id AS vec_id", "array(sin(id), cos(id)) AS embedding")
    met = []
    real = retrieval._grid
    monkeypatch.setattr(retrieval, "_grid", lambda *a: met.append(real(*a)) or met[-1])
    found = retrieval.similar_top_k(df, df, 2, query_rows=5, corpus_rows=5)
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    assert {(r.query_id, r.neighbour_id, r["rank"]) for r in found.collect()} == _brute(vectors, range(90), 2)
    assert met == [3, 3] and real(10**6, 200, 8192) == -(-10**6 // 8192)


def test_similar_top_k_ties_after_rounding_go_to_the_smaller_id(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, i * 1e-6]) for i in range(9, 0, -1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = retrieval.similar_top_k(df.where("vec_id = 0"), df, 3).collect()
    assert [(r.neighbour_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_model_rows_are_built_once(spark):
    """Scan, split, training, scoring and counting read what was written: the frame's own plan runs a single time."""
    built = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    rows = [(str(i), i % 2) for i in range(40)]
    features = spark.createDataFrame(rows, "order_id string, label int").mapInArrow(counted, "order_id string, label int")
    whole, train, test = ml.split_once(features, ["order_id"])
    assert whole.count() == train.count() + test.count() == built.value == 40


def test_precision_at_k(frame):
    found = frame("query_id long, neighbour_id long, rank int", (1, 10, 1), (1, 11, 2), (2, 10, 1), (2, 12, 2))
    truth = frame("query_id long, neighbour_id long", (1, 10), (2, 10), (2, 12), (2, 12))
    row = retrieval.precision_at_k(found, truth, 2).first()
    assert (row.queries, row.precision_at_k) == (2, 0.75)


def test_profile_and_drift(spark):
    df = spark.createDataFrame([(0, "a"), (2, "a"), (4, None), (None, "b")], "n int, s string")
    got = {r.column_name: r for r in profiles.profile(df, ["n", "s"]).collect()}
    assert (got["n"].num_nulls, got["n"].num_distinct, got["n"].mean, got["n"].stddev) == (1, 3, 2.0, 2.0)
    far = spark.createDataFrame([(1e9,), (1e9 + 1,), (1e9 + 2,)], "x double")
    assert profiles.profile(far, ["x"], distinct=False).first().stddev == 1.0
    assert float(got["n"].percent_zeros) == 25.0 and got["s"].mean is None
    assert {r.column_name: r.value for r in profiles.top_values(df, ["n", "s"]).collect()} == {"n": "0", "s": "a"}
    same = profiles.drift(df, df, ["s"]).first()
    assert abs(same.kl_divergence) < 1e-12 and abs(same.chi_squared) < 1e-12
    moved = profiles.drift(df.where("s = 'a'"), df.where("s = 'b'"), ["s"]).first()
    assert moved.js_distance == pytest.approx(math.sqrt(math.log(2)), rel=1e-3)


def test_referential_and_reconcile(frame):
    a, b = frame("k int", (1,), (1,), (2,), (None,)), frame("k int", (2,), (3,))
    row = quality.referential_check(a, b, "k").first()
    assert (row.parent_keys, row.child_keys, row.only_parent, row.only_child, row.status) == (2, 2, 1, 1, "DIVERGENTE") and row.same_count
    assert quality.referential_check(a, frame("k int", (2,)), "k").first().status == "OK"
    assert {r.tabela: r.status for r in quality.reconcile_counts({"x": (a, b), "y": (a, a)}).collect()} == {"x": "DIVERGENTE", "y": "OK"}
    assert {r.tabela: r.status for r in quality.table_counts({"x": a, "y": a.limit(0)}).collect()} == {"x": "OK", "y": "VAZIA"}


def test_empty_inputs(frame):
    empty = frame("order_id string, payment_sequential int, payment_type string, payment_group string, payment_installments int, payment_value decimal(10,2)")
    assert aggregates.payment_summary(empty).count() == 0
    assert windows.dedupe_latest(empty, ["order_id"], ["payment_sequential"]).count() == 0
    assert windows.surrogate_key(empty, ["order_id"], "n").count() == 0
    assert rows.union_distinct(empty, empty).count() == 0


def test_class_metrics_and_weights(frame):
    preds = frame("label int, predicao_atraso int", *[(1, 1)] * 3, *[(0, 1)] * 1, *[(1, 0)] * 2, *[(0, 0)] * 4)
    row = ml.class_metrics(preds).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.accuracy) == (3, 1, 2, 4, 0.7)
    assert (row.precision_atraso, row.recall_atraso, row.f1_atraso) == (0.75, 0.6, 0.666667)
    weights = {r.label: r.weight for r in ml.class_weights(frame("label int", *[(1,)] * 2, *[(0,)] * 6)).collect()}
    assert weights == {1: 3.0, 0: 1.0}


def test_best_run_ties_go_to_the_first_name(frame):
    runs = frame("run string, f1 double, auc_roc double", ("b", 0.9, 0.5), ("a", 0.9, 0.7), ("c", 0.1, 0.8))
    assert {r.metric: r.run for r in ml.select_best(runs).collect()} == {"f1": "a", "auc_roc": "c"}


def test_model_keeps_unseen_states_and_its_codes(spark):
    from datetime import datetime

    from vendaval.functions.fixed import MODEL_NUMERIC

    rnd = random.Random(5)
    data = [(f"o{i}", "c", int(rnd.random() < 0.4), "SP" if i % 3 else "RJ", "SP", *[float(rnd.random()) for _ in MODEL_NUMERIC])
            for i in range(200)]
    schema = "order_id string, customer_id string, label int, customer_state string, seller_state string, " + ", ".join(f"{c} double" for c in MODEL_NUMERIC)
    train = spark.createDataFrame(data, schema)
    model = ml.train_lr(train, 0.01, 20, 0.0, weighted=True)
    unseen = train.limit(5).withColumn("customer_state", F.lit("ZZ"))
    scored = ml.score_batch(model, unseen, "v1", "m", datetime(2024, 1, 1)).collect()
    assert len(scored) == 5 and all(r.risco_atraso in ("baixo", "medio", "alto") for r in scored)
    assert ml.coef_importance(model, train).count() == 13


def test_sentiment_model_learns_a_separable_text(spark):
    data = [(f"produto otimo {i}", 1.0) if i % 2 else (f"produto ruim {i}", 0.0) for i in range(60)]
    train = spark.createDataFrame(data, "text string, label double")
    said = text.classify_text(text.sentiment_model(train), train)
    assert said.where("predicted = label").count() == 60


def test_review_document_shows_missing_parts(frame):
    df = frame("review_score int, review_message string, product_category string, customer_state string, seller_state string, status_entrega string, delta_entrega_dias int",
               (5, "bom", None, "SP", None, "no_prazo", -2), (None, "x", "c", "SP", "RJ", None, None))
    got = [r[0] for r in df.select(text.review_document()).collect()]
    assert got[0].split("\n") == ["Review (score 5/5): bom", "Categoria: N/A", "Estado cliente: SP", "Estado vendedor: N/A", "Entrega: no_prazo (delta: -2 dias)"]
    assert got[1].split("\n")[0] == "Categoria: c"  # a missing score drops the first line


def test_chi_squared_tail_known_values(frame):
    from vendaval.functions import scalars

    known = [
        (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (11.070497693516351, 5, 0.05),
        (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (1.0, 1, 0.31731050786291415), (20.0, 1, 7.744216431044087e-06),
        (0.0, 3, 1.0), (5000.0, 4, 0.0), (1e-9, 6, 1.0),
    ]
    df = frame("x double, k bigint, p double", *known)
    for r in df.withColumn("got", scalars.chi_squared_tail(F.col("x"), F.col("k"))).collect():
        assert r.got == pytest.approx(r.p, rel=1e-9, abs=1e-12), r
    odd = frame("x double, k bigint", (1.0, 0), (None, 3), (1.0, None))
    assert {r[0] for r in odd.select(scalars.chi_squared_tail(F.col("x"), F.col("k"))).collect()} == {None}


def test_drift_test_tells_change_from_none(spark):
    from vendaval.operators import profiles

    base = spark.range(4000).select((F.col("id") % 4).alias("v"), F.lit("x").alias("one"))
    moved = spark.range(4000).select(F.when(F.col("id") % 10 == 0, 0).otherwise(F.col("id") % 4).alias("v"), F.lit("x").alias("one"))
    same = {r.column_name: r for r in profiles.drift_test(profiles.drift(base, base, ["v", "one"])).collect()}
    changed = {r.column_name: r for r in profiles.drift_test(profiles.drift(base, moved, ["v"])).collect()}
    assert same["v"].p_value == 1.0 and not same["v"].drifted and same["one"].p_value is None and not same["one"].drifted
    assert changed["v"].p_value < 0.001 and changed["v"].drifted


def test_quantile_sketches_merge_without_rows(spark):
    from vendaval.operators import profiles

    t0 = F.lit("2024-01-01").cast("timestamp")
    df = spark.range(9000).select(
        (t0 + F.make_dt_interval((F.col("id") % 90).cast("int"))).alias("ts"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"),
        F.lit(None).cast("double").alias("none"))
    stored = profiles.quantile_sketches(df, "ts", ["v", "none"])
    assert stored.count() == 2 * stored.select("window_start").distinct().count() >= 6
    got = profiles.merged_quantiles(stored, [0.1, 0.5, 0.9]).collect()
    assert {r.column_name for r in got} == {"v"} and {r.num_values for r in got} == {7200}
    assert all(abs(r.quantile / 9000 - r["at"]) < 0.02 for r in got)
    by_window = profiles.merged_quantiles(stored, [0.5], ["window_start"])
    assert by_window.count() == stored.count() // 2
    assert profiles.merged_quantiles(stored.limit(0)).count() == 0


def test_row_filter_functions_reach_the_scan(spark, tmp_path, rows_of):
    from vendaval.operators import governance

    spark.createDataFrame([("a", "AM"), ("b", "SP"), ("c", None)], "id string, uf string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    names = governance.sql_row_filters(spark, ["Regiao_Norte"])
    seen = df.where(F.call_function(names[0], F.col("uf")))
    assert rows_of(seen, "id") == [("a",)]
    assert "PushedFilters: [In(uf" in seen._jdf.queryExecution().toString() or "In(uf" in seen._jdf.queryExecution().toString()
    governance.sql_row_filters(spark, [])
    assert df.where(F.call_function(names[0], F.col("uf"))).count() == 3
    odd = {"f'n": ["o'x", "back\\slash"]}
    governance.sql_row_filters(spark, ["f'n"], {"odd_filter": "f'n"}, odd)
    texts = spark.createDataFrame([("o'x",), ("back\\slash",), ("other",)], "s string")
    assert texts.where("odd_filter(s)").count() == 2


def test_customer_sketches_roll_up(spark, at):
    from vendaval.streaming import orders as stream_orders

    rows = [(f"o{i}", at(f"2024-01-{1 + i % 20:02d}T{i % 24:02d}:00:00"), "SP", f"c{i % 700}") for i in range(3000)]
    rows += [("n", at("2024-01-05T00:00:00"), None, None)]
    records = spark.createDataFrame(rows, "order_id string, purchase_ts timestamp, customer_state string, customer_unique_id string")
    hours = stream_orders.customer_sketches(records)
    months = stream_orders.unique_customers(stream_orders.roll_up_sketches(stream_orders.roll_up_sketches(hours, "day"), "month"))
    got = {r.customer_state: r for r in months.collect()}
    assert got["SP"].pedidos == 3000 and abs(got["SP"].clientes_unicos - 700) <= 35
    assert got[None].pedidos == 1 and got[None].clientes_unicos == 0
