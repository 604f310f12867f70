"""Machine learning (ML1-ML9) and text (TX1-TX7)."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.ladders import risk_band
from ..operators import retrieval
from ..plans import ml, text
from .aggregates import AGREE
from .bound import STAMP, Bound
from .joins import FIRST_LINE
from .oracle import half_up, mean, pct, pct_where
from .registry import check


def _split(b: Bound) -> tuple[DataFrame, DataFrame, DataFrame]:
    return ml.split_once(b.features, ["order_id"])


def _code(state: str) -> str:
    """Index of a state: most frequent first, then by name; a missing one follows after all others."""
    ranks = f"(SELECT {state} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {state}) - 1 AS k FROM g_features WHERE {state} IS NOT NULL GROUP BY 1)"
    return f"coalesce((SELECT k FROM {ranks} WHERE v = f.{state}), (SELECT COUNT(DISTINCT {state}) FROM g_features))"


_INPUT_SUM = " + ".join(
    f"coalesce(CAST(f.{c} AS DOUBLE), {1.0 if c in fixed.MODEL_FILL_ONE else 0.0})" for c in fixed.MODEL_NUMERIC
) + "".join(f" + {_code(c)}" for c in fixed.MODEL_STATES)


@check("ML1_late_delivery_features", f"""
    SELECT order_id, label, {len(ml.INPUTS)} AS inputs, round({_INPUT_SUM}, 4) AS s FROM g_features f""")
def _(b):
    from pyspark.ml import Pipeline

    data = ml.prepare(b.features)
    fitted = Pipeline(stages=ml.feature_stages()).fit(data)
    vectors = fitted.transform(data).select("order_id", "label", vector_to_array("features").alias("v"))
    return vectors.select(
        "order_id", "label", F.size("v").alias("inputs"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 4).alias("s")
    )


@check("ML2_train_logistic_regressions")
def _(b):
    _all, train, test = _split(b)
    runs, _models = ml.run_experiments(train, test)
    return runs.select("run", "reg", "iterations", "elastic_net", "weighted", *[
        F.round(c, 3).alias(c) for c in ("auc_roc", "auc_pr", "accuracy", "precision", "recall", "f1")
    ])


@check("ML3_class_weights", """
    SELECT order_id, label, CASE WHEN label = 1 THEN round((SELECT CAST(COUNT(*) FILTER (WHERE label = 0) AS DOUBLE)
      / COUNT(*) FILTER (WHERE label = 1) FROM g_features), 9) ELSE 1.0 END AS weight FROM g_features""")
def _(b):
    weighted = ml.class_weights(b.features.select("order_id", "label"))
    return weighted.withColumn("weight", F.round("weight", 9))


_CELLS = """SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
      CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1, CAST(tn AS DOUBLE) / (tn + fn) AS p0,
      CAST(tn AS DOUBLE) / (tn + fp) AS r0, tp + fp + fn + tn AS n, tp + fn AS n1, tn + fp AS n0 FROM (
      SELECT COUNT(*) FILTER (WHERE label = 1 AND predicao_atraso = 1) AS tp,
        COUNT(*) FILTER (WHERE label = 0 AND predicao_atraso = 1) AS fp,
        COUNT(*) FILTER (WHERE label = 1 AND predicao_atraso = 0) AS fn,
        COUNT(*) FILTER (WHERE label = 0 AND predicao_atraso = 0) AS tn FROM g_predictions)"""


@check("ML4_class_metrics", f"""
    SELECT tp, fp, fn, tn, round((tp + tn) / CAST(n AS DOUBLE), 6) AS accuracy,
      round((p1 * n1 + p0 * n0) / n, 6) AS weighted_precision, round((r1 * n1 + r0 * n0) / n, 6) AS weighted_recall,
      round((2 * p1 * r1 / (p1 + r1) * n1 + 2 * p0 * r0 / (p0 + r0) * n0) / n, 6) AS weighted_f1,
      round(p1, 6) AS precision_atraso, round(r1, 6) AS recall_atraso, round(2 * p1 * r1 / (p1 + r1), 6) AS f1_atraso
    FROM ({_CELLS})""")
def _(b):
    return ml.class_metrics(b.predictions)


@check("ML4_evaluate_held_out")
def _(b):
    _all, train, test = _split(b)
    metrics = ml.evaluate(ml.predict(ml.train_lr(train, 0.01, 100, 0.0, weighted=False), test))
    row = [F.struct(F.lit(n).alias("metric"), F.lit(round(v, 3)).alias("value")) for n, v in metrics.items()]
    return test.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(F.array(*row)))


@check("ML4_auc_by_ranks", """
    WITH r AS (SELECT label, rank() OVER (ORDER BY probabilidade_falha) + (COUNT(*) OVER (PARTITION BY probabilidade_falha) - 1) / 2.0 AS r
      FROM g_predictions),
    n AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS n1, COUNT(*) FILTER (WHERE label = 0) AS n0,
        SUM(CAST(r AS DOUBLE)) FILTER (WHERE label = 1) AS s FROM r)
    SELECT round((s - n1 * (n1 + 1) / 2.0) / (CAST(n1 AS DOUBLE) * n0), 6) AS auc_roc FROM n""")
def _(b):
    ranked = BinaryClassificationEvaluator(rawPredictionCol="probabilidade_falha", labelCol="label", numBins=0)
    auc = ranked.evaluate(b.predictions.select(F.col("label").cast("double"), "probabilidade_falha"))
    return b.predictions.agg(F.lit(round(auc, 6)).alias("auc_roc"))


@check("ML5_confusion_matrix", "SELECT label, predicao_atraso, COUNT(*) AS total FROM g_predictions GROUP BY 1, 2")
def _(b):
    return ml.confusion_matrix(b.predictions)


@check("ML6_coef_importance")
def _(b):
    _all, train, _test = _split(b)
    table = ml.coef_importance(ml.train_lr(train, 0.01, 100, 0.0, weighted=False), train)
    return table.select("feature", F.round("importance", 2).alias("importance"))


# Runs are the model versions of the prediction table, judged on their own rows.
@check("ML7_select_best", """
    WITH runs AS (SELECT modelo_versao AS run, CAST(COUNT(*) FILTER (WHERE predicao_atraso = label) AS DOUBLE) / COUNT(*)
        AS accuracy, CAST(COUNT(*) FILTER (WHERE predicao_atraso = 1 AND label = 1) AS DOUBLE)
        / COUNT(*) FILTER (WHERE label = 1) AS recall FROM g_predictions GROUP BY 1)
    SELECT 'accuracy' AS metric, (SELECT run FROM runs ORDER BY accuracy DESC, run LIMIT 1) AS run,
      round((SELECT MAX(accuracy) FROM runs), 9) AS value
    UNION ALL SELECT 'recall', (SELECT run FROM runs ORDER BY recall DESC, run LIMIT 1),
      round((SELECT MAX(recall) FROM runs), 9)""")
def _(b):
    late, said = F.col("label") == 1, F.col("predicao_atraso") == 1
    right = F.col("label") == F.col("predicao_atraso")
    runs = b.predictions.groupBy(F.col("modelo_versao").alias("run")).agg(
        (F.count_if(right) / F.count(F.lit(1))).alias("accuracy"),
        (F.count_if(late & said) / F.count_if(late)).alias("recall"),
    )
    return ml.select_best(runs, metrics=("accuracy", "recall")).withColumn("value", F.round("value", 9))


@check("ML8_score_batch")
def _(b):
    features, train, _test = _split(b)
    model = ml.train_lr(train, 0.01, 100, 0.0, weighted=False)
    scored = ml.score_batch(model, features, "v1", "late_delivery", STAMP)
    return scored.withColumn("probabilidade_falha", F.round("probabilidade_falha", 3))


@check("ML8_score_batch_consistent", """
    SELECT order_id, label, true AS faixa_certa, true AS classe_certa, 'v1' AS modelo_versao FROM g_features""")
def _(b):
    features, train, _test = _split(b)
    scored = ml.score_batch(ml.train_lr(train, 0.01, 100, 0.0, weighted=False), features, "v1", "late_delivery", STAMP)
    p = F.col("probabilidade_falha")
    return scored.select(
        "order_id", "label", ((p >= 0) & (p <= 1) & (F.col("risco_atraso") == risk_band(p))).alias("faixa_certa"),
        ((p > 0.5).cast("int") == F.col("predicao_atraso")).alias("classe_certa"), "modelo_versao",
    )


@check("ML9_risk_band_analysis", f"""
    SELECT risco_atraso, COUNT(*) AS total_pedidos, COUNT(*) FILTER (WHERE label = 1) AS realmente_atrasados,
      {pct_where('label = 1')} AS taxa_real_pct, round(avg(probabilidade_falha), 3) AS prob_media,
      {mean('total_pago', 2)} AS ticket_medio,
      {half_up('(COUNT(*) * 100)', '(SELECT COUNT(*) FROM g_predictions)', 1)} AS pct FROM g_predictions GROUP BY 1""")
def _(b):
    return ml.risk_band_analysis(b.predictions)


# ---- text -----------------------------------------------------------------------------------------------------------

@check("TX1_score_sentiment_rule", """
    SELECT review_id, CASE WHEN review_score >= 4 THEN 'positivo' WHEN review_score = 3 THEN 'neutro' ELSE 'negativo' END
      AS sentimento_regra FROM b_reviews""")
def _(b):
    return text.score_sentiment_rule(b.raw_scores).select("review_id", "sentimento_regra")


@check("TX2_sentiment_model")
def _(b):
    labels = b.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    documents = b.table("documents").select("doc_id", "text")
    model = text.sentiment_model(documents.join(labels, "doc_id"))
    return text.classify_text(model, documents).select("doc_id", "predicted")


@check("TX2_sentiment_model_beats_majority", """
    SELECT COUNT(*) AS documentos, true AS melhor FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def _(b):
    labels = b.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    known = b.table("documents").select("doc_id", "text").join(labels, "doc_id")
    said = text.classify_text(text.sentiment_model(known), known)
    right = F.avg((F.col("predicted") == F.col("label")).cast("double"))
    share = F.avg("label")
    return said.agg(F.count(F.lit(1)).alias("documentos"), (right > F.greatest(share, 1 - share)).alias("melhor"))


@check("TX3_label_distribution", f"""
    SELECT sentimento_modelo, COUNT(*) AS total,
      {half_up('(COUNT(*) * 100)', '(SELECT COUNT(*) FROM t_labelled)', 1)} AS pct FROM t_labelled GROUP BY 1""")
def _(b):
    return text.label_distribution(b.labelled_reviews)


@check("TX3_compare_labels", f"""
    SELECT {pct(f"COUNT(*) FILTER (WHERE {AGREE})", "COUNT(*)", 1)} AS taxa_concordancia_pct,
      COUNT(*) AS total_avaliados FROM t_labelled""")
def _(b):
    return text.compare_labels(b.labelled_reviews)


@check("TX3_label_cross_tab", """
    SELECT sentimento_regra, sentimento_modelo, COUNT(*) AS total FROM t_labelled GROUP BY 1, 2""")
def _(b):
    from ..operators.aggregates import cross_tab

    return cross_tab(b.labelled_reviews, "sentimento_regra", "sentimento_modelo")


_CASE_COLUMNS = ("review_id", "review_score", "sentimento_modelo", "sentimento_regra")


@check("TX3_divergent_cases", f"""
    SELECT {', '.join(_CASE_COLUMNS)} FROM t_labelled
    WHERE (review_score >= 4 AND sentimento_modelo = 'Negative') OR (review_score <= 2 AND sentimento_modelo = 'Positive')
    ORDER BY review_score DESC, review_id LIMIT 15""")
def _(b):
    return text.divergent_cases(b.labelled_reviews, "review_id").select(*_CASE_COLUMNS)


@check("TX3_ambiguous_cases", f"""
    SELECT {', '.join(_CASE_COLUMNS)} FROM t_labelled WHERE sentimento_modelo = 'Mixed' ORDER BY review_id LIMIT 10""")
def _(b):
    return text.ambiguous_cases(b.labelled_reviews, "review_id").select(*_CASE_COLUMNS)


@check("TX4_sentiment_by_delivery", f"""
    SELECT r.sentimento_modelo, o.status_entrega, COUNT(*) AS total, {mean('o.delta_entrega_dias', 1, 0)} AS delta_medio_dias,
      {mean('r.review_score', 2, 0)} AS score_medio FROM t_labelled r JOIN s_orders o ON r.order_id = o.order_id
    GROUP BY 1, 2""")
def _(b):
    return text.sentiment_by_delivery(b.labelled_reviews, b.orders)


@check("TX4_late_share_by_sentiment", f"""
    SELECT r.sentimento_modelo, COUNT(*) AS total_pedidos, COUNT(*) FILTER (WHERE o.status_entrega = 'atrasado')
      AS atrasados, {pct_where("o.status_entrega = 'atrasado'")} AS pct_atrasado
    FROM t_labelled r JOIN s_orders o ON r.order_id = o.order_id WHERE o.status_entrega IN ('no_prazo', 'atrasado')
    GROUP BY 1""")
def _(b):
    return text.late_share_by_sentiment(b.labelled_reviews, b.orders)


@check("TX5_build_review_documents", f"""
    SELECT r.review_id, concat_ws(chr(10),
        'Review (score ' || CAST(r.review_score AS VARCHAR) || '/5): ' || r.review_message,
        'Categoria: ' || coalesce(i.product_category, 'N/A'), 'Estado cliente: ' || coalesce(o.customer_state, 'N/A'),
        'Estado vendedor: ' || coalesce(i.seller_state, 'N/A'),
        'Entrega: ' || coalesce(o.status_entrega, 'N/A') || ' (delta: '
          || coalesce(CAST(o.delta_entrega_dias AS VARCHAR), 'N/A') || ' dias)') AS documento
    FROM s_reviews r JOIN s_orders_enriched o ON r.order_id = o.order_id JOIN {FIRST_LINE} i ON r.order_id = i.order_id
    WHERE length(trim(r.review_message)) > 10""")
def _(b):
    documents = text.build_review_documents(b.reviews, b.orders_enriched, b.items_enriched)
    return documents.select("review_id", "documento")


# One query vector per label: the first of the label.
_TOP = """WITH q AS (SELECT MIN(vec_id) AS qid FROM embeddings GROUP BY label),
    pairs AS (SELECT q.qid AS query_id, c.vec_id AS neighbour_id, c.label AS got, e.label AS want,
        round(list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score
      FROM q JOIN embeddings e ON e.vec_id = q.qid JOIN embeddings c ON c.vec_id <> q.qid{where}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id) AS rank FROM pairs)"""


def _queries(vectors: DataFrame) -> DataFrame:
    first = vectors.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("f"))
    return first.select("f.vec_id", "f.embedding")


@check("TX6_similar_top_k", f"""{_TOP.format(where='')}
    SELECT query_id, neighbour_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def _(b):
    vectors = b.table("embeddings")
    found = retrieval.similar_top_k(_queries(vectors), vectors, 10)
    return found.withColumn("score", F.round("score", 6))


@check("TX6_similar_top_k_filtered", f"""{_TOP.format(where=' AND c.label IN (1, 3, 5)')}
    SELECT query_id, neighbour_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 5""")
def _(b):
    vectors = b.table("embeddings")
    found = retrieval.similar_top_k(_queries(vectors), vectors.where(F.col("label").isin(1, 3, 5)), 5)
    return found.withColumn("score", F.round("score", 6))


@check("TX6_similar_top_k_all_pairs_of_blocks", """
    WITH pairs AS (SELECT e.vec_id AS query_id, c.vec_id AS neighbour_id,
        round(list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score
      FROM embeddings e JOIN embeddings c ON c.vec_id <> e.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id) AS rank FROM pairs)
    SELECT query_id, neighbour_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 3""")
def _(b):
    vectors = b.table("embeddings")
    found = retrieval.similar_top_k(vectors, vectors, 3, query_rows=200, corpus_rows=150)
    return found.withColumn("score", F.round("score", 6))


@check("TX7_precision_at_k", f"""{_TOP.format(where='')}
    SELECT COUNT(*) AS queries, round(avg(p), 6) AS precision_at_k FROM (
      SELECT query_id, COUNT(*) FILTER (WHERE got = want) / 10.0 AS p FROM ranked WHERE rank <= 10 GROUP BY 1)""")
def _(b):
    vectors = b.table("embeddings")
    found = retrieval.similar_top_k(_queries(vectors), vectors, 10)
    return retrieval.precision_by_label(found, vectors.select("vec_id", "label"), 10)
