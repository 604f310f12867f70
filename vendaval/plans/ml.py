"""Late-delivery model on Spark ML: features, training, evaluation, batch scoring.

One fitted model carries the state encodings from training to scoring, so both use the same codes.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, ladders
from ..functions import scalars as S
from ..operators.windows import share_of_total, train_test_split
from ..session import cut_lineage

INPUTS = [*fixed.MODEL_NUMERIC, *[f"{c}_idx" for c in fixed.MODEL_STATES]]


def prepare(features: DataFrame) -> DataFrame:
    """Inputs as doubles with their fill values."""
    fills = {c: (1.0 if c in fixed.MODEL_FILL_ONE else 0.0) for c in fixed.MODEL_NUMERIC}
    return features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()})


def feature_stages() -> list:
    """State indexers that keep unseen states, then the assembler."""
    indexer = StringIndexer(
        inputCols=list(fixed.MODEL_STATES), outputCols=[f"{c}_idx" for c in fixed.MODEL_STATES], handleInvalid="keep"
    )
    return [indexer, VectorAssembler(inputCols=INPUTS, outputCol="features", handleInvalid="skip")]


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Weight (1 - p) / p for the positive class, where p is its share; 1 for the other.

    The two counts are a scalar subquery, so rows are not moved.
    """
    counts = df.agg(F.struct(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).alias("n"))
    n = counts.scalar()
    weight = F.try_divide(n["neg"].cast("double"), n["pos"].cast("double"))
    return df.withColumn(name, F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))


def split_once(features: DataFrame, keys: list[str], test_share: float = 0.2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The features, and their two sides stratified by label: all three read rows that are written once.

    Cut-offs, encodings, training, scoring and counts each pass over their rows, which must not build the features again.
    """
    written = cut_lineage(features, "features")
    return written, *train_test_split(written, keys, test_share, stratify="label")


def train_lr(train: DataFrame, reg: float, iterations: int, elastic_net: float, weighted: bool) -> PipelineModel:
    """Fit encodings and classifier together. Runs the training jobs."""
    data = prepare(train)
    if weighted:
        data = class_weights(data)
    lr = LogisticRegression(
        featuresCol="features", labelCol="label", regParam=reg, maxIter=iterations, elasticNetParam=elastic_net
    )
    if weighted:
        lr = lr.setWeightCol("weight")
    return Pipeline(stages=[*feature_stages(), lr]).fit(data)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Adds the predicted class and the probability of the positive one."""
    scored = model.transform(prepare(features))
    return scored.withColumns({
        "predicao_atraso": F.col("prediction").cast("int"),
        "probabilidade_falha": vector_to_array("probability")[1],
    })


def score_batch(
    model: PipelineModel, features: DataFrame, version: str, name: str, scored_at: datetime
) -> DataFrame:
    """Prediction table: order, place, money, label, class, probability, risk band, model and time."""
    scored = predict(model, features).withColumn("risco_atraso", ladders.risk_band(F.col("probabilidade_falha")))
    stamped = scored.withColumns({
        "modelo_versao": F.lit(version), "modelo_nome": F.lit(name), "scored_at": F.lit(scored_at).cast("timestamp"),
    })
    return stamped.select(
        "order_id", "customer_id", "customer_state", "seller_state", "total_pago", "total_frete", "qtd_itens",
        "peso_medio_kg", "label", "predicao_atraso", "probabilidade_falha", "risco_atraso", "modelo_versao",
        "modelo_nome", "scored_at",
    )


def confusion_matrix(predictions: DataFrame, label: str = "label", predicted: str = "predicao_atraso") -> DataFrame:
    return predictions.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("total")).orderBy(label, predicted)


def class_metrics(predictions: DataFrame, label: str = "label", predicted: str = "predicao_atraso") -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted over both classes and of the positive class. One scan."""
    y, p = F.col(label), F.col(predicted)
    cells = predictions.agg(
        S.count_where((y == 1) & (p == 1)).alias("tp"), S.count_where((y == 0) & (p == 1)).alias("fp"),
        S.count_where((y == 1) & (p == 0)).alias("fn"), S.count_where((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def safe(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    prec1, rec1, prec0, rec0 = safe(tp, tp + fp), safe(tp, tp + fn), safe(tn, tn + fn), safe(tn, tn + fp)
    f1, f0 = safe(2 * prec1 * rec1, prec1 + rec1), safe(2 * prec0 * rec0, prec0 + rec0)
    rows = tp + fp + fn + tn

    def weighted(one: Column, zero: Column) -> Column:
        return safe(one * (tp + fn) + zero * (tn + fp), rows)

    values = {
        "accuracy": safe(tp + tn, rows),
        "weighted_precision": weighted(prec1, prec0), "weighted_recall": weighted(rec1, rec0),
        "weighted_f1": weighted(f1, f0),
        "precision_atraso": prec1, "recall_atraso": rec1, "f1_atraso": f1,
    }
    return cells.select("tp", "fp", "fn", "tn", *[F.round(v, 6).alias(n) for n, v in values.items()])


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """Ranking and class metrics of transformed rows. Runs the evaluation jobs.

    The rows are written once with the few columns the metrics read, so the model is applied a single time.
    """
    scored = cut_lineage(predictions.select("label", "rawPrediction", F.col("prediction").cast("int").alias("said")))
    ranked = BinaryClassificationEvaluator(labelCol="label")
    out = {
        name: ranked.evaluate(scored, {ranked.metricName: metric})
        for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR"))
    }
    classed = class_metrics(scored, predicted="said").first()
    for name, column in (
        ("accuracy", "accuracy"), ("precision", "weighted_precision"), ("recall", "weighted_recall"),
        ("f1", "weighted_f1"),
    ):
        out[name] = classed[column]
    return out


def coef_importance(model: PipelineModel, like: DataFrame) -> DataFrame:
    """Model inputs by absolute coefficient: one row per input."""
    weights = [(n, float(w)) for n, w in zip(INPUTS, model.stages[-1].coefficients.toArray(), strict=True)]
    table = like.sparkSession.createDataFrame(weights, "feature string, coefficient double")
    return table.withColumn("importance", F.abs("coefficient")).orderBy(F.desc("importance"), "feature")


def run_experiments(train: DataFrame, test: DataFrame) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every configuration and tabulate its held-out metrics, one row per configuration.

    Both sides are written once; every configuration then reads the same materialised rows.
    """
    train, test = cut_lineage(train, "train"), cut_lineage(test, "test")
    models, table = {}, []
    for name, reg, iterations, net, weighted in fixed.MODEL_RUNS:
        model = train_lr(train, reg, iterations, net, weighted)
        metrics = evaluate(predict(model, test))
        models[name] = model
        table.append((name, reg, iterations, net, weighted, *[float(v) for v in metrics.values()]))
    columns = (
        "run string, reg double, iterations int, elastic_net double, weighted boolean, auc_roc double, "
        "auc_pr double, accuracy double, precision double, recall double, f1 double"
    )
    return train.sparkSession.createDataFrame(table, columns), models


def select_best(runs: DataFrame, key: str = "run", metrics: tuple[str, ...] = ("f1", "auc_roc")) -> DataFrame:
    """Per metric: the winning run and its value; on a tie the first name."""
    best = [
        F.struct(
            F.lit(m).alias("metric"),
            F.min_by(key, F.struct(-F.col(m), F.col(key))).alias(key),
            F.max(m).cast("double").alias("value"),
        ).alias(m)
        for m in metrics
    ]
    return runs.agg(*best).select(F.inline(F.array(*[F.col(m) for m in metrics])))


def risk_band_analysis(predictions: DataFrame) -> DataFrame:
    """Size, share, real late rate, mean probability and mean ticket per risk band."""
    late = F.col("label") == 1
    grouped = predictions.groupBy("risco_atraso").agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        S.count_where(late).alias("realmente_atrasados"),
        S.percent_where(late).alias("taxa_real_pct"),
        F.round(F.avg("probabilidade_falha"), 3).alias("prob_media"),
        S.mean_of("total_pago", 2).alias("ticket_medio"),
    )
    return share_of_total(grouped, "total_pedidos", few=True)
