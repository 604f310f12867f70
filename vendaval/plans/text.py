"""Review text: sentiment by score and by model, comparison of labels, enriched documents."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ladders
from ..functions import scalars as S
from ..operators import aggregates, joins
from ..operators.windows import group_share, top_k

# Model label -> rule label counted as agreement.
SAME_SENTIMENT = {"Positive": "positivo", "Negative": "negativo", "Neutral": "neutro"}


def score_sentiment_rule(df: DataFrame, score: str = "review_score", name: str = "sentimento_regra") -> DataFrame:
    return df.withColumn(name, ladders.score_sentiment(F.col(score)))


def sentiment_model(train: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 14) -> PipelineModel:
    """Tokens, stop words, hashed term counts, inverse frequencies, logistic regression. Runs the training jobs.

    Hashing keeps the vocabulary off the driver; the model size is set by ``features`` alone.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern="[^\\p{L}]+"),
        StopWordsRemover(inputCol="_tokens", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=30, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(train)


def classify_text(model: PipelineModel, df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns]
    return model.transform(df).select(*keep, F.col("prediction").cast("int").alias("predicted"))


def label_distribution(df: DataFrame, column: str = "sentimento_modelo") -> DataFrame:
    return group_share(df, [column]).orderBy(F.desc("total"), column)


def compare_labels(df: DataFrame, model: str = "sentimento_modelo", rule: str = "sentimento_regra") -> DataFrame:
    """Percent of rows where the model and the rule agree."""
    return aggregates.agreement_rate(df, model, rule, SAME_SENTIMENT)


def _divergent(model: str) -> Column:
    score, said = F.col("review_score"), F.col(model)
    return ((score >= 4) & (said == "Negative")) | ((score <= 2) & (said == "Positive"))


def divergent_cases(df: DataFrame, key: str, k: int = 15, model: str = "sentimento_modelo") -> DataFrame:
    """Reviews whose score and text point in opposite directions, highest scores first."""
    return top_k(df.where(_divergent(model)), [F.desc("review_score"), key], k)


def ambiguous_cases(df: DataFrame, key: str, k: int = 10, model: str = "sentimento_modelo") -> DataFrame:
    return top_k(df.where(F.col(model) == "Mixed"), [key], k)


def sentiment_by_delivery(df: DataFrame, orders: DataFrame, sentiment: str = "sentimento_modelo") -> DataFrame:
    joined = joins.join_reviews_delivery(df, orders).where("status_entrega IS NOT NULL")
    grouped = joined.groupBy(sentiment, "status_entrega").agg(
        F.count(F.lit(1)).alias("total"), S.mean_of("delta_entrega_dias", 1).alias("delta_medio_dias"),
        S.mean_of("review_score", 2).alias("score_medio"),
    )
    return grouped.orderBy(sentiment, "status_entrega")


def late_share_by_sentiment(df: DataFrame, orders: DataFrame, sentiment: str = "sentimento_modelo") -> DataFrame:
    joined = joins.join_reviews_delivery(df, orders).where(F.col("status_entrega").isin("no_prazo", "atrasado"))
    late = F.col("status_entrega") == "atrasado"
    grouped = joined.groupBy(sentiment).agg(
        F.count(F.lit(1)).alias("total_pedidos"), S.count_where(late).alias("atrasados"),
        S.percent_where(late).alias("pct_atrasado"),
    )
    return grouped.orderBy(F.desc("pct_atrasado"), sentiment)


def review_document() -> Column:
    """Review, category, places and delivery as labelled lines; a missing value reads N/A."""
    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("N/A"))

    # Line formats of the document.
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Review (score "), F.col("review_score"), F.lit("/5): "), F.col("review_message")),
        F.format_string("Categoria: %s", shown("product_category")),
        F.format_string("Estado cliente: %s", shown("customer_state")),
        F.format_string("Estado vendedor: %s", shown("seller_state")),
        F.format_string("Entrega: %s (delta: %s dias)", shown("status_entrega"), shown("delta_entrega_dias")),
    )


def build_review_documents(
    reviews: DataFrame, orders_enriched: DataFrame, items_enriched: DataFrame, least: int = 10
) -> DataFrame:
    """One document per review with more than ``least`` characters of text."""
    written = reviews.where(S.longer_than("review_message", least)).select(
        "review_id", "order_id", "review_score", "review_message", "review_sentiment"
    )
    context = joins.join_review_context(written, orders_enriched, items_enriched)
    return context.withColumn("documento", review_document())
