"""The corpus pipeline: documents in, token digests out, in five stages of the operators of ``vendaval.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. ``run`` writes every stage's rows to the shared folder and hands what it reads back to the next. The mix is the order
of the rows in the files of its stage. Spark does not read files in the order of their names, so the last stage takes each
row's place from its file and returns its rows in the order that the mix wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.llm import bpe, language, mixing, neardup, quality
from vendaval.llm.queries import VOCABULARY, table
from vendaval.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; those without a letter are rejected."""
    model = language.train(docs, ~language.held_out())
    return docs.where(language.verdict(model, F.col("text"))["lang_pred"] != language.UNDETERMINED)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality.keep(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity of 0.8 or more, the least id stays."""
    return neardup.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files hold it, one after the other."""
    return mixing.in_order(mixing.mix(docs)).select(*[F.col(f"`{c}`") for c in docs.columns])


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, in the order of the files, or of the rows if none are read."""
    path = public_tokenizers.path(VOCABULARY)
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:  # rows that do not come straight from files have no place in them, and their order already
        return bpe.digests(docs, path)
    coded = cut_lineage(bpe.digests(placed, path, keep=("file", "row")), "digests")  # texts are encoded once and not shuffled
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return coded.repartitionByRange(n, "file", "row").sortWithinPartitions("file", "row").drop("file", "row")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe_round_trip", bpe_round_trip),
]

#: Classifiers, near-duplicate groups and byte-pair ids have no SQL form; tests hold ``run`` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
