"""Cosine top-k over embeddings, and its quality."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_OUT = "query_id long, neighbour_id long, score double"
#: Queries whose scores against a block of the corpus are held at a time; bounds memory.
TILE_ROWS = 128
#: Blocks a side is cut into, so copies of the other side's rows, before its blocks grow beyond what was asked for.
COPIES = 16
#: Rows to which blocks of queries and of the corpus may grow.
QUERY_ROWS, CORPUS_ROWS = 8192, 16384


def _matrix(vectors: pd.Series) -> np.ndarray:
    m = np.asarray(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0.0, 1.0, norms)


def _best(query_ids: np.ndarray, query_unit: np.ndarray, ids: np.ndarray, unit: np.ndarray, k: int) -> pd.DataFrame:
    """Top ``k`` of one slice of the corpus for each query: all the slice can contribute to the answer."""
    parts = []
    for start in range(0, len(query_ids), TILE_ROWS):
        asked = query_ids[start : start + TILE_ROWS]
        scores = query_unit[start : start + TILE_ROWS] @ unit.T
        scores[asked[:, None] == ids] = -np.inf
        scores[np.isnan(scores)] = -np.inf
        if len(ids) > k:
            # Whatever may tie with the k-th once rounded stays until ids have decided.
            near = scores >= np.partition(scores, -k, axis=1)[:, -k, None] - 2e-9
        else:
            near = np.ones(scores.shape, bool)
        row, column = np.nonzero(near & np.isfinite(scores))
        line, found = np.round(scores[row, column], 9), ids[column]
        order = np.lexsort((found, -line, row))
        row, line, found = row[order], line[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        parts.append(pd.DataFrame({"query_id": asked[row[keep]], "neighbour_id": found[keep], "score": line[keep]}))
    return pd.concat(parts) if parts else pd.DataFrame(columns=["query_id", "neighbour_id", "score"])


def _grid(rows: int, block: int, largest: int) -> int:
    """Blocks of ``block`` rows, but no more than COPIES of them until they have grown to ``largest`` rows."""
    return max(1, min(-(-rows // block), max(COPIES, -(-rows // max(block, largest)))))


def similar_top_k(
    queries: DataFrame, corpus: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
    query_rows: int = 2048, corpus_rows: int = 16384,
) -> DataFrame:
    """Exact ``k`` nearest rows of the corpus per query by cosine; a query does not find itself.

    Filter ``corpus`` on its metadata first; the filter reaches the scan. Queries and corpus are cut by a hash of the
    whole row into blocks of about ``query_rows`` and ``corpus_rows`` rows, and each pair of blocks meets in a group. Every
    row is sent once for each block of the other side: beyond COPIES blocks they grow, to QUERY_ROWS and CORPUS_ROWS rows
    at most, so a group stays bounded whatever the tables hold. A block of the corpus returns at most ``k`` rows per
    query, so pairs are never produced, and the merge keeps ``k`` per query map-side as well. Runs two counts.
    """
    q = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    c = corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    blocks, slices = _grid(q.count(), query_rows, QUERY_ROWS), _grid(c.count(), corpus_rows, CORPUS_ROWS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = lambda seed, n: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    left = q.withColumn("block", spread(1, blocks)).withColumn("slice", every(slices))
    right = c.withColumn("slice", spread(7, slices)).withColumn("block", every(blocks))

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=["query_id", "neighbour_id", "score"])
        return _best(asked["id"].to_numpy(), _matrix(asked["v"]), held["id"].to_numpy(), _matrix(held["v"]), k)

    keys = ["block", "slice"]
    candidates = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, _OUT)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id")
    return candidates.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def precision_at_k(results: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Mean share of the first ``k`` results that are relevant; ``relevant`` holds (query_id, neighbour_id)."""
    truth = relevant.select("query_id", "neighbour_id").distinct().withColumn("_hit", F.lit(1))
    judged = results.where(F.col("rank") <= k).join(truth, ["query_id", "neighbour_id"], "left")
    per_query = judged.groupBy("query_id").agg((F.count("_hit") / F.lit(k)).alias("precision"))
    return per_query.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("precision"), 6).alias("precision_at_k"))


def precision_by_label(results: DataFrame, labels: DataFrame, k: int, id_col: str = "vec_id") -> DataFrame:
    """The same measure when a result is relevant if it carries the label of its query."""
    asked = labels.select(F.col(id_col).alias("query_id"), F.col("label").alias("_want"))
    found = labels.select(F.col(id_col).alias("neighbour_id"), F.col("label").alias("_got"))
    judged = results.where(F.col("rank") <= k).join(asked, "query_id").join(found, "neighbour_id")
    per_query = judged.groupBy("query_id").agg(
        (F.count_if(F.col("_want") == F.col("_got")) / F.lit(k)).alias("precision")
    )
    return per_query.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("precision"), 6).alias("precision_at_k"))
