"""Language identification by error-correcting output codes.

Each language has a codeword; each bit is a binary classifier over hashed byte n-grams; decoding adds up the bits' losses,
weighted by how well each bit did in training, and picks the codeword with the least. Whole texts are scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import byte_texts, fold, slices, without

#: Hashed n-gram dimensions of the model.
DIMENSIONS = 4096
#: Bound of the training sample: whole texts of a label that the model is fitted on, those with the least hash.
SAMPLE_PER_LABEL = 300
#: Codewords are exhaustive up to so many labels; beyond, LONG_CODE random bits each.
EXHAUSTIVE = 6
LONG_CODE = 48
#: Best and second-best share closer than this: flagged as ambiguous.
AMBIGUOUS = 0.2
UNDETERMINED = "und"

_LETTER = re.compile(rb"[A-Za-z]")
#: ASCII letters lower-cased, other ASCII bytes a blank, bytes of other characters as they are.
_PLAIN = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def ngrams(texts: list[bytes]) -> np.ndarray:
    """Shares of hashed byte bigrams and trigrams, one row a text."""
    out = np.zeros((len(texts), DIMENSIONS), "f4")
    for row, text in enumerate(texts):
        b = np.frombuffer(b" " + text.translate(_PLAIN) + b" ", "u1").astype("u4")
        two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] * np.uint32(0xC2B2AE35) + b[2:] * np.uint32(0x27D4EB2F)
        at = np.concatenate((two, three)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
        out[row] = np.bincount(at, minlength=DIMENSIONS) / len(at)
    return out


def codewords(n: int) -> np.ndarray:
    """(labels, bits) of -1 and 1; no two rows alike and no bit alike for all labels, from two labels on."""
    if n <= EXHAUSTIVE:
        bits = [[1 if i == 0 or c >> (i - 1) & 1 else -1 for i in range(n)] for c in range(max(1, 2 ** (n - 1) - 1))]
        return np.array(bits, "f4").T
    best = None
    for seed in range(64):
        drawn = np.random.default_rng(seed).choice(np.array([-1, 1], "f4"), (n, LONG_CODE))
        apart = (LONG_CODE - drawn @ drawn.T) / 2 + np.eye(n) * LONG_CODE
        if (abs(drawn.sum(0)) < n).all() and (best is None or apart.min() > best[0]):
            best = (apart.min(), drawn)
    return best[1]


@dataclass
class Model:
    """Labels in order, their codewords, a linear classifier for each bit and the bits' weights."""

    labels: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """Share of each label: soft-max over the negative weighted logistic losses of its codeword."""
        margin = ngrams(texts) @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -code * margin) * self.trust).sum(1) for code in self.codes], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        return share / share.sum(1, keepdims=True)


def fit(features: np.ndarray, labels: list[str], steps: int = 150) -> Model:
    """One logistic classifier a bit, by full gradient steps on standardised shares. No rows: a model without labels."""
    names = sorted(set(labels))
    codes = codewords(max(len(names), 1))
    if len(names) < 2:
        bits = codes.shape[1]
        return Model(names, codes[: len(names)], np.zeros((DIMENSIONS, bits), "f4"), np.ones(bits, "f4"), np.ones(bits, "f4"))
    owner = np.array([names.index(x) for x in labels])
    target = codes[owner]
    balance = (1 / np.bincount(owner, minlength=len(names)))[owner][:, None] * len(labels) / len(names)
    middle, spread = features.mean(0), features.std(0) + 1e-4
    x = (features - middle) / spread / np.sqrt(DIMENSIONS)
    w, b, speed = np.zeros((DIMENSIONS, codes.shape[1]), "f4"), np.zeros(codes.shape[1], "f4"), 0
    for _ in range(steps):
        slope = -target * balance / (1 + np.exp(target * (x @ w + b)))
        speed = 0.9 * speed + x.T @ slope / len(x) + 1e-4 * w
        w -= 1.0 * speed
        b -= 0.3 * slope.mean(0)
    right = (np.sign(x @ w + b) == target).mean(0)
    scaled = w / spread[:, None] / np.sqrt(DIMENSIONS)
    return Model(names, codes, scaled.astype("f4"), (b - middle @ scaled).astype("f4"), np.maximum(2 * right - 1, 0.05).astype("f4"))


def train(df: DataFrame, use: Column, text: str = "text", label: str = "lang") -> Model:
    """Fit on rows where ``use`` holds and text and label are there. Runs two jobs.

    The sample is bounded by SAMPLE_PER_LABEL different texts a label, those with the least hash: a text that many rows repeat
    counts once, so that it can crowd out neither its own label nor another. Tasks send n-gram shares, not texts, to the driver.
    """
    rows = df.where(use & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")
    )
    sizes = rows.select("label", "h").distinct().groupBy("label").count().collect()  # one row a label
    # A first cut by the hash leaves about 2 * SAMPLE_PER_LABEL rows of a label for the exact one, however many there are.
    limits = rows.sparkSession.createDataFrame(
        [(r["label"], min(2**63 - 1, int((min(1.0, 2 * SAMPLE_PER_LABEL / r["count"]) * 2 - 1) * 2**63))) for r in sizes], "label string, most bigint"
    )
    near = rows.join(F.broadcast(limits), "label").where(F.col("h") <= F.col("most")).groupBy("label", "h").agg(F.min("text").alias("text"))
    picked = near.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h"))).where(F.col("r") <= SAMPLE_PER_LABEL)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = byte_texts(batch, "text")
            lettered = [i for i, t in enumerate(texts) if has_letter(t)]
            rows = [r.tobytes() for r in ngrams([texts[i] for i in lettered])]
            yield pa.RecordBatch.from_arrays([batch.column("label").take(pa.array(lettered, pa.int64())), pa.array(rows, pa.binary())], names=["label", "shares"])

    sample = picked.select("label", "text").mapInArrow(shares, "label string, shares binary").collect()
    features = np.stack([np.frombuffer(r.shares, "f4") for r in sample]) if sample else np.zeros((0, DIMENSIONS), "f4")
    return fit(features, [r.label for r in sample])


def verdict(model: Model, text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` (share of that label, 0 to 1) and ``ambiguous``. Python sees the text alone, and
    gives back the verdict alone; a row's other columns stay with Spark.

    A null text, one without a letter, and any text under a model without labels: ``und``, 0.0, true. Ties go to the label
    that sorts first.
    """

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]))
    def judge(column: pa.Array) -> pa.Array:
        n = len(column)
        names, scores, doubtful = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
        at = 0
        for batch in slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            texts = byte_texts(batch, "text")
            for start in range(0, len(texts), 1000):
                rows = [i for i in range(start, min(start + 1000, len(texts))) if model.labels and texts[i] and has_letter(texts[i])]
                if rows:
                    share = model.shares([texts[i] for i in rows])
                    top = np.sort(share, 1)
                    for i, k in zip(rows, share.argmax(1)):
                        names[at + i] = model.labels[k]
                    where = at + np.array(rows)
                    scores[where] = np.clip(top[:, -1], 0, 1)
                    doubtful[where] = (top[:, -1] - top[:, -2] < AMBIGUOUS) if top.shape[1] > 1 else False
            at += len(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubtful, pa.bool_())], names=["lang_pred", "score", "ambiguous"])

    return judge(text)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns and those of ``verdict``. Replaces columns so named. Rows are judged one by one; no shuffle."""
    base = without(df, ("lang_pred", "score", "ambiguous"))
    found = base.select(F.struct("*").alias("row"), verdict(model, F.col(f"`{text}`")).alias("verdict"))
    return found.select("row.*", "verdict.*")


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 4) == 2


def predictions(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from the labelled rows that are not held out."""
    model = train(df, ~held_out())
    return identify(df.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
