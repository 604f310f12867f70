"""Language-model scores: a hashed maximum-entropy model with a class-factored soft-max.

Every word type falls into a cell: the most frequent types have cells of their own, all others share cells by the hash of
their ending. Cells are grouped in classes. The model gives P(class | h) and P(cell | class, h) by linear models over hashed
features of the history h: the cells before (n-gram features) and cells further back alone (skip features). Inside a shared
cell, types have their discounted share of the cell's count, and the discount is what an unseen type of that cell gets. The
probabilities of all types and of the cells' unseen types add up to 1.

Training: each task walks through its part of the training documents with its own copy of the weights and sends what it
changed, which Spark averages row by row, weighted by how often a row was met; ROUNDS disjoint slices of the documents make
as many rounds. Every training document is used once. Counts are exact and cover all of them.

Scoring needs exact counts of all words. A block of documents gets a dictionary of its own words with their counts, through
shuffles whose size follows the text; the vocabulary as a whole is never broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .batches import byte_texts, fold, slices

CLASSES, WIDTH = 16, 32
CELLS = CLASSES * WIDTH
#: Word types with cells of their own.
HEAD = 320
#: Bytes of a word's end that choose its shared cell.
ENDING = 3
DISCOUNT = 0.6
PAIRS, INNER = 16384, 8192
#: First rows of the feature kinds. Outer: the cell before, the one before that (skip), both (pair), bias. Inner, with the
#: class: the cell before, the one before that, bias.
_TWO, _PAIR, _BIAS = CELLS + 1, 2 * (CELLS + 1), 2 * (CELLS + 1) + PAIRS
_IN_TWO, _CLASS = INNER, 2 * INNER
ROWS = (_BIAS + 1, _CLASS + CLASSES)
ROUNDS = 2
STEP, BATCH = 0.4, 8192
#: Most tasks that train side by side in a round; bounds what one averaging task reads.
TRAINERS = 4096
#: Weight rows averaged together.
CHUNK = 128
#: Text bytes that share one dictionary when scored, and what a row counts besides its text.
BLOCK_BYTES, ROW_BYTES = 16 << 20, 64
FLUSH = 400_000
#: The token that closes every text. It has a separator in it, so no word equals it.
END = b"\n"


def words_of(text: bytes | None) -> list[bytes]:
    """Tokens of a text: words with A-Z lower-cased, then END."""
    return [*text.lower().split(), END] if text else [END]


class Cells(dict):
    """Word -> cell, computed once a process."""

    def __init__(self, head: dict[bytes, int]):
        super().__init__(head)
        self.head = head

    def __missing__(self, word: bytes) -> int:
        own = len(self.head)
        value = self[word] = own + xxhash.xxh3_64_intdigest(word.rstrip(b".,;:!?")[-ENDING:]) % (CELLS - own)
        return value

    def bounded(self) -> Cells:
        if len(self) > FLUSH:
            self.clear()
            self.update(self.head)
        return self


class Weights:
    """Outer (rows, CLASSES) and inner (rows, WIDTH) weights; for each row its squared gradients and how often it was met."""

    def __init__(self, tables: tuple[np.ndarray, np.ndarray] | None = None):
        self.tables = tuple(t.copy() for t in tables) if tables else tuple(np.zeros((n, w), "f4") for n, w in zip(ROWS, (CLASSES, WIDTH)))
        self.squares = tuple(np.zeros(n, "f4") for n in ROWS)
        self.seen = tuple(np.zeros(n, "f4") for n in ROWS)


def _histories(cells: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell before each token and the one before that; CELLS before the text."""
    one, two = np.full(len(cells), CELLS), np.full(len(cells), CELLS)
    one[1:], two[2:] = cells[:-1], cells[:-2]
    one[starts], two[starts] = CELLS, CELLS
    second = starts + 1
    two[second[second < len(cells)]] = CELLS
    return one, two


def _features(one: np.ndarray, two: np.ndarray, klass: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of the outer and the inner weights that are active for each token."""
    pair = (one * 40503 + two * 10007) % 65521 % PAIRS
    outer = [one, _TWO + two, _PAIR + pair, np.full_like(one, _BIAS)]
    inner = [(klass * 7919 + one * 31) % 65521 % INNER, _IN_TWO + (klass * 6131 + two * 17) % 65521 % INNER, _CLASS + klass]
    return outer, inner


def _added(columns: np.ndarray) -> np.ndarray:
    """Sum over the rows of (CLASSES or WIDTH, n): as ``sum(1)`` adds up the transposed array, to the last bit, but by whole rows."""
    eight = columns[:8] + columns[8:16]
    for first in range(16, len(columns), 8):
        eight += columns[first : first + 8]
    four = eight[0::2] + eight[1::2]
    two = four[0::2] + four[1::2]
    return two[0] + two[1]


def _logits(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Sums of the active rows, less their greatest; a column for each token, so that every later step runs along whole rows."""
    z = table.take(rows[0], 0)
    for r in rows[1:]:
        z += table.take(r, 0)
    z = np.ascontiguousarray(z.T)
    z -= z.max(0)
    return z


def _log_softmax(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = _logits(table, rows)
    z -= np.log(_added(np.exp(z)))
    return z


def _log_softmax_at(table: np.ndarray, rows: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """``_log_softmax`` of one row a token, without the others."""
    z = _logits(table, rows)
    found = z[target, np.arange(z.shape[1])]
    return found - np.log(_added(np.exp(z, out=z)))


def cell_log10(tables: tuple[np.ndarray, np.ndarray], cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """log10 P(cell | h) of every token; texts end to end, ``starts`` their first tokens."""
    one, two = _histories(cells, starts)
    out = np.empty(len(cells))
    for s in range(0, len(cells), BATCH):
        here = cells[s : s + BATCH]
        klass = here // WIDTH
        outer, inner = _features(one[s : s + BATCH], two[s : s + BATCH], klass)
        out[s : s + BATCH] = _log_softmax_at(tables[0], outer, klass) + _log_softmax_at(tables[1], inner, here % WIDTH)
    return out / np.log(10)


def learn(own: Weights, cells: np.ndarray, starts: np.ndarray) -> None:
    """One pass of gradient steps over the tokens, in place; steps shrink with a row's gathered squared gradient."""
    one, two = _histories(cells, starts)
    for s in range(0, len(cells), BATCH):
        here = cells[s : s + BATCH]
        klass, token = here // WIDTH, np.arange(len(here))
        kinds = _features(one[s : s + BATCH], two[s : s + BATCH], klass)
        for k, target in ((0, klass), (1, here % WIDTH)):
            error = _log_softmax(own.tables[k], kinds[k])
            np.exp(error, out=error)
            error[target, token] -= 1
            rows = np.concatenate(kinds[k])
            marked = np.bincount(rows, minlength=ROWS[k])
            at = np.flatnonzero(marked)
            dense = np.empty(ROWS[k], "i8")
            dense[at] = np.arange(len(at))
            place, each = dense[rows], np.empty((len(kinds[k]), len(here)))
            slope = np.empty((len(error), len(at)), "f4")
            for c, column in enumerate(error):
                each[:] = column
                slope[c] = np.bincount(place, each.ravel(), len(at))
            own.squares[k][at] += _added(slope * slope) / len(slope)
            own.tables[k][at] -= (STEP * slope / np.sqrt(own.squares[k][at] + 1)).T
            own.seen[k][at] += marked[at]


def _flat(texts: list[bytes | None], cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    tokens = [words_of(t) for t in texts]
    lengths = np.fromiter(map(len, tokens), "i8", len(tokens))
    flat = np.concatenate([np.fromiter(map(cells.__getitem__, t), "i8", len(t)) for t in tokens])
    return flat, np.cumsum(lengths) - lengths


def in_blocks(docs: DataFrame) -> DataFrame:
    """All columns and ``block``: rows of one task in their order, a new block after every BLOCK_BYTES.

    A block is never larger than that and one text, whatever the sizes of files and however often a row is repeated. The
    number follows the order of rows, so write the result before it is used twice.
    """
    keep = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, met = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            if batch.num_rows:
                sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype("i8") + ROW_BYTES
                ends = met + np.cumsum(sizes)
                met = int(ends[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + (ends - sizes) // BLOCK_BYTES, pa.int64())], names=[*keep, "block"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("block", T.LongType())]))


def block_words(docs: DataFrame) -> DataFrame:
    """block, word, n: distinct words of each block (``block``, ``learn``, ``text``), n their count in its training texts.

    A block may come in several rows of a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for block, words in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(words), pa.int64()), pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())],
                    names=["block", "word", "n"],
                )
            counts.clear()

        for batch in slices(batches, "text", 4 << 20):
            rows = zip(batch.column("block").to_pylist(), batch.column("learn").to_pylist(), byte_texts(batch, "text"))
            for block, train, text in rows:
                own = counts.setdefault(block, Counter())
                words = words_of(text)
                if train:
                    own.update(words)
                else:
                    for w in words:
                        own[w] += 0
            if sum(map(len, counts.values())) > FLUSH:
                yield from flush()
        yield from flush()

    return docs.select("block", "learn", "text").mapInArrow(run, "block long, word binary, n long")


def _pieces() -> list[tuple[int, int, int]]:
    """(table, first row, last row) of the pieces of the weights that are averaged one by one."""
    return [(k, first, min(first + CHUNK, n)) for k, n in enumerate(ROWS) for first in range(0, n, CHUNK)]


def _train(docs: DataFrame, head: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights after ROUNDS rounds over the texts where ``learn`` holds."""
    spark, tables, pieces = docs.sparkSession, Weights().tables, _pieces()
    for number in range(ROUNDS):
        start = spark.sparkContext.broadcast(tables)  # some MB whatever the corpus, see ROWS

        def walk(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own, cells = Weights(start.value), Cells(head)
            for batch in slices(batches, "text", 2 << 20):
                learn(own, *_flat(byte_texts(batch, "text"), cells.bounded()))
            met = [i for i, (k, a, b) in enumerate(pieces) if own.seen[k][a:b].any()]
            change = [(own.tables[k][a:b] - start.value[k][a:b]).clip(-6e4, 6e4).astype("f2").tobytes() for k, a, b in (pieces[i] for i in met)]
            seen = [own.seen[k][a:b].tobytes() for k, a, b in (pieces[i] for i in met)]
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(change, pa.binary()), pa.array(seen, pa.binary())], names=["piece", "change", "seen"])

        def average(rows: pd.DataFrame) -> pd.DataFrame:
            total, weight = 0.0, 0.0
            for change, seen in zip(rows["change"], rows["seen"]):
                seen = np.frombuffer(seen, "f4").astype("f8")
                total = total + np.frombuffer(change, "f2").reshape(len(seen), -1).astype("f8") * seen[:, None]
                weight = weight + seen
            mean = (total / np.maximum(weight, 1)[:, None]).astype("f4")
            return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "change": [mean.tobytes()]})

        part = docs.where(F.col("learn") & (F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS)) == number)).select("text")
        if part.rdd.getNumPartitions() > TRAINERS:
            part = part.coalesce(TRAINERS)
        changes = part.mapInArrow(walk, "piece int, change binary, seen binary").groupBy("piece").applyInPandas(average, "piece int, change binary")
        tables = tuple(t.copy() for t in tables)
        for r in changes.collect():  # the model, whatever the corpus
            k, a, b = pieces[r.piece]
            tables[k][a:b] += np.frombuffer(r.change, "f4").reshape(b - a, -1)
        start.unpersist()
    return tables


def scores(df: DataFrame, use: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score for each row of ``df``; learned from rows where ``use`` holds.

    ``base_score`` adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, ``score`` the model's log10 probabilities.
    A null or empty text is the end token alone. Without training rows N and V are 0 and the model is uniform over cells.
    Repeated rows and null keys each get their row. Runs several jobs and writes to the shared folder.
    """
    docs = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), use.alias("learn"))
    docs = cut_lineage(in_blocks(docs), "blocks")  # written once: a row keeps its block in every pass

    by_word = Window.partitionBy("word")
    counted = cut_lineage(
        block_words(docs)
        .withColumn("c", F.sum("n").over(by_word))
        .withColumn("lead", F.row_number().over(by_word.orderBy("block")) == 1)
        .select("block", "word", "c", "lead"),
        "words",
    )
    types = counted.where("lead AND c > 0").select("word", "c")
    head = {bytes(r.word): i for i, r in enumerate(types.orderBy(F.desc("c"), "word").limit(HEAD).collect())}

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total, kinds = Cells(head), np.zeros(CELLS, "i8"), np.zeros(CELLS, "i8")
        for batch in batches:
            at = np.fromiter(map(cells.bounded().__getitem__, batch.column("word").to_pylist()), "i8", batch.num_rows)
            np.add.at(total, at, batch.column("c").to_numpy())
            np.add.at(kinds, at, 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(CELLS), pa.int32()), pa.array(total), pa.array(kinds)], names=["cell", "total", "kinds"])

    cell_total, cell_kinds = np.zeros(CELLS), np.zeros(CELLS)
    sums = types.mapInArrow(shared, "cell int, total long, kinds long").groupBy("cell").agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds"))
    for r in sums.collect():
        cell_total[r.cell], cell_kinds[r.cell] = r.total, r.kinds
    n, v = int(cell_total.sum()), int(cell_kinds.sum())
    tables = docs.sparkSession.sparkContext.broadcast(_train(docs, head))

    def score(texts: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        words, c = dictionary["word"].tolist(), dictionary["c"].to_numpy("f8")
        index = {w: i for i, w in enumerate(words)}  # rows that repeat a word have the same count
        cells = Cells(head)
        cell = np.fromiter(map(cells.__getitem__, words), "i8", len(words))
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.where(cell < len(head), 1.0, (c - DISCOUNT) / cell_total[cell])
            unseen = np.where(cell_total[cell] > 0, DISCOUNT * cell_kinds[cell] / cell_total[cell], 1.0)
            inside = np.log10(np.where(c > 0, seen, unseen))
        plain = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        out = []
        for s in range(0, len(texts), 256):
            part = texts.iloc[s : s + 256]
            tokens = [words_of(t.encode() if t else None) for t in part["text"]]
            lengths = np.fromiter(map(len, tokens), "i8", len(tokens))
            ids = np.concatenate([np.fromiter(map(index.__getitem__, t), "i8", len(t)) for t in tokens])
            starts = np.cumsum(lengths) - lengths
            add = lambda x: np.add.reduceat(x, starts)  # noqa: B023, E731  every text has its end token
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "n_tokens": lengths,
                        "n_known": add((c[ids] > 0).astype("i8")),
                        "train_tokens": n,
                        "base_score": add(plain[ids]),
                        "score": add(cell_log10(tables.value, cell[ids], starts) + inside[ids]),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame()

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.select("block", "doc_id", "text").groupBy("block").cogroup(counted.select("block", "word", "c").groupBy("block")).applyInPandas(score, schema)


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 5) == 1


def contract(df: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those that are not held out."""
    return scores(df.select("doc_id", "text"), ~held_out()).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
