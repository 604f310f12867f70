"""Token counts of documents in flat token streams without an index, found by their end-of-document ids.

A flat file is a run of fixed-width ids, documents end to end, each closed by one separator id. It comes in blocks that cut
documents anywhere. A task searches a block for separators in one vectorised comparison; prefix scans over the blocks of a
file then give each block its first document's number and how far back that document began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .batches import byte_texts, slices
from .bpe import codec

#: Ids in a block.
BLOCK_IDS = 1 << 19
#: Blocks of a file whose prefix scan runs in one task; their totals are scanned first.
STRIDE = 4096


def write_stream(df: DataFrame, path: str, separator: int, key: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> tuple[DataFrame, DataFrame]:
    """Encode whole texts into flat files of 2-byte ids, one a task, in the shared folder: (blocks, manifest).

    blocks: file, block, data. manifest: file, ordinal, key of each document in the order of writing. ``path`` is a
    byte-level BPE vocabulary; strings of its special tokens are encoded as ordinary text, so that the separator only ever
    closes a document. A null text is a document without ids. Runs one job.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, file = codec(path), TaskContext.get().partitionId()
        if own.size > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit in 2 bytes")
        close, rest, block, ordinal = np.array([separator], "<u2").tobytes(), b"", 0, 0
        names = ["file", "block", "data", "ordinal", "key"]

        def rows(data: list[bytes], keys: pa.Array) -> pa.RecordBatch:
            nonlocal block, ordinal
            n, m = len(data), len(keys)
            columns = [
                pa.array([file] * (n + m), pa.int32()),
                pa.array([*range(block, block + n), *[None] * m], pa.int64()),
                pa.array([*data, *[None] * m], pa.binary()),
                pa.array([*[None] * n, *range(ordinal, ordinal + m)], pa.int64()),
                pa.concat_arrays([pa.nulls(n, keys.type), keys]),
            ]
            block, ordinal = block + n, ordinal + m
            return pa.RecordBatch.from_arrays(columns, names=names)

        empty = None
        for batch in slices(batches, text):
            coded = own.encode_batch([t or b"" for t in byte_texts(batch, text)], specials=False)
            stream = rest + b"".join([x for ids, _ in coded for x in (ids.astype("<u2").tobytes(), close)])
            cut = len(stream) // (2 * block_ids) * 2 * block_ids
            rest = stream[cut:]
            yield rows([stream[i : i + 2 * block_ids] for i in range(0, cut, 2 * block_ids)], batch.column(key))
            empty = batch.column(key).slice(0, 0)
        if rest:
            yield rows([rest], empty)

    stored = scratch_path(df.sparkSession, "tokens")
    written = df.select(key, text).mapInArrow(run, f"file int, block long, data binary, ordinal long, key {kind}")
    written.write.option("compression", "zstd").parquet(stored)
    back = df.sparkSession.read.schema(written.schema).parquet(stored)
    return back.where("block IS NOT NULL").select("file", "block", "data"), back.where("ordinal IS NOT NULL").select("file", "ordinal", F.col("key").alias(key))


def read_flat(spark: SparkSession, paths: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file (path), block, data of flat files that Spark's binary reader opens (up to 2 GB each)."""
    size = width * block_ids
    files = spark.read.format("binaryFile").load(paths).where("length > 0")
    blocks = files.select("path", "content", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size))).alias("block"))
    return blocks.select(F.col("path").alias("file"), F.col("block").cast("long").alias("block"), F.substring("content", F.col("block").cast("int") * size + 1, F.lit(size)).alias("data"))


def scan(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """file, block, n_ids, ends (positions of the separator in the block). A null block has no ids."""
    kind = blocks.schema["file"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column("data")):
                ids = np.frombuffer(data.as_buffer() if data.is_valid else b"", f"<u{width}")
                ends = pa.array([np.flatnonzero(ids == separator)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("file").slice(i, 1), batch.column("block").slice(i, 1), pa.array([len(ids)], pa.int64()), ends],
                    names=["file", "block", "n_ids", "ends"],
                )

    return blocks.select("file", "block", "data").mapInArrow(run, f"file {kind}, block long, n_ids long, ends array<long>")


def _before(df: DataFrame, values: dict[str, tuple]) -> DataFrame:
    """For each name (function, column): the function over all earlier blocks of the file; two levels of STRIDE blocks."""
    df = df.withColumn("stride", F.floor(F.col("block") / STRIDE))
    totals = df.groupBy("file", "stride").agg(*[f(c).alias(f"t_{name}") for name, (f, c) in values.items()])
    outer = Window.partitionBy("file").orderBy("stride").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", "stride", *[f(f"t_{name}").over(outer).alias(f"o_{name}") for name, (f, _) in values.items()])
    inner = Window.partitionBy("file", "stride").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = df.select("*", *[f(c).over(inner).alias(f"i_{name}") for name, (f, c) in values.items()]).join(offsets, ["file", "stride"])

    def both(name: str, f) -> Column:
        i, o = F.col(f"i_{name}"), F.col(f"o_{name}")
        return (F.greatest(i, o) if f is F.max else F.coalesce(i, F.lit(0)) + F.coalesce(o, F.lit(0))).alias(name)

    return own.select(*[c for c in df.columns if c != "stride"], *[both(name, f) for name, (f, _) in values.items()])


def counts(scanned: DataFrame) -> DataFrame:
    """file, ordinal, n_tokens, closed for each document of each file, in order from 0.

    Separators are not counted; two in a row hold an empty document between them. Ids after a file's last separator are a
    last document with ``closed`` false. Blocks may be missing at no place; a file without ids has no documents.
    """
    placed = _before(scanned.withColumn("n_ends", F.size("ends")), {"start": (F.sum, "n_ids"), "first": (F.sum, "n_ends")})
    last = F.when(F.col("n_ends") > 0, F.col("start") + F.element_at("ends", -1))
    stitched = _before(placed.withColumn("last", last), {"previous": (F.max, "last")})
    each = stitched.select("file", "start", "first", "previous", "ends", F.posexplode("ends").alias("k", "end"))
    begun = F.when(F.col("k") == 0, F.coalesce("previous", F.lit(-1))).otherwise(F.col("start") + F.get("ends", F.col("k") - 1))
    closed = each.select("file", (F.col("first") + F.col("k")).alias("ordinal"), (F.col("start") + F.col("end") - begun - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    whole = placed.withColumn("last", last).groupBy("file").agg(F.sum("n_ids").alias("n"), F.sum("n_ends").alias("ordinal"), F.max("last").alias("last"))
    rest = whole.select("file", "ordinal", (F.col("n") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.union(rest)


def document_counts(df: DataFrame, path: str, separator: int) -> DataFrame:
    """doc_id, n_tokens, file, ordinal of every document, counted in the flat files that its table is written to."""
    blocks, manifest = write_stream(df.select("doc_id", "text"), path, separator)
    scanned = cut_lineage(scan(blocks, separator), "separators")  # a few numbers a block, read by several scans
    return manifest.join(counts(scanned), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
