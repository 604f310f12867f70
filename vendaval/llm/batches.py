"""Arrow helpers shared by the operators: bounded slices of a batch, byte texts, and plain columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes handled at once inside a task. Bounds memory; results do not depend on it.
SLICE_BYTES = 8 << 20

#: The six ASCII separators of the word pattern ``[^\x20\x09-\x0D]+``; ``bytes.split()`` cuts at exactly these.
SEPARATORS = "\\x20\\x09-\\x0D"


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of ``column``, or one row if that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for i, n in enumerate(lengths):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """Texts as UTF-8 bytes, null as None."""
    values = batch.column(column)
    binary = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return values.cast(binary).to_pylist()


def list_array(values: np.ndarray, lengths: Iterable[int], kind: pa.DataType) -> pa.ListArray:
    """One list a row, from the rows' values end to end."""
    offsets = np.zeros(len(list(lengths)) + 1, "i4") if not isinstance(lengths, np.ndarray) else np.zeros(len(lengths) + 1, "i4")
    np.cumsum(np.fromiter(lengths, "i4") if not isinstance(lengths, np.ndarray) else lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo: the fold of a row. A null id folds as the empty text does."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that an operator is about to add: where names clash, its results win."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, lengthened until no column of ``df`` has it: for columns that an operator needs on the way."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
