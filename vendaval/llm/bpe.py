"""Byte-level BPE over documents by a pair occurrence index, and the way back from ids to text.

A task collects the distinct pieces of its texts, lays their bytes end to end, and maps every adjacent pair that has a
merge rank to all its positions. Active ranks are then taken in ascending order: one vectorised step merges all
positions of the rank and puts the pairs that came into being into the lists of their own ranks. A new pair holds the
new symbol and so ranks later, which makes one ascending pass complete.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import byte_texts, list_array, slices, without

#: Fixed value: the pre-tokenization pattern of byte-level BPE files that set ``use_regex``.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Remembered chunks in a task; beyond it the memory is emptied and filled anew. Results do not depend on it.
REMEMBERED = 300_000
#: Chunks merged in one index; bounds memory. Results do not depend on it.
INDEXED = 150_000
#: Text bytes encoded at once in a task; bounds memory. Results do not depend on it.
ENCODED_BYTES = 2 << 20


def _printable_bytes() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: itself if printable, else the next free from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """A byte-level BPE vocabulary file as arrays: pair keys in order, their ranks and results, the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _printable_bytes()
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.left = np.array([vocab[a] for a, _ in pairs], "i8")
        self.right = np.array([vocab[b] for _, b in pairs], "i8")
        self.result = np.array([vocab[a + b] for a, b in pairs], "i8")
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.byte_ids = np.zeros(256, "i8")
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
            if len(token) == 1:
                self.byte_ids[byte_of[token]] = i
        self.added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.bytes_of[i] = content
        self.added_split = regex.compile(b"(" + b"|".join(regex.escape(a) for a in self.added) + b")") if self.added else None
        self.widths = np.array([len(b) for b in self.bytes_of], "i8")
        #: Chunk after a space, and chunk that opens a text: its ids (int32), and the bytes these ids stand for.
        self.chunks: dict[bytes, bytes | None] = {}
        self.chunk_texts: dict[bytes, bytes] = {}
        self.heads: dict[bytes, bytes | None] = {}
        self.head_texts: dict[bytes, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 without one."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and where each piece's begin (and the last one's end). An empty piece has none."""
        lengths = np.fromiter(map(len, pieces), "i8", len(pieces))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(pieces) else 0
        symbol = self.byte_ids[np.frombuffer(b"".join(pieces), "u1")]
        after = np.arange(1, total + 1, dtype="i8")
        before = np.arange(-1, total - 1, dtype="i8")
        filled = lengths > 0
        after[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(positions: np.ndarray) -> None:
            rank = self.ranks(symbol[positions], symbol[after[positions]])
            positions, rank = positions[rank >= 0], rank[rank >= 0]
            if not len(rank):
                return
            by = np.argsort(rank, kind="stable")
            positions, rank = positions[by], rank[by]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, held in zip(rank[np.r_[0, cuts]].tolist(), np.split(positions, cuts)):
                if r in index:
                    index[r].append(held)
                else:
                    index[r] = [held]
                    heapq.heappush(heap, r)

        post(np.flatnonzero(after >= 0))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            if len(at) > 1:
                at = np.unique(at)
            a, b, made = self.left[rank], self.right[rank], self.result[rank]
            at = at[(symbol[at] == a) & (after[at] >= 0)]
            at = at[symbol[after[at]] == b]
            if not len(at):
                continue
            if a == b and len(at) > 1:  # aaa: of a run of overlapping pairs every second one merges, from the left
                fresh = np.r_[True, after[at[:-1]] != at[1:]]
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            gone = after[at]
            then = after[gone]
            symbol[at], symbol[gone], after[at] = made, -1, then
            has = then >= 0
            before[then[has]] = at[has]
            prior = before[at]
            post(np.concatenate((prior[prior >= 0], at[has])))

        left = symbol >= 0
        kept = np.concatenate(([0], np.cumsum(left)))[np.concatenate(([0], ends))]
        return symbol[left].astype("i4"), kept

    def text_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def _learn(self, memory: dict[bytes, bytes | None], back: dict[bytes, bytes], fresh: list[bytes], lead: bytes) -> None:
        """Remember the ids of new chunks. One that touches white space at an end cannot stand alone: None."""
        for start in range(0, len(fresh), INDEXED):
            keys, counts, pieces = [], [], []
            for key in fresh[start : start + INDEXED]:
                word = key.decode("utf-8", "replace")
                if not word or word[-1].isspace() or lead and word[0].isspace():
                    memory[key] = None
                    continue
                found = PIECES.findall(f" {word}" if lead else word)
                keys.append(key)
                counts.append(len(found))
                pieces += found
            ids, bounds = self.merge([p.encode() for p in pieces])
            cuts = bounds[np.concatenate(([0], np.cumsum(counts, dtype="i8")))]
            whole, raw = self.text_bytes(ids), ids.tobytes()
            at = np.concatenate(([0], np.cumsum(self.widths[ids])))[cuts].tolist()
            cuts = (cuts * 4).tolist()
            memory.update(zip(keys, [raw[s:e] for s, e in zip(cuts[:-1], cuts[1:])]))
            back.update(zip(keys, [whole[s:e] for s, e in zip(at[:-1], at[1:])]))

    def encode_batch(self, texts: list[bytes], specials: bool = True) -> list[tuple[np.ndarray, bytes]]:
        """(ids, bytes decoded from those ids) of each whole text.

        A single space between two characters that are not white space always starts a piece, so texts are cut there and
        each distinct chunk is encoded once. Texts with other runs of white space are cut by the full pattern. Without
        ``specials`` the strings of added tokens are ordinary text.
        """
        added = self.added if specials else {}
        if len(self.chunks) > REMEMBERED:
            for memory in (self.chunks, self.chunk_texts, self.heads, self.head_texts):
                memory.clear()
        parts = [self._segments(t) if added else [t] if t else [] for t in texts]
        new, heads = set(), set()
        for segments in parts:
            for s in segments:
                if s not in added:
                    words = s.split(b" ")
                    heads.add(words[0])
                    new.update(words[1:])
        self._learn(self.chunks, self.chunk_texts, [w for w in new if w not in self.chunks], b" ")
        self._learn(self.heads, self.head_texts, [w for w in heads if w not in self.heads], b"")
        return [self._encode(segments, added) for segments in parts]

    def _segments(self, text: bytes) -> list[bytes]:
        return [s for s in self.added_split.split(text) if s] if self.added_split else [text] if text else []

    def _encode(self, segments: list[bytes], added: dict[bytes, int]) -> tuple[np.ndarray, bytes]:
        ids: list[bytes] = []
        texts: list[bytes] = []
        for s in segments:
            if s in added:
                ids.append(np.array([added[s]], "i4").tobytes())
                texts.append(s)
                continue
            words = s.split(b" ")
            known = [self.heads[words[0]], *map(self.chunks.__getitem__, words[1:])]
            if None in known:
                found, _ = self.merge([p.encode() for p in PIECES.findall(s.decode("utf-8", "replace"))])
                ids.append(found.tobytes())
                texts.append(self.text_bytes(found))
            else:
                ids += known
                texts.append(self.head_texts[words[0]])
                texts += map(self.chunk_texts.__getitem__, words[1:])
        return np.frombuffer(b"".join(ids), "i4"), b"".join(texts)


@cache
def codec(path: str) -> Codec:
    """One vocabulary a process."""
    return Codec(path)


def coded(own: Codec, batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, bytes]]]]:
    """Slices of the batches, each with its ids and what they decode to. A task holds those of ENCODED_BYTES of text at a time."""
    for batch in slices(batches, text, ENCODED_BYTES):
        yield batch, own.encode_batch([t or b"" for t in byte_texts(batch, text)])


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``ids`` array<int>, ``decoded`` string: the text's ids and what these ids decode to.

    ``path`` is a byte-level BPE file in JSON, found on every executor. The strings of added tokens become their ids
    anywhere in a text, and come back as those strings. A null or empty text has no ids and decodes to the empty text.
    Rows stay as they are, repeated rows and null keys too; no shuffle. A column named ``ids`` or ``decoded`` is replaced.
    """
    base = without(df, ("ids", "decoded"))
    keep = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, done in coded(codec(path), batches, text):
            lengths = np.array([len(ids) for ids, _ in done], "i4")
            ids = np.concatenate([ids for ids, _ in done])
            back = pa.array([b.decode("utf-8", "replace") for _, b in done], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, list_array(ids, lengths, pa.int32()), back], names=[*keep, "ids", "decoded"])

    schema = T.StructType([*base.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return base.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``: the text of each row's ids, special tokens included. Null ids decode to null.

    Bytes that are not UTF-8 become the replacement character. An id outside the vocabulary is an error.
    """
    base = without(df, ("decoded",))
    kept = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if v is None else own.text_bytes(np.array(v, "i8")).decode("utf-8", "replace") for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, "decoded"])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(df: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids (decimal, joined by commas) and of the decoded text, and the columns ``keep``."""
    coded = encode(df.select("doc_id", "text", *keep), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *keep,
    )


def digest_of(ids: list[int], decoded: str) -> tuple[str, str]:
    """The two digests of one document, for tests."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
