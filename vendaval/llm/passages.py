"""Removal of repeated passages by repeated-phrase automata.

A phrase is WINDOW consecutive words. The first occurrence of a phrase, by document and place, stays; the words of all others go.

1. Every text is turned into its words joined by one space and kept in blocks of bounded size. Documents with the same words
   are one text: the first of them takes part, the others are removed whole if they hold a phrase.
2. Anchors, the least of each run of hashed word groups, are the same wherever a phrase stands. Anchors that occur in one text
   only, and once in it, are out; phrases around the others are hashed, one row for each phrase and block, and counted. What
   occurs twice is a recurring phrase, known by its first occurrence and by one place in each block that holds it.
3. Each block compiles its recurring phrases, read from these places, into an Aho-Corasick automaton over the numbers of its
   words, five to a letter, and streams all parts of its documents that can hold one through it, which locates every occurrence. A block's automaton is one shard of
   the automaton of the whole corpus: it holds the phrases that occur there, and no document meets any other shard.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .batches import byte_texts, slices
from .order import positions

#: Words of a phrase, and of the groups whose least hash anchors it.
WINDOW, GROUP = 20, 8
#: Text bytes of a block; one text may be longer.
BLOCK_BYTES = 2 << 20
#: Phrases of one automaton, 0.2 KB each in memory; a block with more compiles one after the other.
SHARD_PHRASES = 50_000
#: Words that are one letter of an automaton; WINDOW is a multiple.
LETTER = 5
#: Bits of a word group's hash by which a block's text is compared with its phrases before the automaton reads it.
SEEN_BITS = 22

_ODD = np.random.default_rng(11).integers(1, 2**63, WINDOW, dtype="u8") | np.uint64(1)
_SECOND = np.random.default_rng(12).integers(1, 2**63, WINDOW, dtype="u8") | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_numbers(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of every word of texts end to end, the word of each number, words of each text)."""
    split = pc.split_pattern(words, " ")
    coded = split.values.dictionary_encode()
    return coded.indices.to_numpy().astype("i8"), coded.dictionary, np.diff(split.offsets.to_numpy()).astype("i8")


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of texts end to end, words of each text)."""
    numbers, known, lengths = word_numbers(words)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, known.to_pylist()), "u8", len(known))[numbers], lengths


def windows(h: np.ndarray, size: int, factors: np.ndarray = _ODD) -> np.ndarray:
    """Hash of each ``size`` consecutive words; empty if there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, "u8")
    total = np.full(n, size, "u8")
    for k in range(size):
        total += h[k : k + n] * factors[k]
    return _mixed(total)


def anchors(h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word group, start of every phrase, place of its anchor): its least group, the leftmost of equals.

    ``h`` are texts of ``lengths`` end to end; a phrase lies in one of them. Places of anchors ascend.
    """
    groups = windows(h, GROUP)
    starts = np.arange(len(h))
    starts = starts[starts + WINDOW <= np.repeat(np.cumsum(lengths), lengths)]
    if not len(starts):
        return groups, starts, starts
    return groups, starts, starts + np.lib.stride_tricks.sliding_window_view(groups, WINDOW - GROUP + 1).argmin(1)[starts]


def blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """block, row, id, n_words, print (SHA-256 of words), words (joined by one space) of every row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, "text"):
            joined = [b" ".join(t.split()) if t else b"" for t in byte_texts(batch, "text")]
            number = np.empty(len(joined), "i8")
            for i, t in enumerate(joined):
                if held and held + len(t) > BLOCK_BYTES:
                    block, held = block + 1, 0
                number[i] = block
                held += len(t)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number),
                    batch.column("id"),
                    pa.array([t.count(b" ") + 1 if t else 0 for t in joined], pa.int64()),
                    pa.array([hashlib.sha256(t).digest() for t in joined], pa.binary()),
                    pa.array(joined, pa.binary()),
                ],
                names=["block", "id", "n_words", "print", "words"],
            )

    docs = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    done = docs.mapInArrow(run, "block long, id long, n_words long, print binary, words binary")
    return cut_lineage(done.withColumn("row", F.monotonically_increasing_id()), "words")


def _anchor_counts(texts: DataFrame) -> DataFrame:
    """block, anchor, low, high: least and greatest print (64 bits) of the block's texts with the anchor; apart if one has it twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            h, lengths = word_hashes(batch.column("words"))
            groups, _, at = anchors(h, lengths)
            at = at[np.diff(at, prepend=-1) > 0]
            if not len(at):
                continue
            text = np.searchsorted(np.cumsum(lengths), at, "right")
            hashes, block = groups[at], batch.column("block").to_numpy()[text]
            print64 = np.array([np.frombuffer(p[:8], "i8")[0] for p in batch.column("print").to_pylist()])[text]
            order = np.lexsort((print64, hashes, block))
            hashes, print64, block = hashes[order], print64[order], block[order]
            starts = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (block[1:] != block[:-1])])
            ends = np.r_[starts[1:], len(hashes)] - 1
            low, high = print64[starts], print64[ends]
            # Once more in the same text: told apart from a copy of the text by the neighbours' prints in sorted order.
            text = np.flatnonzero(np.r_[False, (hashes[1:] == hashes[:-1]) & (block[1:] == block[:-1]) & (print64[1:] == print64[:-1])])
            twice = np.zeros(len(hashes), bool)
            twice[text] = True
            again = np.logical_or.reduceat(twice, starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[starts]), pa.array(hashes[starts].view("i8")), pa.array(low), pa.array(np.where(again & (low == high), ~high, high))],
                names=["block", "anchor", "low", "high"],
            )

    return texts.where(F.col("n_words") >= WINDOW).select("block", "print", "words").mapInArrow(run, "block long, anchor long, low long, high long")


def _recurring_anchors(texts: DataFrame) -> DataFrame:
    """block, anchor: those that occur in two texts, or twice in one text or in a block's copies of one; written."""
    found = cut_lineage(_anchor_counts(texts), "anchors")
    counted = found.groupBy("anchor").agg(F.min(F.least("low", "high")).alias("low"), F.max(F.greatest("low", "high")).alias("high"))
    recurring = cut_lineage(found.select("block", "anchor").join(counted.where("low <> high").select("anchor"), "anchor"), "recurring")
    release(found)
    return recurring


def _texts_of(own: pa.Table, numbers: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """(number, words) of the numbered rows of a block."""
    numbers = numbers.filter(pc.is_valid(numbers.column("row")))
    at = pc.index_in(own.column("row"), numbers.column("row")).combine_chunks()
    words = own.column("words").filter(pc.is_valid(at)).combine_chunks()
    return numbers.column("seq").to_numpy()[at.drop_null().to_numpy()], words


def _with_blocks(rows: DataFrame, numbered: DataFrame, more: DataFrame):
    """Rows of each block next to the numbers of its texts and the rows of ``more``, told apart by a null ``row``."""
    beside = numbered.select("block", "row", "seq").unionByName(more, allowMissingColumns=True)
    return rows.select("block", "row", "words").groupBy("block").cogroup(beside.groupBy("block"))


def _phrases(rows: DataFrame, numbered: DataFrame, wanted: DataFrame) -> DataFrame:
    """block, phrase, second (96 bits of hash), n, first (seq, start): phrases around the wanted anchors, their number in the block
    and the first place there."""
    kinds = pa.schema([("block", pa.int64()), ("phrase", pa.int64()), ("second", pa.int32()), ("n", pa.int64()), ("seq", pa.int64()), ("start", pa.int64())])

    def run(own: pa.Table, beside: pa.Table) -> pa.Table:
        keep = np.unique(beside.column("anchor").drop_null().to_numpy().view("u8"))
        if not own.num_rows or not len(keep):
            return kinds.empty_table()
        seqs, words = _texts_of(own, beside)
        h, lengths = word_hashes(words)
        groups, start, at = anchors(h, lengths)
        turn = np.diff(at, prepend=-1) > 0
        anchor = groups[at[turn]]
        start = start[(keep[np.minimum(np.searchsorted(keep, anchor), len(keep) - 1)] == anchor)[np.cumsum(turn) - 1]]
        if not len(start):
            return kinds.empty_table()
        phrase, second = (_mixed(sum((h[start + k] * f[k] for k in range(WINDOW)), np.uint64(WINDOW))) for f in (_ODD, _SECOND))
        second = (second >> np.uint64(32)).astype("u4").view("i4")
        ends = np.cumsum(lengths)
        text = np.searchsorted(ends, start, "right")
        seq, start = seqs[text], start - (ends - lengths)[text]
        order = np.lexsort((start, seq, second, phrase))
        phrase, second, seq, start = phrase[order], second[order], seq[order], start[order]
        first = np.flatnonzero(np.r_[True, (phrase[1:] != phrase[:-1]) | (second[1:] != second[:-1])])
        n = np.diff(np.r_[first, len(phrase)])
        block = np.full(len(first), own.column("block")[0].as_py())
        return pa.Table.from_arrays([pa.array(x) for x in (block, phrase[first].view("i8"), second[first], n, seq[first], start[first])], schema=kinds)

    return _with_blocks(rows, numbered, wanted).applyInArrow(run, "block long, phrase long, second int, n long, seq long, start long")


def automaton(phrases: list[tuple[int, ...]]) -> ahocorasick.Automaton:
    """Automaton over the digits of letters; a match gives the number of its phrase."""
    made = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, phrase in enumerate(phrases):
        made.add_word(phrase, i)
    made.make_automaton()
    return made


def _spans(flat: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the parts of texts of ``lengths`` end to end whose word groups all hash like groups of the phrases at ``at``; no
    phrase stands elsewhere."""
    inside = WINDOW - GROUP + 1
    groups = windows(flat.astype("u8"), GROUP) >> np.uint64(64 - SEEN_BITS)
    edges = np.bincount(at, minlength=len(groups) + 1) - np.bincount(at + inside, minlength=len(groups) + 1)
    seen = np.zeros(1 << SEEN_BITS, bool)
    seen[groups[np.cumsum(edges)[:-1] > 0]] = True
    hit = seen[groups]
    ends = np.cumsum(lengths)[:-1]
    for k in range(1, GROUP):  # groups across the end of a text
        hit[ends[ends < len(hit) + k] - k] = False
    turns = np.flatnonzero(np.diff(np.r_[False, hit, False]))
    return [(a, b + GROUP - 1) for a, b in turns.reshape(-1, 2).tolist() if b - a >= inside]


def _letters(flat: np.ndarray) -> np.ndarray:
    """Two digits for each LETTER consecutive words, the same where the words are.

    First and second digits differ. There are about as many of each as the root of the number of letters, so that no node of an
    automaton has many children.
    """
    name, many = flat, int(flat.max()) + 1
    for k in range(1, LETTER):
        name = pd.factorize(name[:-1] * many + flat[k:])[0]
    base = math.isqrt(len(name)) + 1
    return np.stack([name // base, name % base + base], axis=1)


def _located(rows: DataFrame, numbered: DataFrame, recurring: DataFrame) -> DataFrame:
    """seq, ends (from and to in words, alternately), n_removed, kept (SHA-256 of what stays) of the texts that lose words.

    ``recurring`` has block, at (seq and start of one place in the block) and first (those of the first occurrence of all). The
    automaton reads the parts of the texts that can hold one of its phrases.
    """
    kinds = pa.schema([("seq", pa.int64()), ("ends", pa.list_(pa.int64())), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(own: pa.Table, beside: pa.Table) -> pa.Table:
        known = beside.filter(pc.is_valid(beside.column("at_seq")))
        if not own.num_rows or not known.num_rows:
            return kinds.empty_table()
        seqs, words = _texts_of(own, beside)
        flat, _, lengths = word_numbers(words)
        opens = np.cumsum(lengths) - lengths
        by_seq = np.argsort(seqs)

        def place(kind: str) -> np.ndarray:
            """Where a place is in ``flat``, -1 in another block."""
            seq, start = (known.column(f"{kind}_{x}").to_numpy() for x in ("seq", "start"))
            at = by_seq[np.minimum(np.searchsorted(seqs, seq, sorter=by_seq), len(seqs) - 1)]
            return np.where(seqs[at] == seq, opens[at] + start, -1)

        at, first = place("at"), place("first")
        spans, letters, steps, later = _spans(flat, lengths, at), _letters(flat), np.arange(0, WINDOW, LETTER), []
        for shard in range(0, len(at), SHARD_PHRASES):
            machine = automaton([*map(tuple, letters[at[shard : shard + SHARD_PHRASES, None] + steps].reshape(-1, 2 * len(steps)).tolist())])
            for a, b in spans:
                for turn in range(a, a + LETTER):  # a stream for each way of cutting the span into letters
                    met = np.fromiter(chain.from_iterable(machine.iter(tuple(letters[turn : b - LETTER + 1 : LETTER].ravel().tolist()))), "i8").reshape(-1, 2)
                    start = turn + LETTER * (met[:, 0] // 2 + 1) - WINDOW
                    later.append(start[start != first[shard + met[:, 1]]])
        later = np.sort(np.concatenate([*later, np.zeros(0, "i8")]))
        text = np.searchsorted(opens, later, "right") - 1
        starts: dict[int, list[int]] = {}
        for i, start in zip(text.tolist(), (later - opens[text]).tolist()):
            starts.setdefault(i, []).append(start)
        out = []
        for i, found in starts.items():
            own_words, ends = words[i].as_py().split(), []
            for start in found:
                if ends and start <= ends[-1]:
                    ends[-1] = start + WINDOW
                else:
                    ends += (start, start + WINDOW)
            stay = [w for a, b in zip([0, *ends[1::2]], [*ends[::2], len(own_words)]) for w in own_words[a:b]]
            out.append((int(seqs[i]), ends, len(own_words) - len(stay), hashlib.sha256(b" ".join(stay)).digest()))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 4, kinds.types)], schema=kinds)

    return _with_blocks(rows, numbered, recurring).applyInArrow(run, "seq long, ends array<long>, n_removed long, kept binary")


def repeated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_removed, spans (array of from, to in words, in order), kept (SHA-256 of the words that stay, joined by
    one space) of every row of ``df``.

    Words are runs without the six ASCII separators; null and empty texts have none and lose none. A phrase occurs earlier if it
    does in a row with a smaller key, or before in the same row. Null keys come first; of rows that share a key one, the same
    for all phrases, comes before the other. Runs several jobs and writes to the shared folder.
    """
    rows = blocks(df, key, text)
    # One row of each text, the first: it numbers the text. Copies come after it, so it is the only one that may keep anything.
    one = rows.where(F.col("n_words") >= WINDOW).groupBy("print").agg(F.min(F.struct("id", "row", "block")).alias("one"))
    ordered = positions(one.select("print", "one.*", F.lit("").alias("all")), "all", ["id", "row"], "texts")
    numbered = cut_lineage(ordered.select("print", "block", "row", F.col("position").alias("seq")), "numbers")

    wanted = _recurring_anchors(rows)
    found = cut_lineage(_phrases(rows, numbered, wanted), "phrases")
    release(wanted)
    hashes = ["phrase", "second"]
    counted = found.groupBy(*hashes).agg(F.sum("n").alias("n"), F.min(F.struct("seq", "start")).alias("first")).where("n > 1")
    recurring = cut_lineage(
        found.join(counted.select(*hashes, "first"), hashes)
        .where("n > 1 OR struct(seq, start) <> first")  # a block that holds the first occurrence alone loses nothing by it
        .select(
            "block", F.col("seq").alias("at_seq"), F.col("start").alias("at_start"), F.col("first.seq").alias("first_seq"), F.col("first.start").alias("first_start")
        ),
        "recurring",
    )
    release(found)
    lost = cut_lineage(_located(rows, numbered, recurring), "located")
    release(recurring)

    fate = numbered.join(lost, "seq", "left").select("print", F.col("row").alias("one"), "ends", "n_removed", "kept")
    met = rows.select("row", "id", "n_words", "print").join(fate, "print", "left")
    copy = F.col("one").isNotNull() & (F.col("one") != F.col("row"))
    nothing = F.lit(hashlib.sha256(b"").digest())
    ends = F.when(copy, F.array(F.lit(0).cast("long"), "n_words")).otherwise(F.coalesce("ends", F.array().cast("array<bigint>")))
    return met.select(
        F.col("id").alias(key),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.transform(
            F.filter(ends, lambda e, i: i % 2 == 0),
            lambda e, i: F.struct(e.alias("from"), F.get(ends, 2 * i + 1).alias("to")),
        ).alias("spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept", "print")).alias("kept"),
    )


def digest(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return repeated(df).select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))
