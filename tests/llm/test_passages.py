"""Removal of repeated passages against a plain version."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendaval.llm import passages

from .helpers import SMALL, WORD


def plain(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(map(tuple, passages.digest(df).collect()), key=str) == plain([(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("shard", (50_000, 7))
def test_odd_documents(spark, shard, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_PHRASES", shard)
    monkeypatch.setattr(passages, "BLOCK_BYTES", 3000)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcé") for _ in range(3))
    shared = [" ".join(word() for _ in range(n)) for n in (20, 19, 45, 300)]
    rows = [(None, " ".join([shared[0], word(), shared[2]])), (1, None), (2, ""), (3, "one two"), (4, "a b " * 40), (5, "x " * 20), (6, "x " * 19), (7, "x " * 21)]
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(6)]
        rows.append((100 - i, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(200 + i, rows[20][1]) for i in range(30)] + [(300, rows[20][1].replace(" ", "  "))] + [(301, "y " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "block", "seq", "print", "words", "n_words", "spans")})
    assert sorted(map(tuple, passages.digest(df).collect()), key=str) == plain(rows)


def test_repeated_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 5 + [(2, "q " + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(passages.repeated(df).select("doc_id", "n_words", "n_removed", "spans").collect())
    assert [(r.doc_id, r.n_removed) for r in got] == [(1, 0), (1, 30), (1, 30), (1, 30), (1, 30), (2, 30)]
    assert [tuple(s) for s in got[-1].spans] == [(1, 31)] and got[0].spans == []
    assert passages.digest(df.where("false")).collect() == []


def test_the_automaton_reads_only_parts_that_can_hold_a_phrase():
    rng = np.random.default_rng(5)
    flat, phrase = rng.integers(0, 1000, 5000), np.arange(2000, 2020)
    for start in (100, 2000, 2025, 4980):
        flat[start : start + 20] = phrase
    flat[3000:3019] = phrase[:19]  # a word short
    assert passages._spans(flat, np.array([5000]), np.array([100])) == [(100, 120), (2000, 2020), (2025, 2045), (4980, 5000)]
    assert passages._spans(flat, np.array([2010, 2990]), np.array([100])) == [(100, 120), (2025, 2045), (4980, 5000)]  # two texts
    assert passages._spans(np.full(50, 7), np.array([50]), np.array([4])) == [(0, 50)]


def test_letters_are_equal_where_words_are_and_nodes_have_few_children():
    flat = np.random.default_rng(6).integers(0, 3, 20_000)
    digits = passages._letters(flat)
    words = [tuple(flat[i : i + passages.LETTER].tolist()) for i in range(len(digits))]
    assert len(digits) == len(flat) - passages.LETTER + 1 and len(set(zip(words, map(tuple, digits.tolist())))) == len(set(words))
    distinct = passages._letters(np.arange(10_000))
    assert len(set(map(tuple, distinct.tolist()))) == len(distinct) and len(np.unique(distinct)) <= 202
    assert not set(distinct[:, 0]) & set(distinct[:, 1])
