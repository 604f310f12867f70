"""Merkle manifest against a plain version."""

from __future__ import annotations

import hashlib
import re
import zlib

from vendaval.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, low=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), row[4]) if low and row[4] is not None else row[4]
    return sha("".join(map(field, (*row[:4], text))))


def climb(nodes):
    """(root, proof of each node: a list of (before, after))"""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // 8 * 8
            proofs[k].append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
            at[k] = i // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], proofs


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        trees[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    tops = {g: climb([leaf(r) for r in trees[g]]) for g in order}
    root, above = climb([tops[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for r, proof in zip(trees[g], tops[g][1]):
            whole = proof + above[k]
            at = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for before, after in whole:
                at = sha(before + at + after)
            out.append((r[0], leaf(r), tops[g][0], root, sha("".join(b + a for b, a in whole)), at, at == root))
    return sorted(out, key=str)


def check(spark, rows, extra=()):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    schema += "".join(f", `{c}` string" for c in extra)
    df = spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema)
    got = merkle.proofs(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_trees_of_many_heights(spark):
    rows = [(i * 7 % 1009, "web" if i % 3 else None, ("en", "fr", None, "ü")[min(i % 11, 3)], i, f"Text {i} É\n" * (i % 4)) for i in range(700)]
    rows += [(5000, None, "", None, None), (5001, "s", "zz", 3, ""), (None, None, None, None, None)]
    check(spark, rows, extra=("tree", "position", "mark", "path", "digest", "row"))


def test_one_language_one_row_and_no_row(spark):
    check(spark, [(i, "s", "en", 1, "A") for i in range(8)])
    check(spark, [(i, "s", "en", 1, "A") for i in range(9)])
    check(spark, [(3, "s", "en", 1, "ABC")])
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.proofs(empty).collect() == []


def test_repeated_rows_and_more_languages_than_a_run(spark):
    rows = [(1, "s", "en", 1, "Same")] * 20 + [(1, "s", "en", 1, "Other")] * 3 + [(k, None, f"l{k}", 0, "X" * 100_000) for k in range(70)]
    check(spark, rows)
