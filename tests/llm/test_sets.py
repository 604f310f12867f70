"""Near-duplicates, components, language-model scores, nearest vectors, and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vendaval.llm import bpe, language, lm, mixing, nearest, neardup
from vendaval.llm.components import components
from vendaval.llm.queries import VOCABULARY
from vendaval.session import cut_lineage

from . import helpers


def _texts(seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [" ".join(word() for _ in range(rng.randint(40, 120))) for _ in range(30)]
    out: list[str | None] = [None, "", " \n", "one", "one", "one two", "ONE TWO", "a b c", "a b c d"]
    for text in base:
        out.append(text)
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            words = text.split()
            for _ in range(edits):
                words[rng.randrange(len(words))] = word()
            out.append(" ".join(words))
    chain = base[0].split()
    for k in range(0, 24, 2):  # each links with the next, the first not with the last
        chain = [*chain[2:], word(), word()]
        out.append(" ".join(chain))
    return out + [base[1]] * 200


def test_near_duplicates_against_all_pairs(spark):
    texts = _texts()
    rows = [(i * 3 % 1009, t, "x") for i, t in enumerate(texts)]
    for size, threshold in ((3, 85), (5, 80)):
        want = helpers.groups({i: t for i, t, _ in rows}, size, threshold)
        df = spark.createDataFrame([*rows, (None, texts[20], "x"), rows[40]], "doc_id long, text string, component_id string")
        got = neardup.near_duplicates(df, size, threshold).collect()
        assert len(got) == len(rows) + 2
        for r in got:
            if r.doc_id is None:
                assert r.kept and r.component_id is None
                continue
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles == len(helpers.shingles(dict((i, t) for i, t, _ in rows)[r.doc_id], size))
        kept = neardup.deduplicate(df, size, threshold)
        assert kept.columns == df.columns
        assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c} | {None}
    assert neardup.near_duplicates(df.where("false")).count() == 0


def test_a_key_with_several_texts(spark):
    """Each text is judged by itself: the key's rows may belong to different groups."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a), (5, b), (3, a + " more"), (4, b), (9, "c " * 20)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(3, 3, True), (4, 4, True), (5, 3, False), (5, 4, False), (9, 9, True)]


def test_dense_region_keeps_together(spark):
    """Far more near copies than a neighbourhood reaches, all one group; and one that only resembles them."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(600):
        words = list(base)
        words[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows.append((1000, " ".join(base[:75] + [f"y{i}" for i in range(75)])))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == {**dict.fromkeys(range(600), 0), 1000: 1000}


def test_template_family_just_below_the_threshold(spark):
    """Far more rows share a passage than the reach has, each pair just under the threshold; planted pairs are just above."""
    rows, want = [], {}
    for i in range(1600):
        tail = [f"t{i}x{k}" for k in range(18)]
        if i >= 1500:  # shares 6 shingles with its partner besides the passage
            partner = i - 1400
            tail[:6] = [f"t{partner}x{k}" for k in range(6)]
            want[i] = partner
        rows.append((i, " ".join([f"w{k}" for k in range(150)] + tail)))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 85).collect()}
    assert got == {i: want.get(i, i) for i in range(1600)}


def test_blocks_of_components_are_linked():
    sets = [np.arange(a, a + 100, dtype="u8") for a in (0, 5, 40, 45, 1000)]
    own = np.array([1, 2, 3, 3, 4])
    assert neardup.linked_components((own, sets), None, 80) == [(1, 2)]
    assert neardup.linked_components((own[:1], sets[:1]), (own[1:], sets[1:]), 80) == [(1, 2)]
    assert neardup.linked_components((own[:2], sets[:2]), (own[4:], sets[4:]), 80) == []


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(200, 260)] + [(300, 301), (301, 300), (7, 7), (None, 4)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, **dict.fromkeys(range(200, 260), 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lm_counts_and_gain(spark):
    docs = spark.read.parquet(f"{helpers.SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_001, None), (10_002, ""), (None, "the of"), (10_003, "the of"), (10_003, "the of")]
    got = lm.contract(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = lambda t: helpers.WORD.findall(helpers.lower(t or "")) + ["\n"]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    text = dict(rows)
    for r in got:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(text[r.doc_id]))
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
        assert math.isfinite(r.score) and r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)


def test_lm_blocks_are_bounded(spark):
    """One row repeated in a single partition, as in one large file: more bytes than a block may have."""
    same = spark.range(0, 9000, 1, 1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"), F.lit(True).alias("learn"))
    few = spark.createDataFrame([(2, "a b", True), (None, None, False)], "doc_id int, text string, learn boolean")
    got = lm.in_blocks(same.union(few)).groupBy("block").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 9002 and sum(r.bytes or 0 for r in got) == 45_000_003
    assert max(r.bytes or 0 for r in got) <= lm.BLOCK_BYTES + 5000


def test_lm_without_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.scores(df, F.lit(False)).collect()}
    assert got[1].base_score == 0 and got[1].train_tokens == 0 and abs(got[1].score + 3 * math.log10(lm.CELLS)) < 1e-4
    assert got[2].n_tokens == 1 and lm.scores(df.where("false"), F.lit(True)).count() == 0


def test_lm_cells_are_a_distribution():
    rng = np.random.default_rng(0)
    own = lm.Weights()
    for t in own.tables:
        t += rng.normal(size=t.shape).astype("f4")
    every = np.arange(lm.CELLS)
    history = np.array([3, 400])
    total = sum(10 ** lm.cell_log10(own.tables, np.array([*history, c]), np.array([0]))[-1] for c in every)
    assert abs(total - 1) < 1e-4


@pytest.mark.parametrize("width", [lm.CLASSES, lm.WIDTH])
def test_softmax_runs_along_rows_with_the_same_bits(width):
    rng = np.random.default_rng(width)
    table, rows = rng.normal(0, 3, (50, width)).astype("f4"), [rng.integers(0, 50, 700) for _ in range(3)]
    z = table[rows[0]] + table[rows[1]] + table[rows[2]]
    z -= z.max(1, keepdims=True)
    want = z - np.log(np.exp(z).sum(1, keepdims=True))
    got, target = lm._log_softmax(table, rows), rng.integers(0, width, 700)
    assert got.shape == (width, 700) and got.flags.c_contiguous and np.array_equal(got, want.T)
    assert np.array_equal(lm._log_softmax_at(table, rows, target), want[np.arange(700), target])


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16)).astype("f4")
    vectors[1000:2000] = vectors[7]  # a third of all rows are one vector
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] + [1.0] * 15), (5060, [float("inf")] + [1.0] * 15), (5080, [None] + [1.0] * 15), (5100, []), (None, [1.0] * 16)]
    df = spark.createDataFrame([*rows, *[(i, v, "x") for i, v in bad], rows[40]], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in nearest.contract(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x, hit, total = vectors.astype("f8"), 0, 0
    assert set(got) == set(range(0, 3000, 20))
    for q, found in got.items():
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        order = np.lexsort((np.arange(3000), -score))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and len({v for _, v, _ in found}) == 20
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hit, total = hit + len({v for _, v, _ in found} & set(order)), total + 20
    assert hit >= 0.9 * total


def test_nearest_recall_on_uneven_norms():
    rng = np.random.default_rng(2)
    for sigma in (0, 0.25, 0.5, 1):
        x = rng.normal(size=(8192, 64))
        x *= np.exp(sigma * rng.normal(size=(8192, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
        block = nearest.Block(x, x[: nearest.PIVOTS])
        hit = sum(len({*at[:20]} & {*np.argsort(-(x @ q))[:20]}) for q, (at, _) in zip(x[200:300], block.search(x[200:300], 20)))
        assert hit >= 0.9 * 2000, (sigma, hit)


def test_nearest_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (20, [1.0, 1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest.contract(df).orderBy("query_id", "rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert nearest.contract(df.where("false")).count() == 0


def test_pipeline_against_plain_steps(spark):
    docs = spark.read.parquet(f"{helpers.SMALL}/documents.parquet")
    model = language.train(docs, ~language.held_out())
    named = {r.doc_id for r in language.identify(docs, model).where("lang_pred <> 'und'").collect()}
    assert named == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}

    def clean(text):
        m, low = helpers.quality(text), text
        n, capitals = m["n_words"], sum("A" <= c <= "Z" for c in low)
        lines = sum(bool(helpers.WORD.search(x)) for x in text.split("\n"))
        return not (
            n < 10 or 100 * m["n_repeat_words"] > 20 * n or 100 * m["n_symbols"] > 20 * n or 100 * m["n_dup_lines"] > 50 * lines
            or not 2 * n <= m["word_chars"] <= 15 * n or 100 * capitals > 30 * m["word_chars"] or 100 * text.count("!") > 20 * n
        )

    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in named and clean(r.text)}
    kept = {i for i, c in helpers.groups(text, 5, 80).items() if i == c}
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = []
    for i in kept:
        ids = library.encode(text[i], add_special_tokens=False).ids
        want.append((i, len(ids), *bpe.digest_of(ids, library.decode(ids, skip_special_tokens=False))))
    got = corpus_pipeline.run(spark, helpers.SMALL).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_pipeline_returns_the_mix_in_its_order(spark):
    """After the files are read back, in the order Spark likes: three sources with equal words stay side by side."""
    rows = [(i, "word " * (4000 + 10 * i), "en", "abc"[i % 3], 1) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    again = cut_lineage(corpus_pipeline.source_mix(spark, docs, ""), "mixed")
    got = [r.doc_id for r in corpus_pipeline.bpe_round_trip(spark, again, "").collect()]
    assert sorted(got) == list(range(90))
    slots = {r.doc_id: r.slot for r in mixing.schedule_of(docs).collect()}
    assert [slots[i] for i in got] == sorted(slots.values())
    words = Counter()
    for i in got:
        words["abc"[i % 3]] += 4000 + 10 * i
        assert max(words.values()) - min(words[s] for s in "abc") <= 2 * (mixing.BLOCK_WORDS + 4900)


def test_last_stage_keeps_the_order_it_is_given(spark, monkeypatch):
    """It reads the order of the stage before from the files and mixes nothing itself."""
    rows = [(i, "word " * (1 + i * 7 % 90), "en", "abc"[i % 3], 1) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(mixing, "mix", None)
    for key in (F.desc("doc_id"), F.xxhash64("doc_id")):
        given = docs.orderBy(key)
        again = cut_lineage(given.repartitionByRange(7, key).sortWithinPartitions(key), "given")
        got = [r.doc_id for r in corpus_pipeline.bpe_round_trip(spark, again, "").collect()]
        assert got == [r.doc_id for r in given.collect()]


def test_pipeline_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, words int, block string, slot int, ids string, measures int"
    plain = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, plain), (2, plain), (3, None), (4, ""), (None, "another text that nobody has written down so far with enough words"), (5, "1 2 3"), (2, plain)]
    docs = spark.createDataFrame([(i, t, "en", None, 1, 2, "b", 3, "i", 4) for i, t in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, helpers.SMALL)
        assert out.columns == docs.columns
        docs = out
    assert sorted((r.doc_id is None, r.doc_id) for r in docs.collect()) == [(False, 1), (True, None)]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, helpers.SMALL).count() == 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), helpers.SMALL).count() == 0


def test_components_are_made_again_only_when_links_were_found(spark, monkeypatch):
    made, usual = [], neardup.components
    monkeypatch.setattr(neardup, "components", lambda *links: made.append(1) or usual(*links))
    common = " ".join(f"w{i}" for i in range(200))
    rows = [(i, common + "".join(f" o{i}x{k}" for k in range(30))) for i in range(12)]  # alike, below the threshold
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.component_id for r in neardup.near_duplicates(df, 3, 85).collect()) == list(range(12))
    assert len(made) == 1
