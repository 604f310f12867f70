"""Byte-pair codec, token files, quality ledger, language identification."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vendaval.llm import bpe, language, quality, tokenfiles
from vendaval.llm.queries import END_OF_TEXT, VOCABULARY
from vendaval.session import cut_lineage

from .helpers import SMALL, quality as plain_quality

PATH = public_tokenizers.path(VOCABULARY)
ODD = [
    None, "", " ", "a", "  a  b", "aaa aaaaaaa aaaa", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>", "foo \n bar\n\n baz\t\tq", "it's  they're 'll  x",
    "é  日本語 12 345  ", "\n", "a \n", "\n a", "😀😀 😀", "l̀ 　x", "abababab abab ab", "word " * 500, "same", "same",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encode_and_decode_as_the_library(spark, library):
    rows = [(i, t, "x", 7) for i, t in enumerate(ODD)] + [(None, "no key", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string, extra int")
    got = bpe.encode(df, PATH).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "extra", "ids", "decoded"}
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.text
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    back = bpe.decode(bpe.encode(df, PATH).select("doc_id", "ids"), PATH).collect()
    assert {(r.doc_id, r.decoded) for r in back} == {(r.doc_id, r.decoded) for r in got}


def test_codec_on_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want = bpe.digest_of(ids, library.decode(ids, skip_special_tokens=False))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (len(ids), *want)
    assert bpe.digests(docs.where("false"), PATH).count() == 0


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "INDEXED", 2)
    small, large = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four five", "three four seven one", "a  b one"):
        assert small.encode_batch([text.encode()])[0][0].tolist() == large.encode(text).ids


def test_a_task_encodes_two_megabytes_at_once():
    class Recorder:
        sizes: list[int] = []

        def encode_batch(self, texts):
            self.sizes.append(sum(map(len, texts)))
            return [(np.zeros(0, "i4"), t) for t in texts]

    texts = [None, *["x" * 300_000] * 20, "y" * 3_000_000, ""]
    got = [t for _, done in bpe.coded(Recorder(), [pa.RecordBatch.from_pydict({"text": texts})], "text") for _, t in done]
    assert got == [(t or "").encode() for t in texts]
    assert sorted(Recorder.sizes)[-2] <= 2 << 20 and max(Recorder.sizes) == 3_000_000


def test_cut_lineage_sends_small_batches_to_python(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    wide = spark.range(0, 80, 1, 1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = cut_lineage(wide.mapInArrow(sizes, "rows long, size long")).collect()
    assert sum(r["rows"] for r in found) == 80 and max(r["size"] for r in found) < 10_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


@pytest.mark.parametrize("block", [1, 3, 64])
def test_separator_scan(spark, block):
    rng = np.random.default_rng(block)
    files = {f: rng.integers(0, 4, n).astype("<u2") for f, n in (("a", 500), ("b", 64), ("c", 0), ("d", 3))}
    files["e"] = np.full(50, 9, "<u2")  # no separator at all
    rows = [(f, k, bytearray(x[s : s + block].tobytes())) for f, x in files.items() for k, s in enumerate(range(0, len(x), block))] + [("f", 0, None)]
    got = tokenfiles.counts(tokenfiles.scan(spark.createDataFrame(rows, "file string, block long, data binary"), 0)).collect()
    want = []
    for f, x in files.items():
        start = 0
        ends = np.flatnonzero(x == 0).tolist()
        for k, e in enumerate(ends):
            want.append((f, k, e - start, True))
            start = e + 1
        if len(x) > start:
            want.append((f, len(ends), len(x) - start, False))
    assert sorted((r.file, r.ordinal, r.n_tokens, r.closed) for r in got) == sorted(want)


def test_strides_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "STRIDE", 4)
    x = np.array(([5] * 9 + [0]) * 7 + [5, 5], "<u2")
    rows = [(1, k, bytearray(x[k : k + 1].tobytes())) for k in range(len(x))]
    got = tokenfiles.counts(tokenfiles.scan(spark.createDataFrame(rows, "file int, block long, data binary"), 0)).collect()
    assert sorted((r.ordinal, r.n_tokens) for r in got) == [(k, 9) for k in range(7)] + [(7, 2)]


def test_counts_of_documents(spark, library, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "no key")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokenfiles.document_counts(df, PATH, END_OF_TEXT).collect()}
    library.encode_special_tokens = True
    assert got == {i: len(library.encode(t or "").ids) for i, t in [*enumerate(ODD), (None, "no key")]}
    library.encode_special_tokens = False
    assert tokenfiles.document_counts(df.where("false"), PATH, END_OF_TEXT).count() == 0
    np.array([1, 2, 0, 3, 0, 4], "<u2").tofile(tmp_path / "flat.bin")
    blocks = tokenfiles.read_flat(spark, str(tmp_path), block_ids=4)
    assert sorted((r.ordinal, r.n_tokens) for r in tokenfiles.counts(tokenfiles.scan(blocks, 0)).collect()) == [(0, 2), (1, 1), (2, 1)]


def test_quality_measures(spark):
    texts = [
        None, "", " \t\n", "one", "a b c d e f g h i j", "a b c d e a b c d e x", "x " * 40, "l\nl\n\nl\nm", "# $ %", "A!! B!! C!! D!! E!! F!! G!! H!! I!! J!!",
        "ß é 日本 " * 3, "z\x1cz q", "word " * 3000, *["same text again"] * 2,
    ]
    df = spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)] + [(None, "x", "m", 1)], "doc_id long, text string, measures string, FAILED int")
    got = quality.ledger(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = plain_quality(r.text)
        assert {k: r.measures[k] for k in want} == want, r.text
        base = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert (r.failed & quality.mask("base") != 0) == base
    kept = quality.keep(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.failed & quality.mask("v1") == 0}
    assert quality.keep(df.where("false")).count() == 0


def test_quality_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in quality.digest(docs).collect()}
    for r in docs.collect():
        want = plain_quality(r.text)
        assert {k: got[r.doc_id][k] for k in want} == want


def test_quality_runs_no_python(spark):
    plan = quality.digest(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_ablations(spark):
    ledger = spark.createDataFrame([(0,), (1,), (3,), (4,), (4,), (6,)], "failed long")
    got = {(r.policy, r.rule): (r.n_rejected, r.n_by_rule, r.n_only_by_rule) for r in quality.ablations(ledger).collect()}
    assert got["base", "few_words"] == (3, 2, 1) and got["base", "repeated_words"] == (3, 2, 1)
    assert got["v1", "symbols"] == (5, 3, 2) and got["v1", "shouting"] == (5, 0, 0)
    assert {v for v in {k: x for k, x in ((k, (r.n_rejected, r.n_by_rule)) for k, r in ((("",), r) for r in quality.ablations(ledger.where("false")).collect()))}.values()} == {(0, 0)}


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_cases(spark):
    rows = [(1, "the house is on the hill", "en", 0), (2, "das haus ist auf dem berg", "de", 0), (3, None, None, 0), (4, "", "en", 0), (5, "12 345 !!", "de", 0)]
    rows += [(6, "the house is on the mill", None, 0), (6, "the house is on the mill", None, 0), (None, "das haus ist auf", None, 0), (7, "a " * 100_000, None, 0), (8, "日本", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE int")
    model = language.train(df, F.lit(True))
    assert model.labels == ["de", "en"]
    got = language.identify(df, model).collect()
    assert len(got) == len(rows) and "SCORE" not in got[0].asDict()
    by = {(r.doc_id, r.text): r for r in got}
    assert all(by[r[:2]].lang_pred == "und" and by[r[:2]].score == 0 for r in (rows[2], rows[3], rows[4]))
    assert by[rows[5][:2]].lang_pred == "en" and by[rows[7][:2]].lang_pred == "de" and by[rows[9][:2]].lang_pred != "und"
    none = language.train(df.where("false"), F.lit(True))
    assert {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    only = language.train(df.where("lang = 'en'"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.identify(df.where("doc_id = 2"), only).collect()} == {("en", 1.0)}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 30])
def test_codewords_are_apart(n):
    codes = language.codewords(n)
    assert len({tuple(c) for c in codes}) == n and (abs(codes.sum(0)) < n).all()


def test_a_repeated_text_crowds_out_no_label(spark):
    from vendaval.llm import language

    german = [(1, "Der Hund schläft unter dem großen Baum im Garten.", "de", "x")] * 2000
    english = [(i, f"The cat number {i} sits on the warm roof of the house.", "en", "x") for i in range(2, 400)]
    df = spark.createDataFrame(german + english, "doc_id long, text string, lang string, verdict string")
    model = language.train(df, language.F.lit(True))
    assert model.labels == ["de", "en"]
    out = language.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang", "verdict", "lang_pred", "score", "ambiguous"]
    assert out.where("lang <> lang_pred OR verdict <> 'x'").count() == 0


def test_quality_keeps_columns_of_any_name(spark):
    names = ["text_", "words_", "windows_", "lines_", "pairs_", "starts_", "__words", "__windows", "__lines", "__measures", "TEXT__", "measures_"]
    texts = ["a b c d e f g h i j k", "same words in a row and again same words in a row and again " * 3, None, "l\nl\nm n o p q r s t u v w"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    ledger = quality.ledger(df)
    assert ledger.columns == [*df.columns, "measures", "failed"]
    assert sorted(tuple(r)[: len(df.columns)] for r in ledger.collect()) == sorted(rows)
    for r in ledger.collect():
        want = plain_quality(r.text)
        assert {k: r.measures[k] for k in want} == want
    kept = quality.keep(df.withColumn("measures", F.lit("mine")), "v1")
    assert kept.columns == [*df.columns, "measures"] and {tuple(r) for r in kept.collect()} <= {(*r, "mine") for r in rows}
