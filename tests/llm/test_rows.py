"""URL verdicts, source mixing, chat perspectives."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vendaval.llm import chat, mixing, urls

from .helpers import SMALL


def plain_verdict(url: str | None):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = re.search(r"[/?#]|\Z", rest).start()
        host, rest = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:end]), rest[end:]
        path = rest[: re.search(r"[?#]|\Z", rest).start()]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    has = lambda t: bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low))
    return host, path, None, "block" if any(map(has, urls.STRICT)) or sum(map(has, urls.SOFT)) >= 2 else "allow"


def test_url_verdicts(spark):
    odd = [
        None, "", "no scheme/xxx", "http://", "http://ORG/", "http://a.org", "http://a.org/x", "https://x.example.org/es/1", "http://example.org/en/12", "http://example.org/en/2",
        "http://notexample.org/es/", "http://a.com/fr/x", "http://a.com/de/x?u=http://b.org/", "http://a.net/xxx", "http://a.net/xxxl", "http://a.net/sex-bet", "http://a.net/bet/bet",
        "http://sex.net/#bet", "http://a.net/\nxxx\n", "http://a.net/free-download/cheap", "http://a.net/ÀXXX", "http://a.net/" + "a/" * 50_000 + "casino", *["http://b.net/poker?dating"] * 2,
    ]
    pages = [r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(odd + pages)], "page_id long, url string, HOST string")
    got = urls.judge(df).collect()
    assert len(got) == len(odd + pages)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url), r.url
    assert urls.verdicts(df.where("false")).count() == 0
    assert urls.judge(df.limit(3), strict=(), soft=()).count() == 3


@pytest.mark.parametrize("seed", range(20))
def test_plan_fills_every_slot_and_stays_within_a_block(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.randint(1, 900) for i in range(rng.randint(1, 7))} | ({None: 50} if seed % 2 else {})
    weights = {s: rng.random() for s in blocks} | ({"s0": 0} if seed % 3 == 0 else {})
    at = {}
    stretches = mixing.plan(blocks, weights, 60)
    for p in stretches:
        for k in range(p.last - p.first + 1):
            slot = p.start + k // len(p.slots) * p.period + p.slots[k % len(p.slots)]
            assert slot not in at
            at[slot] = (p.source, p.first + k, p.phase)
    assert sorted(at) == list(range(sum(blocks.values())))
    order = defaultdict(list)
    for slot in sorted(at):
        order[at[slot][0]].append(at[slot][1])
    assert all(order[s] == list(range(n)) for s, n in blocks.items())
    for phase in {p.phase for p in stretches}:
        share = {p.source: len(p.slots) / p.period for p in stretches if p.phase == phase}
        had = dict.fromkeys(share, 0)
        for n, slot in enumerate((t for t in sorted(at) if at[t][2] == phase), 1):
            had[at[slot][0]] += 1
            assert all(abs(had[s] - n * share[s]) < 1 for s in share)


def test_plan_is_earliest_deadline_first():
    """The periodic plan against a slot-by-slot simulation of two periods."""
    owned, period = {"a": 5, "b": 3, "c": 2}, 10
    one = mixing.one_period(owned, period)
    done, slots = dict.fromkeys(owned, 0), {s: [] for s in owned}
    for t in range(2 * period):
        ready = [(-(-(done[s] + 1) * period // a), s) for s, a in owned.items() if done[s] * period // a <= t]
        _, s = min(ready)
        slots[s].append(t)
        done[s] += 1
    assert {s: x + [t + period for t in x] for s, x in one.items()} == slots


def test_mix_keeps_all_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["hot", "hot", "b", "c", None]), 1) for i in range(600)]
    rows += [(None, "null key", "b", 1), (600, None, "b", 1), (5, rows[5][1], rows[5][2], 1), (601, "w " * 900, "c", 1), (602, "", "unweighted", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, SLOT int")
    mixed = mixing.mix(df, {"hot": 0.2, "b": 0.5, "c": 0.2, None: 0.1}, block_words=100)
    got = mixed.collect()
    assert sorted(map(str, ((r.doc_id, r.text, r.source) for r in got))) == sorted(map(str, (r[:3] for r in rows)))
    words = defaultdict(int)
    for r in sorted(got, key=lambda r: (str(r.source), r.block)):
        words[r.source] += r.words
    running = defaultdict(lambda: defaultdict(int))
    for r in got:
        running[r.source][r.block] += r.words
    for source, blocks in running.items():  # a block starts where the words before it say
        before = 0
        for block in sorted(blocks):
            assert block * 100 < before + 100 * 10 and before // 100 <= block
            before += blocks[block]
    slots = {(r.source, r.block): r.slot for r in got}
    assert len(set(slots.values())) == len(slots)
    assert all(r.slot > max(s for (x, _), s in slots.items() if x != "unweighted") for r in got if r.source == "unweighted")
    ordered = mixing.in_order(mixed).select("slot").withColumn("p", F.spark_partition_id()).collect()
    assert [r.slot for r in ordered] == sorted(r.slot for r in ordered)
    assert mixing.mix(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
        mixing.mix(df)


def plain_dialogues(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        for who in {t[3] for t in turns if t[2] and t[3] not in chat.CONTEXT}:
            for part in range(0, len(turns), chat.PART):
                text, mask = "", []
                for _, _, known, role, _, said in turns[part : part + chat.PART]:
                    mine = known and role == who
                    text += "<|assistant|>\n" if mine else f"<|{role}|>\n" if role in chat.CONTEXT else f"<|user|>{role if known else 'unknown'}\n"
                    if mine:
                        mask.append((len(text), len(text) + len(said) + len(chat.END)))
                    text += said + chat.END
                out[conv, who, part // chat.PART] = (text, mask)
    return out


def test_perspectives(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 7)
    monkeypatch.setattr(chat, "STRETCH", 40)
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["ann", "bob", "eve"]), f"t{t} é") for t in range(300)]
    rows += [(2, 0, "system", "rules"), (2, 1, "user", None), (2, 1, "user", None), (2, None, None, "late"), (2, 2, "assistant", ""), (3, 0, "system", "alone"), (None, 0, "ann", "x"), (None, 1, "bob", "y" * 50_000)]
    rows += [(4, 0, "ann", "again")] * 20
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, at string")
    got = {(r.conv_id, r.perspective, r.part): (r.text, [tuple(m) for m in r["mask"]]) for r in chat.perspectives(df).collect()}
    assert got == plain_dialogues(rows)
    for text, mask in got.values():
        assert all(text[a:b].endswith(chat.END) for a, b in mask)
    assert chat.renderings(df.where("false")).count() == 0


def test_mix_keeps_columns_of_any_name(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    names = ["h_", "bucket_", "run_", "of_", "part_", "total_", "before_", "first_", "last_", "start_", "period_", "slots_"]
    names += ["__h", "__bucket", "__run", "__s", "__source", "__first", "H__", "s", "last"]
    rows = [(None if i % 2 else i, f"text {i} " * (i % 5), "hot" if i % 3 else None, *[f"{n}{i}" for n in names]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    got = mixing.mix(df, block_words=50)
    assert got.columns == [*df.columns, "words", "block", "phase", "slot"]
    assert sorted(map(repr, (tuple(r)[: len(df.columns)] for r in got.collect()))) == sorted(map(repr, rows))


def test_blocks_of_null_keys_spread(spark, monkeypatch):
    """Rows without a key, and rows with one and the same, are put in order by their texts: blocks follow one another whole."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    df = spark.createDataFrame([(None if i < 400 else 7, f"w{i} x", "a") for i in range(800)], "doc_id long, text string, source string")
    got = mixing.with_blocks(df, "source", "doc_id", "text", 100)
    assert {r.block: r["count"] for r in got.groupBy("block").count().collect()} == {b: 50 for b in range(16)}
    spread = got.groupBy(F.pmod(F.shiftright(F.xxhash64("doc_id", "text"), 20), F.lit(40))).count()
    assert spread.agg(F.max("count")).first()[0] < 60
