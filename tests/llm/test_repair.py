"""Repair of conversations against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from vendaval.llm import auction, repair

from .helpers import SMALL

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def best(codes):
    """Least (cost, edits) by states, layer after layer."""
    at = {0: (0, "")}

    def inserts(at):
        for _ in range(4):
            for state, (cost, edits) in list(at.items()):
                to = 3 if state == 2 else 2
                at[to] = min(at.get(to, (9e9, "")), (cost + 3, edits + "I"))
        return at

    for initial, fault in codes:
        new = {}
        for state, (cost, edits) in inserts(at).items():
            ways = [(state, 4, "D")]
            if fault not in "12":
                more = 3 * (fault == "3")
                if (state, initial) in NEXT:
                    ways.append((NEXT[state, initial], more, "K"))
                ways.append((3 if state == 2 else 2, 3 + more, "R"))
            for to, c, letter in ways:
                new[to] = min(new.get(to, (9e9, "")), (cost + c, edits + letter))
        at = new
    at = inserts(at)
    return min(at[s] for s in (0, 3) if s in at)


@pytest.mark.parametrize("seed", range(40))
def test_auction_finds_the_least_cheapest_edits(seed):
    rng = random.Random(seed)
    codes = [(rng.choice("suax" if seed % 2 else "uuaa"), rng.choice("0000123")) for _ in range(rng.randint(0, 40))]
    text = "".join(a + b for a, b in codes)
    assert auction.whole(text) == best(codes)
    cuts = [0, *sorted(rng.sample(range(1, len(codes)), min(3, len(codes) - 1))), len(codes)] if len(codes) > 1 else [0, len(codes)]
    parts = [auction.crossings(text[2 * a : 2 * b]) for a, b in zip(cuts, cuts[1:])]
    cost, pieces = auction.chain(parts)
    assert (cost, "".join(pieces)) == best(codes)
    assert [sum(x != "I" for x in p) for p in pieces] == [b - a for a, b in zip(cuts, cuts[1:])]


def test_auction_without_a_way():
    price = [0, 0, 0]
    auction.auction([[("a", 1, 1)], [], []], 0, 2, price)
    assert price[0] == auction.INFINITE
    assert auction.least_path([[], []], 0, 1, [0, 0]) is None


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        codes, seen = [], set()
        for _, _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "1" if not last else "2" if (role, text) in seen else "3" if last[0] not in ".!?" else "0"
            seen.add((role, text))
            codes.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        cost, audit = best(codes)
        state, k, lines = 0, 0, []
        for letter in audit:
            _, _, role, text = own[k] if letter != "I" else (0, 0, 0, "")
            if letter != "D":
                role = role if letter == "K" else "assistant" if state == 2 else "user"
                state = NEXT[state, role[0]]
                lines.append(f"{role}:{text}")
            k += letter != "I"
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [sum(f == x for _, f in codes) for x in "123"]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert sorted(map(tuple, repair.audits(df).collect()), key=str) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_odd_conversations(spark, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", " \t", "Yes.", "No", "a?\n", "ß!", "x. "]
    rows = [(rng.choice([None, 1, 2, 3, 70, 71, 72]), rng.choice([None, *range(400)]), rng.choice(["user", "assistant", "system", "tool", None, "", "u"]), rng.choice(texts) or None) for _ in range(600)]
    rows += [(9, 4, "user", "Same.")] * 130 + [(10, i, ("assistant", "user")[i % 2], f"Turn {i}.") for i in range(150)] + [(11, 1, "user", "Long " * 50_000)]
    dropped = next(t for t in range(100) if zlib.crc32(f"12:{t}".encode()) % 20 == 0)
    rows.append((12, dropped, "user", "Gone."))
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, repair.audits(df.selectExpr("*", "'x' AS mark", "1 AS kind", "2 AS fault")).collect()), key=str)
    assert got == plain(rows)
    assert (12, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert repair.audits(df.where("false")).collect() == [] and repair.repair(df.where("false")).collect() == []


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 2, "user", "Hi."), (1, 3, "user", "There."), (1, 5, "assistant", "Yes."), (2, 1, "system", "S."), (2, 1, "system", "S.")], "c int, t int, r string, x string")
    got = sorted(map(tuple, repair.repair(df, "c", "t", "r", "x").collect()))
    assert got == [(1, 1, 2, "user", "Hi.", "K"), (1, 2, None, "assistant", "", "I"), (1, 3, 3, "user", "There.", "K"), (1, 4, 5, "assistant", "Yes.", "K")]


def test_auction_ends_where_insertions_go_round_without_a_way():
    # The last row can only be deleted, so that no way through the part ends at the start again once a user turn is there.
    ways = auction.crossings("u0" * 3 + "x1")
    assert all(after != auction.START for before, after, _, _ in ways if before != auction.START)
    assert auction.with_way([[("I", 1, 3)], [("I", 0, 3)], []], 2) == {2}


def test_auction_of_a_long_conversation():
    rng = random.Random(3)
    parts = [[(rng.choice("suax"), rng.choice("0000123")) for _ in range(64)] for _ in range(100)]
    cost, pieces = auction.chain([auction.crossings("".join(a + b for a, b in p)) for p in parts])
    assert (cost, "".join(pieces)) == best([row for p in parts for row in p])
