"""Repair of conversation structure at least cost, by the auction shortest-path algorithm.

1. A range sort numbers the turns; rows are judged blank, duplicate, truncated or clean. The first occurrence of each role and
   text of a conversation is a pre-aggregated minimum that is joined back.
2. The turns are cut into parts of at most PART rows, each a short string of role initials and faults. A conversation in one
   part is solved at once. For longer ones every part gives the ways through it, and these are the arcs of a lattice of parts;
   it holds one row for PART turns. All paths are found by ``auction``.
3. Edits, in pieces for each part, meet the turns in one sorted stream a conversation, which keeps nothing but the current
   turn, the counts and the edits' letters. A conversation's turns end in one task, since its digest runs over its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import auction
from .batches import slices
from .order import marked

#: Rows of a part are those with equal mark div PART: at most so many.
PART = 64
#: Solutions kept in a task, by a part's codes: most conversations look like others.
REMEMBERED = 50_000

_SPACES = " \t\n\x0b\x0c\r"
_STOPS = (".", "!", "?")


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(_SPACES))


def turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, mark, same, initial, fault of every row, written in order. Nulls in role and text are a space.

    The order in a conversation is by turn, nulls first; rows of one turn go by the beginnings of role and text, then by a
    hash of both, so that equal ones are side by side. ``fault`` knows blank and truncated; duplicates come with ``codes``.
    """
    col = lambda c: F.col(f"`{c}`")
    held = df.select(
        col(conversation).alias("conv_id"),
        col(turn).cast("long").alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    keyed = cut_lineage(
        held.select(
            "*",
            F.substring("role", 1, 32).alias("by_role"),
            F.substring("text", 1, 64).alias("by_text"),
            F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("same"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "turns",
    )
    ordered = marked(keyed, ["conv_id", "turn", "by_role", "by_text", "same", "row"], label="turns")
    end = _trimmed(F.col("text"))
    fault = (
        F.when(end == "", auction.BLANK).when(~F.right(end, F.lit(1)).isin(*_STOPS), auction.TRUNCATED).otherwise(auction.CLEAN)
    )
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("x")
    return ordered.select("conv_id", "turn", "role", "text", "mark", "same", initial.alias("initial"), fault.alias("fault"))


def codes(rows: DataFrame) -> DataFrame:
    """conv_id, part, first (mark of its first row), codes (initial and fault of each row) of ``turns``."""
    light = rows.select("conv_id", "mark", "same", "initial", "fault")
    firsts = light.groupBy("conv_id", "same").agg(F.min("mark").alias("earliest"))
    met = light.alias("l").join(firsts.alias("f"), F.expr("l.conv_id <=> f.conv_id AND l.same = f.same"))
    again = (F.col("mark") > F.col("earliest")) & (F.col("fault") != auction.BLANK)
    judged = met.select("l.conv_id", "mark", F.concat("initial", F.when(again, auction.DUPLICATE).otherwise(F.col("fault"))).alias("code"))
    grouped = judged.groupBy("conv_id", F.expr(f"mark div {PART}").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("mark", "code"))).alias("own")  # PART rows at most
    )
    return grouped.select("conv_id", "part", F.col("own")[0]["mark"].alias("first"), F.array_join(F.col("own.code"), "").alias("codes"))


def edits(parts: DataFrame) -> DataFrame:
    """conv_id, first, codes, piece, cost of the parts: each part's edits (K keep, R new role, D delete, I insert before).

    Insertions at the end of a conversation are in its last piece; the cost stands with the first part. Of the cheapest edits
    those whose letters sort first are taken.
    """
    parts = cut_lineage(parts, "parts")
    many = parts.groupBy("conv_id").count()
    sized = cut_lineage(
        parts.alias("p").join(many.alias("m"), F.expr("p.conv_id <=> m.conv_id")).select("p.*", (F.col("count") > 1).alias("several")), "parts"
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = lru_cache(REMEMBERED)(auction.whole)
        for batch in batches:
            found = [whole(c) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "first", "codes")), pa.array([e for _, e in found], pa.string()), pa.array([c for c, _ in found], pa.int64())],
                names=["conv_id", "first", "codes", "piece", "cost"],
            )

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossings = lru_cache(REMEMBERED // PART)(auction.crossings)
        for batch in batches:
            ways = [crossings(c) for c in batch.column("codes").to_pylist()]
            flat = [[(a << 2 | b, cost, e) for a, b, cost, e in w] for w in ways]
            kinds = pa.list_(pa.struct([("states", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
            values = pa.array([[dict(zip(("states", "cost", "edits"), x)) for x in w] for w in flat], kinds)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "first", "codes")), values], names=["conv_id", "first", "codes", "ways"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        cost, pieces = auction.chain([[(w["states"] >> 2, w["states"] & 3, w["cost"], w["edits"]) for w in ways] for ways in rows["ways"]])
        return pd.DataFrame({"conv_id": rows["conv_id"], "first": rows["first"], "codes": rows["codes"], "piece": pieces, "cost": [cost, *[0] * (len(rows) - 1)]})

    kind = sized.schema["conv_id"].dataType.simpleString()
    out = f"conv_id {kind}, first long, codes string, piece string, cost long"
    short = sized.where("NOT several").select("conv_id", "first", "codes").mapInArrow(solve, out)
    ways = sized.where("several").select("conv_id", "first", "codes").mapInArrow(
        cross, f"conv_id {kind}, first long, codes string, ways array<struct<states:int,cost:bigint,edits:string>>"
    )
    return short.unionByName(ways.groupBy("conv_id").applyInPandas(join, out))


class Replay:
    """The turns of one conversation as they come, with the edits that apply to them."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost, self.n = conv_id, auction.START, 0, 0
        self.edits: list[str] = []
        self.waiting, self.codes, self.at, self.code_at = "", "", 0, 0
        self.faults = dict.fromkeys((auction.BLANK, auction.DUPLICATE, auction.TRUNCATED), 0)
        self.illegal, self.before = 0, None
        self.least = self.most = self.turn = None
        self.distinct = 0
        self.digest, self.empty = hashlib.sha256(), True

    def piece(self, letters: str, codes: str, cost: int) -> Iterator[tuple]:
        yield from self.rest()
        self.edits.append(letters)
        self.waiting, self.codes, self.at, self.code_at = letters, codes, 0, 0
        self.cost += cost

    def _out(self, role: str, text: str, letter: str, turn) -> tuple:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False
        self.n += 1
        return self.conv_id, self.n, turn, role, text, letter

    def _added(self) -> str:
        initial = auction.added(self.state)
        self.state = auction.MOVES[self.state][initial]
        return "user" if initial == "u" else "assistant"

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.waiting) and self.waiting[self.at] == "I":
            self.at += 1
            yield self._out(self._added(), "", "I", None)

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        initial, fault = self.codes[self.code_at : self.code_at + 2]
        self.code_at += 2
        if fault in self.faults:
            self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None:  # turns come in order
            self.distinct += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        yield from self.inserted()
        letter = self.waiting[self.at]
        self.at += 1
        if letter == "K":
            self.state = auction.MOVES[self.state][initial]
            yield self._out(role, text, letter, turn)
        elif letter == "R":
            yield self._out(self._added(), text, letter, turn)

    rest = inserted

    def summary(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest()


HEADER, PIECE, ROW = range(3)


def _stream(conversations: DataFrame, rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Headers, pieces and turns of each conversation, one after the other: a conversation is in one task, in order."""
    nothing = lambda kind: F.lit(None).cast(kind)
    headers = conversations.select("conv_id", F.lit(-1).cast("long").alias("mark"), F.lit(HEADER).alias("kind"), nothing("long").alias("turn"), nothing("string").alias("role"), nothing("string").alias("text"), nothing("long").alias("cost"))
    pieced = pieces.select("conv_id", F.col("first").alias("mark"), F.lit(PIECE).alias("kind"), nothing("long").alias("turn"), F.col("piece").alias("role"), F.col("codes").alias("text"), "cost")
    own = rows.select("conv_id", "mark", F.lit(ROW).alias("kind"), "turn", "role", "text", nothing("long").alias("cost"))
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return headers.unionByName(pieced).unionByName(own).repartition(n, "conv_id").sortWithinPartitions("conv_id", "mark", "kind")


def _replayed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Replay | None, list[tuple]]]:
    """(conversation that has ended or None, repaired rows that came out)."""
    current: Replay | None = None
    for batch in slices(batches, "text"):
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "cost")]
        for conv_id, kind, turn, role, text, cost in zip(*columns):
            if kind == HEADER:
                if current is not None:
                    yield current, list(current.rest())
                current = Replay(conv_id)
            elif kind == PIECE:
                yield None, list(current.piece(role, text, cost))
            else:
                yield None, list(current.row(turn, role, text))
    if current is not None:
        yield current, list(current.rest())


def _prepared(conversations: DataFrame, df: DataFrame) -> DataFrame:
    rows = turns(df)
    return _stream(conversations, rows, cut_lineage(edits(codes(rows)), "edits"))


def repair(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, n (from 1), turn, role, text, edit of the repaired conversations, whose roles are ``(s?(ua)+)?`` by initials.

    ``edit`` is K (kept), R (new role) or I (inserted: empty text, no turn). Nulls in role and text count as one space; a null
    conversation id is a conversation; turns may repeat or be null (first). Rows deleted altogether leave no row; an empty table
    gives none. Other columns are not read.
    """
    names = dict(zip((conversation, turn, role, text), ("conv_id", "turn", "role", "text")))
    df = df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])
    stream = _prepared(df.select("conv_id").distinct(), df)
    kind = df.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, out in _replayed(batches):
            held += out
            size += sum(len(r[4]) for r in out)
            if size > 4 << 20 or len(held) > 10_000:
                yield record(held)
                held, size = [], 0
        yield record(held)

    id_type = stream.schema["conv_id"].dataType

    def record(rows: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        values = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["conv_id", "n", "turn", "role", "text", "edit"])

    return stream.mapInArrow(run, f"conv_id {kind}, n long, turn long, role string, text string, edit string")


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the contract's damage; nulls in role and text, and in the hashed key, are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("h")
    held = df.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), h).where("h <> 0")
    return held.select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", "".join(_STOPS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def audits(df: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after damage.

    Every conversation id of the table has one row, a null id too, also when the damage leaves it no turn. Repeated rows are
    duplicates of each other. See ``repair`` for nulls; an empty table has no rows.
    """
    held = df.select(*[F.col(f"`{c}`") for c in ("conv_id", "turn", "role", "text")])
    stream = _prepared(held.select("conv_id").distinct(), damage(held))
    id_type = stream.schema["conv_id"].dataType
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(id_type), *[pa.int64()] * 6, pa.string(), pa.string()]
        done: list[tuple] = []
        for ended, _ in _replayed(batches):
            if ended is not None:
                done.append(ended.summary())
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=names)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=names)

    longs = ", ".join(f"{c} long" for c in names[1:7])
    return stream.mapInArrow(run, f"conv_id {id_type.simpleString()}, {longs}, audit string, repaired_sha256 string")
