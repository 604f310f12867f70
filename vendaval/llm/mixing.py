"""Interleaving sources to target weights by Pfair scheduling.

A source's documents are cut into blocks of about equal words. In a period of PERIOD slots a source with a of the PERIOD
shares owns block j from slot floor(j * PERIOD / a) (its release) to ceil((j + 1) * PERIOD / a) (its deadline); earliest
deadline first among released blocks fills every slot in time, so that no source is ever a whole block off its share.
All sources are even again at the end of a period: one period, made once, places any number of blocks. When a source runs
out, a new phase begins with the others' weights scaled up. The plan is small; documents meet it in one broadcast join.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import SEPARATORS, spare_names, without

#: Slots of a period: weights are rounded to whole shares of it, at least one share each.
PERIOD = 1000
#: Words in a block.
BLOCK_WORDS = 20_000
#: Without target weights, a source weighs its words to this power.
ROOT = 0.5
#: More sources are an error: the plan holds at most MAX_SOURCES phases of max(PERIOD, 2 * sources) slots.
MAX_SOURCES = 1000
#: Rows of a source whose running words one task adds up.
BUCKET_ROWS = 5_000


def shares(weights: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Whole shares of the period by largest remainder, each at least 1; all equal if no weight is above 0."""
    total = sum(weights.values())
    exact = {s: (w / total if total > 0 else 1 / len(weights)) * (period - len(weights)) for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is None, s or ""))[: period - sum(out.values())]:
        out[s] += 1
    return out


def one_period(owned: Mapping[str | None, int], period: int) -> dict[str | None, list[int]]:
    """Slots of each source's blocks in one period, earliest deadline first; ties go to the source that sorts first."""
    order = sorted(owned, key=lambda s: (s is None, s or ""))
    waiting = [(0, i, 0) for i in range(len(order))]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots: dict[str | None, list[int]] = {s: [] for s in order}
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // owned[order[i]]), i, j))
        _, i, j = heapq.heappop(ready)
        slots[order[i]].append(t)
        if j + 1 < owned[order[i]]:
            heapq.heappush(waiting, ((j + 1) * period // owned[order[i]], i, j + 1))
    return slots


@dataclass
class Stretch:
    """Blocks first..last of a source lie in one phase: block k of them in slot start + k // n * period + slots[k % n]."""

    source: str | None
    phase: int
    first: int
    last: int
    start: int
    period: int
    slots: list[int]


def plan(blocks: Mapping[str | None, int], weights: Mapping[str | None, float], period: int = PERIOD) -> list[Stretch]:
    """The whole schedule. Sources without a weight above 0 follow when all others have run out, evenly."""
    period = max(period, 2 * len(blocks))
    done, start, phase, out = dict.fromkeys(blocks, 0), 0, 0, []
    while active := {s for s in blocks if done[s] < blocks[s]}:
        weighted = {s: weights.get(s, 0) for s in active if weights.get(s, 0) > 0} or dict.fromkeys(active, 1.0)
        own = one_period(shares(weighted, period), period)
        ends = []
        for s, slots in own.items():
            rounds, k = divmod(blocks[s] - done[s] - 1, len(slots))
            ends.append(rounds * period + slots[k] + 1)
        end = min(ends)  # the phase ends with the slot in which the first source gets its last block
        for s, slots in own.items():
            rounds, rest = divmod(end, period)
            n = rounds * len(slots) + sum(t < rest for t in slots)
            if n:
                out.append(Stretch(s, phase, done[s], done[s] + n - 1, start, period, slots))
                done[s] += n
        start, phase = start + end, phase + 1
    return out


def with_blocks(df: DataFrame, source: str, key: str, text: str, block_words: int) -> DataFrame:
    """All columns, ``words`` of the text and ``block``, by the words before the row in its source's order. Columns of these
    names are replaced; other names are the caller's own.

    The order is that of a hash of key and text, so that null or repeated keys spread as others do. Its range is cut into equal buckets,
    whose totals are added up first, so that no task has more than about BUCKET_ROWS different rows of a source, however large that is.
    """
    base = without(df, ("words", "block"))
    buckets = max(1, -(-base.count() // BUCKET_ROWS))
    h, bucket, run, of, part, total, before = spare_names(base, "h_", "bucket_", "run_", "of_", "part_", "total_", "before_")
    text_of = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hashed = F.pmod(F.shiftright(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), 20), F.lit(1 << 44))
    counted = base.withColumn("words", F.size(F.array_remove(F.split(text_of, f"[{SEPARATORS}]+"), "")).cast("long")).withColumn(h, hashed)
    counted = counted.withColumn(bucket, F.floor(F.col(h) * buckets / (1 << 44)))  # the order agrees with the buckets
    totals = counted.groupBy(F.col(f"`{source}`").alias(of), F.col(bucket).alias(part)).agg(F.sum("words").alias(total))
    earlier = Window.partitionBy(of).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(of, part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before))
    inner = Window.partitionBy(f"`{source}`", bucket).orderBy(h, f"`{key}`", "words").rowsBetween(Window.unboundedPreceding, -1)
    summed = counted.withColumn(run, F.coalesce(F.sum("words").over(inner), F.lit(0)))
    joined = summed.join(offsets, F.col(f"`{source}`").eqNullSafe(F.col(of)) & (F.col(bucket) == F.col(part)))
    block = F.floor((F.col(before) + F.col(run)) / block_words).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in base.columns], "words", block.alias("block"))


def mix(
    df: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    block_words: int = BLOCK_WORDS,
    period: int = PERIOD,
) -> DataFrame:
    """All rows and columns, ``words``, ``block`` (in its source), ``phase`` and ``slot``; rows in order of slot are the mix.

    Columns of these names are replaced. A null source is a source of its own, null and empty texts have no words, null
    keys and repeated rows stay. A document longer than a block makes its source skip the slots of the words it holds.
    Without weights a source weighs the ROOT power of its words. Runs two jobs that bring one row a source to the driver.
    """
    base = without(df, ("words", "block", "phase", "slot"))
    blocked = with_blocks(base, source, key, text, block_words)
    found = blocked.groupBy(F.col(f"`{source}`").alias("s")).agg(F.max("block").alias("last"), F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them before mixing")
    weights = {r.s: float(max(r.words, 1)) ** ROOT for r in found} if weights is None else weights
    rows = [(p.source, p.phase, p.first, p.last, p.start, p.period, p.slots) for p in plan({r.s: r.last + 1 for r in found}, weights, period)]
    of, first, last, start, length, slots = spare_names(blocked, "of_", "first_", "last_", "start_", "period_", "slots_")
    schedule = df.sparkSession.createDataFrame(
        rows, f"{of} string, phase int, {first} bigint, {last} bigint, {start} bigint, {length} bigint, {slots} array<int>"
    )
    k = F.col("block") - F.col(first)
    n = F.size(slots)
    placed = blocked.join(
        F.broadcast(schedule),  # at most sources * phases rows, see MAX_SOURCES
        F.col(f"`{source}`").cast("string").eqNullSafe(F.col(of)) & F.col("block").between(F.col(first), F.col(last)),
    )
    slot = F.col(start) + F.floor(k / n) * F.col(length) + F.get(slots, k % n)
    return placed.select(*[F.col(f"`{c}`") for c in base.columns], "words", "block", "phase", slot.cast("long").alias("slot"))


def in_order(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``mix`` sorted by slot over all partitions: written, the files hold the mix in their order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "slot", F.xxhash64(f"`{key}`")).sortWithinPartitions("slot", F.xxhash64(f"`{key}`"))


def schedule_of(df: DataFrame) -> DataFrame:
    """doc_id, source, words, block, phase, slot of every document."""
    return mix(df.select("doc_id", "source", "text")).select("doc_id", "source", "words", "block", "phase", "slot")
