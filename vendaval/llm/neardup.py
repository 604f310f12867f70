"""Near-duplicate groups of documents by an LSH forest of min-hash signatures.

1. A task turns whole texts into sets of hashed word shingles; a document keeps its set's size, fingerprint and signature.
   Documents with equal sets form one class, however many copies there are.
2. Each tree of the forest is the classes in the order of the signature rotated to another start. Neighbours in that order
   that share at least MIN_DEPTH leading values are candidates. Where a region is thin, the neighbours within reach are the
   whole region; where it is dense, the reach ends at deeper common prefixes. The order is a range sort that ends with the
   class id, so a dense region spreads over tasks; boundary rows meet their successors in groups of bounded size.
3. Candidates whose signatures agree enough are confirmed on the full sets, the best few of each class first. Pairs whose
   ends are already in one component need no confirmation; all others get it.
4. A region wider than the reach that still has several components is compared whole, component against component on the
   full sets: its rows are dealt into blocks of bounded size, and each pair of blocks is one task's group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import byte_texts, slices
from .components import components

#: Values in a signature, and trees; each tree starts WIDTH / TREES values later.
WIDTH, TREES = 64, 16
#: A candidate shares at least so many leading values in one tree. At similarity 0.8 all trees miss a pair in 1 of 90,000.
MIN_DEPTH = 3
#: Neighbours looked at on either side in one tree. Regions with fewer rows are compared whole at once, wider ones by blocks.
REACH = 8
#: Rows and shingles of a block of a wide region; columns of a matrix of two blocks' shingles.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 256, 1 << 21, 8192
#: Signatures may agree this much less than the threshold (over 4 standard deviations of the estimate).
SLACK = 0.22
#: Most and least rows of a tree in one task, on average; the least is far above 2 * REACH, so that a reach ends in the next task.
TREE_ROWS, LEAST_ROWS = 250_000, 1000
#: Candidates of a class that are confirmed in each round; the last round takes all that are left.
ROUNDS = (3, 24, None)
REMEMBERED = 300_000

_ODD = np.random.default_rng(7).integers(1, 2**63, 64, dtype="u8") | np.uint64(1)
_ADD = np.random.default_rng(8).integers(0, 2**63, 64, dtype="u8")


class WordHashes(dict):
    """Word -> 64-bit hash, computed once a process."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], size: int, memory: WordHashes) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of each text, A-Z lower-cased.

    A text with fewer words is one shingle; one without words has none.
    """
    if len(memory) > REMEMBERED:
        memory.clear()
    out = []
    for text in texts:
        words = text.lower().split() if text else ()
        h = np.fromiter(map(memory.__getitem__, words), "u8", len(words))
        n = min(size, len(h))
        if not n:
            out.append(h)
            continue
        total = np.full(len(h) - n + 1, n, "u8")
        for k in range(n):
            total += h[k : len(h) - n + 1 + k] * _ODD[k]
        out.append(np.unique(_mixed(total)))
    return out


def signatures(sets: list[np.ndarray]) -> list[bytes | None]:
    """WIDTH min-hash values of 16 bits of each set, big-endian so that bytes sort like values; None of an empty set."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return [None] * len(sets)
    flat, starts = np.concatenate(filled), np.cumsum([0, *(len(s) for s in filled[:-1])])
    low = np.empty((len(filled), WIDTH), ">u2")
    for k in range(WIDTH):
        least = np.minimum.reduceat(flat * _ODD[k % 64] + _ADD[k % 64], starts)
        low[:, k] = (_mixed(least) >> np.uint64(48)).astype("u2")
    rows = iter(low)
    return [next(rows).tobytes() if len(s) else None for s in sets]


def _marks(docs: DataFrame, size: int) -> DataFrame:
    """id, n_shingles, print (of the set), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in slices(batches, "text", 4 << 20):
            sets = shingle_sets(byte_texts(batch, "text"), size, memory)
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures(sets), pa.binary())],
                names=["id", "n_shingles", "print", "signature"],
            )

    return docs.mapInArrow(run, "id long, n_shingles long, print binary, signature binary")


def neighbours(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smaller id, larger id, agreeing values) of candidate pairs among rows in (tree, key) order. keys: (rows, WIDTH)."""
    found = []
    if len(ids) > 1:
        alike = keys[:-1] == keys[1:]
        depth = np.where(alike.all(1), WIDTH, alike.argmin(1))
        depth[tree[:-1] != tree[1:]] = 0
        common = depth
        for step in range(1, min(REACH, len(ids) - 1) + 1):
            if step > 1:
                common = np.minimum(common[:-1], depth[step - 1 :])
            i = np.flatnonzero(common >= MIN_DEPTH)
            if not len(i):
                break
            agree = (keys[i] == keys[i + step]).sum(1)
            a, b = sizes[i], sizes[i + step]
            good = (agree >= WIDTH * (threshold / 100 - SLACK)) & (100 * np.minimum(a, b) >= threshold * np.maximum(a, b))
            i = i[good]
            found.append((np.minimum(ids[i], ids[i + step]), np.maximum(ids[i], ids[i + step]), agree[good]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, "i8"),) * 3


def _key_matrix(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "u2").reshape(len(keys), WIDTH)


def _trees(classes: DataFrame) -> DataFrame:
    """tree, key (the rotated signature), id, n_shingles: each of ``classes`` once in every tree."""
    shift = 2 * WIDTH // TREES
    return classes.select("id", "n_shingles", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.expr(f"concat(substring(signature, tree * {shift} + 1), substring(signature, 1, tree * {shift}))").alias("key"), "id", "n_shingles"
    )


def candidates(classes: DataFrame, threshold: int) -> DataFrame:
    """a, b, agree: distinct candidate pairs of ``classes`` (id, n_shingles, signature) within the reach."""
    rows = classes.count() * TREES
    usual = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-rows // TREE_ROWS), min(usual, rows // LEAST_ROWS))
    ordered = _trees(classes).repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs within the task; and its first and last rows, under the number of the boundary that they touch."""
        part, held, first = TaskContext.get().partitionId(), None, True
        kinds = ["id", "n_shingles", "tree", "key"]

        def out(pairs=((), (), ()), edge=None, boundary=0):
            n, m = len(pairs[0]), 0 if edge is None else edge.num_rows
            blank = lambda kind: pa.nulls(n, kind)
            columns = [pa.concat_arrays([pa.array(p, pa.int64()), pa.nulls(m, pa.int64())]) for p in pairs]
            columns.append(pa.concat_arrays([blank(pa.int32()), pa.array(np.full(m, boundary), pa.int32())]))
            for name, kind in zip(kinds, (pa.int64(), pa.int64(), pa.int32(), pa.binary())):
                columns.append(pa.concat_arrays([blank(kind), *([edge.column(name).cast(kind)] if m else [])]))
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "agree", "boundary", *kinds])

        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                yield out(edge=batch.slice(0, REACH), boundary=part)
                first = False
            # Rows of the last batch that the next one's rows may reach are carried over; their pairs among themselves repeat.
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            values = [whole.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "id", "n_shingles")]
            yield out(neighbours(values[0], _key_matrix(whole.column("key").to_pylist()), values[1], values[2], threshold))
            held = whole.slice(max(0, whole.num_rows - REACH))
        if held is not None:
            yield out(edge=held, boundary=part + 1)

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tree", "key", "id"]).drop_duplicates(["tree", "id"])
        found = neighbours(rows["tree"].to_numpy(), _key_matrix(rows["key"].tolist()), rows["id"].to_numpy(), rows["n_shingles"].to_numpy(), threshold)
        return pd.DataFrame(dict(zip(("a", "b", "agree"), found)))

    walked = cut_lineage(
        ordered.mapInArrow(walk, "a long, b long, agree long, boundary int, id long, n_shingles long, tree int, key binary"), "walked"
    )
    edges = walked.where("boundary IS NOT NULL").select("boundary", "id", "n_shingles", "tree", "key")
    across = edges.groupBy("boundary").applyInPandas(join, "a long, b long, agree long")  # at most 2 * REACH rows a group
    pairs = walked.where("boundary IS NULL").select("a", "b", "agree").union(across)
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """id, members (sorted hashes) of the wanted (id, least, print): a row of each class, the one with its least key, is
    read again and its full set made again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in slices(batches, "text", 4 << 20):
            sets = [s.tobytes() for s in shingle_sets(byte_texts(batch, "text"), size, memory)]
            same = [i for i, (s, p) in enumerate(zip(sets, batch.column("print").to_pylist())) if xxhash.xxh3_128_digest(s) == p]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(same, pa.int64())), pa.array([sets[i] for i in same], pa.binary())], names=["id", "members"])

    rows = docs.select(F.col("id").alias("least"), "text").join(wanted, "least").select("id", "text", "print")
    return rows.mapInArrow(run, "id long, members binary").dropDuplicates(["id"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a, b, linked: 100 * |intersection| >= threshold * |union| on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                shared = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _round(open_pairs: DataFrame, most: int | None) -> DataFrame:
    """The ``most`` best pairs of each class that has any; all of them for None."""
    if most is None:
        return open_pairs.select("a", "b")
    ends = open_pairs.select("a", "b", "agree", F.col("a").alias("u")).union(open_pairs.select("a", "b", "agree", F.col("b").alias("u")))
    best = Window.partitionBy("u").orderBy(F.desc("agree"), "a", "b")
    return ends.withColumn("r", F.row_number().over(best)).where(F.col("r") <= most).select("a", "b").distinct()


def _wide_regions(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """region, block, whole, id, component: rows of the regions that are wider than the reach and have several components.

    A component that fills a block has blocks of its own (``whole`` is the component), all others share blocks.
    """
    rows = _trees(classes).select("tree", F.substring("key", 1, 2 * MIN_DEPTH).alias("start"), "id", "n_shingles")
    wide = rows.groupBy("tree", "start").count().where(F.col("count") > REACH + 1).select("tree", "start", F.xxhash64("tree", "start").alias("region"))
    inside = cut_lineage(
        rows.join(wide, ["tree", "start"]).join(labels, "id", "left").select("region", "id", "n_shingles", F.coalesce("component", "id").alias("component")),
        "inside",
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("volume") / BLOCK_SHINGLES))
    parts = inside.groupBy("region", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("volume")).withColumn("own", blocks)
    shared = (
        parts.groupBy("region")
        .agg(F.count("*").alias("many"), *[F.sum(F.when(F.col("own") == 1, F.col(c)).otherwise(0)).alias(c) for c in ("n", "volume")])
        .where("many > 1")
        .select("region", blocks.alias("pool"))
    )
    plan = parts.select("region", "component", "own").join(shared, "region")
    alone = F.col("own") > 1
    block = F.when(alone, F.xxhash64("component", F.pmod(F.xxhash64("id"), "own"))).otherwise(F.pmod(F.xxhash64("component"), "pool"))
    return inside.join(plan, ["region", "component"]).select("region", block.alias("block"), F.when(alone, F.col("component")).alias("whole"), "id", "component")


def linked_components(left: tuple, right: tuple | None, threshold: int) -> list[tuple[int, int]]:
    """Pairs of components that a link joins, enough of them to connect all that links connect.

    ``left`` and ``right`` are (components, sets) of two blocks; None for ``right`` compares a block with itself.
    """
    (own, sets), (other, others) = left, right or left
    lengths, widths = (np.fromiter(map(len, s), "i8", len(s)) for s in (sets, others))
    flat, flats = np.concatenate(sets), np.concatenate(others)
    if right is None:
        values, times = np.unique(flat, return_counts=True)
        common = values[times > 1]
    else:
        common = np.intersect1d(flat, flats)

    def entries(flat, lengths):
        at = np.searchsorted(common, flat)
        hit = at < len(common)
        hit[hit] = common[at[hit]] == flat[hit]
        column, row = at[hit], np.repeat(np.arange(len(lengths)), lengths)[hit]
        order = np.argsort(column, kind="stable")
        return column[order], row[order]

    (c, r), (d, q) = entries(flat, lengths), entries(flats, widths)
    shared = np.zeros((len(sets), len(others)))
    for s in range(0, len(common), COLUMNS):
        x, y = (np.zeros((n, min(COLUMNS, len(common) - s)), "f4") for n in shared.shape)
        for table, columns, rows in ((x, c, r), (y, d, q)):
            a, b = np.searchsorted(columns, (s, s + COLUMNS))
            table[rows[a:b], columns[a:b] - s] = 1
        shared += x @ y.T
    good = (100 * shared >= threshold * (lengths[:, None] + widths - shared)) & (own[:, None] != other)
    i, j = np.nonzero(good)
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    out = []
    for a, b in zip(own[i].tolist(), other[j].tolist()):
        u, v = find(a), find(b)
        if u != v:
            root[u] = v
            out.append((a, b))
    return out


def _across(placed: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a, b: components that links join, from all pairs of rows of ``placed`` with a region in common."""
    blocks = placed.select("region", "block", "whole").distinct()
    first = blocks.select("region", F.col("block").alias("x"), F.col("whole").alias("wx"))
    second = blocks.select("region", F.col("block").alias("y"), F.col("whole").alias("wy"))
    pairs = first.join(second, "region").where("x <= y AND coalesce(wx <> wy, true)").select("region", "x", "y", F.xxhash64("region", "x", "y").alias("pair"))
    sides = pairs.select("region", "pair", F.lit(0).alias("side"), F.col("x").alias("block")).union(
        pairs.where("x < y").select("region", "pair", F.lit(1).alias("side"), F.col("y").alias("block"))
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        halves = []
        for side in (0, 1):
            half = rows[rows["side"] == side]
            halves.append((half["component"].to_numpy(), [np.frombuffer(m, "u8") for m in half["members"]]) if len(half) else None)
        return pd.DataFrame(linked_components(*halves, threshold), columns=["a", "b"], dtype="int64")

    met = sides.join(placed.select("region", "block", "id", "component"), ["region", "block"]).select("pair", "side", "id", "component")
    return met.join(sets, "id").select("pair", "side", "component", "members").groupBy("pair").applyInPandas(compare, "a long, b long")


def near_duplicates(df: DataFrame, size: int = 5, threshold: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, kept for each row of ``df``; linked are sets with similarity of ``threshold`` % or more.

    component_id is the least key reachable over links, kept is key = component_id. A text without words has 0 shingles and
    is linked with nothing, as is a row whose key is null (component_id null, kept). Rows that repeat a key each get a row;
    a key with different texts is judged text by text. Runs several jobs and writes to the shared folder.
    """
    docs = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    marks = cut_lineage(_marks(docs, size), "marks")
    usable = F.col("id").isNotNull() & F.col("print").isNotNull()
    classes = cut_lineage(
        marks.where(usable)
        .groupBy("print")
        .agg(F.min("id").alias("least"), F.max("n_shingles").alias("n_shingles"), F.max("signature").alias("signature"))
        .withColumn("id", F.xxhash64("print")),  # a number of its own for each set; keys may repeat
        "classes",
    )
    pairs = cut_lineage(candidates(classes, threshold), "pairs")
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    full = lambda ids, name: cut_lineage(_sets(docs.where("id IS NOT NULL"), classes.join(ids, "id").select("id", "least", "print"), size), name)
    sets = full(ends, "sets")

    judged, labels, left = None, None, pairs
    for most in ROUNDS:
        if judged is not None:
            left = pairs.join(judged, ["a", "b"], "left_anti")
            for end in ("a", "b"):
                own = labels.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
                left = left.join(own, end, "left")
            left = cut_lineage(left.where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b", "agree"), "left")
            if left.isEmpty():
                break
        done = cut_lineage(_confirmed(_round(left, most), sets, threshold), "confirmed")
        judged = done if judged is None else judged.union(done)
        if labels is None or not done.where("linked").isEmpty():  # else the components are as they were
            labels = components(judged.where("linked"))

    joined, placed = None, cut_lineage(_wide_regions(classes, labels), "placed")
    if not placed.isEmpty():
        more = full(placed.select("id").distinct().join(sets, "id", "left_anti"), "more")
        found = cut_lineage(_across(placed, sets.union(more), threshold), "across")
        if not found.isEmpty():
            joined = components(found).select(F.col("id").alias("c"), F.col("component").alias("to"))

    named = classes.join(labels, "id", "left").select("print", "least", F.coalesce("component", "id").alias("c"))
    if joined is not None:
        named = named.join(joined, "c", "left").select("print", "least", F.coalesce("to", "c").alias("c"))
    named = named.join(named.groupBy("c").agg(F.min("least").alias("component_id")), "c").select("print", "component_id")
    return marks.join(named, "print", "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(usable, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        (F.col("id").isNull() | F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).alias("kept"),
    )


def deduplicate(df: DataFrame, size: int = 5, threshold: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` whose key is the least of its group, and rows without a key; all columns as they are.

    A key that repeats with several texts goes if one of them does.
    """
    gone = near_duplicates(df, size, threshold, key, text).where("NOT kept").select(F.col(key).alias("__gone"))
    return df.join(gone, df[key] == gone["__gone"], "left_anti")
