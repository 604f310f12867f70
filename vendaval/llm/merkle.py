"""Merkle manifest of a dataset, with proofs by pointer jumping.

1. A document is a leaf, the digest of its fields. The leaves of a language, in the order of their ids, are numbered by a range
   sort; runs of FAN consecutive nodes are hashed level by level until one node, the subroot, is left. The subroots, in the order
   of their languages, are hashed in the same way into the root.
2. Each inner node starts with its siblings as a proof segment and a pointer to its parent. A round joins the nodes with
   themselves: a node takes over its ancestor's pointer and appends its ancestor's segment. Distances double every round, so
   that after the logarithm of the height each node holds its whole path. Leaves share what lies above their run, hence only
   inner nodes (an eighth of the leaves) carry segments through the rounds.
3. A leaf's proof is its own siblings and its run's path. Folding a leaf through it gives the root, or shows that it changed.

Everything is DataFrame work; digests travel as 32 bytes and are hashed as lowercase hex text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import positions

#: Nodes hashed into one.
FAN = 8
#: The tree above the subroots. Trees of groups are ``NULL_GROUP`` or start with ``=``; both sort as their groups do.
TOP, NULL_GROUP = "^", ""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(parts: Sequence[Column]) -> Column:
    """SHA-256 of the parts end to end, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def fold(leaf: Column, path: Column) -> Column:
    """The digest that a leaf gives with a path of (before, after) siblings."""
    return F.aggregate(
        path, leaf, lambda at, s: F.unhex(F.sha2(F.concat(hexed(s["before"]), hexed(at), hexed(s["after"])).cast("binary"), 256))
    )


def path_digest(path: Column) -> Column:
    """SHA-256 in hex of all siblings of a path in their order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), "").cast("binary"), 256)


def _runs(level: DataFrame, *carried: str) -> DataFrame:
    """tree, up (the run's number), n, members (position, digest and ``carried`` of the run's nodes, in order)."""
    member = F.struct("position", "digest", *carried)
    return level.groupBy("tree", F.expr(f"position div {FAN}").alias("up")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members")  # FAN members at most
    )


def _parents(runs: DataFrame) -> DataFrame:
    joined = F.array_join(F.transform("members", lambda m: hexed(m["digest"])), "")
    return runs.select("tree", F.col("up").alias("position"), digest([joined]).alias("digest"), F.ceil(F.col("n") / FAN).alias("n"))


def _siblings(members: Column, i: Column) -> Column:
    """(before, after): the digests of the run's other members, end to end."""
    ends = lambda part: F.aggregate(part, F.lit(b""), lambda a, m: F.concat(a, m["digest"]))
    return F.struct(ends(F.slice(members, F.lit(1), i)).alias("before"), ends(F.slice(members, i + 2, F.lit(FAN))).alias("after"))


def _steps(runs: DataFrame, height: int) -> DataFrame:
    """tree, height, position, to_tree, to_height, to_position, path: every node of the runs with its way to its parent."""
    each = runs.select("tree", "up", "members", F.posexplode("members").alias("i", "node"))
    return each.select(
        "tree",
        F.lit(height).alias("height"),
        F.col("node.position").alias("position"),
        F.col("tree").alias("to_tree"),
        F.lit(height + 1).alias("to_height"),
        F.col("up").alias("to_position"),
        F.array(_siblings(F.col("members"), F.col("i"))).alias("path"),
    )


def _climb(level: DataFrame, height: int, label: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Hashes levels until each tree has one node. Returns the steps of all nodes and the top nodes (tree, height, position,
    digest)."""
    steps, tops = [], []
    while True:
        tops.append(level.where("n = 1").select("tree", F.lit(height).alias("height"), "position", "digest"))
        level = level.where("n > 1")
        if level.isEmpty():
            return steps, tops
        runs = cut_lineage(_runs(level), label)
        steps.append(_steps(runs, height))
        level, height = cut_lineage(_parents(runs), label), height + 1


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def jump(steps: DataFrame) -> DataFrame:
    """Pointer jumping: the same nodes with paths up to the root. Runs a job a round, each written to the shared folder."""
    node, to = ["tree", "height", "position"], ["to_tree", "to_height", "to_position"]
    nodes = cut_lineage(steps, "paths")
    while True:
        ahead = nodes.select(
            *[F.col(a).alias(b) for a, b in zip(node, to)],
            *[F.col(a).alias(f"next_{a}") for a in to],
            F.col("path").alias("rest"),
        )
        # Nodes that stand at the root find nobody ahead; they are set apart, so that they are not one hot key of the join.
        moved = nodes.where("to_tree IS NOT NULL").join(ahead, to, "left")
        moved = moved.select(
            *node,
            *[F.col(f"next_{a}").alias(a) for a in to],
            F.concat("path", F.coalesce("rest", F.array().cast("array<struct<before:binary,after:binary>>"))).alias("path"),
        )
        nodes = cut_lineage(moved.unionByName(nodes.where("to_tree IS NULL").select(*moved.columns)), "paths")
        if nodes.where("to_tree IS NOT NULL").isEmpty():
            return nodes


def manifest(leaves: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()) -> tuple[DataFrame, str | None]:
    """(rows, root): every row of ``leaves`` with its subroot and its proof, and the root in hex (None without leaves).

    ``leaves`` are written rows with ``tree`` (see ``tree_of``), ``digest`` (32 bytes), the columns ``keys`` by which the leaves of
    a tree are ordered, the last of them different for every row, and ``carried`` columns, which come back. Added are
    ``subroot`` (32 bytes) and ``path`` (array of before, after: siblings from the leaf to the root). The root is one value
    at the driver; nothing else is.
    """
    carried = list(dict.fromkeys(["digest", *carried]))
    placed = positions(leaves, "tree", keys, "leaves")
    sizes = cut_lineage(placed.groupBy("tree").agg(F.count("*").alias("n")), "sizes")
    own = [c for c in carried if c != "digest"]
    runs = cut_lineage(_runs(placed.join(sizes, "tree").select("tree", "position", "n", *carried), *own), "runs")
    # A tree of one leaf has no run: its leaf is the subroot and stands where other trees' inner nodes do.
    lone = runs.where("n = 1").select("tree", F.lit(0).alias("height"), F.lit(0).cast("long").alias("position"), F.col("members")[0]["digest"].alias("digest"))
    inner, tops = _climb(cut_lineage(_parents(runs.where("n > 1")), "level"), 1, "level")
    subroots = cut_lineage(_union([lone, *tops]), "subroots")

    ranked = positions(subroots.withColumnRenamed("position", "at").withColumn("all", F.lit("")), "all", ["tree"], "ranked")
    many = subroots.count()
    if not many:
        return placed.select(*carried, F.lit(None).cast("binary").alias("subroot"), F.lit(None).cast("array<struct<before:binary,after:binary>>").alias("path")), None
    top = cut_lineage(ranked.select(F.lit(TOP).alias("tree"), "position", "digest", F.lit(many).cast("long").alias("n")), "top")
    above, roots = _climb(top, 0, "top")
    root = _union(roots).first()["digest"]
    # The nodes of the top tree's lowest level are the subroots: each is known by its place in its own tree.
    link = ranked.select(F.col("position").alias("rank"), F.col("tree").alias("own_tree"), F.col("height").alias("own_height"), F.col("at").alias("own_position"))
    if above:
        lowest = above[0].join(link, F.col("position") == F.col("rank")).select(
            F.col("own_tree").alias("tree"), F.col("own_height").alias("height"), F.col("own_position").alias("position"), "to_tree", "to_height", "to_position", "path"
        )
        above = [lowest, *above[1:]]
    # Both kinds of top nodes point nowhere; a node without a step ahead of it ends there.
    steps = [*inner, *above]
    paths = jump(_union(steps)) if steps else None

    each = runs.select(
        "tree",
        F.when(F.col("n") == 1, 0).otherwise(1).alias("height"),
        F.when(F.col("n") == 1, F.lit(0)).otherwise(F.col("up")).alias("position"),
        "n",
        "members",
    ).join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    if paths is not None:
        each = each.join(paths.select("tree", "height", "position", "path"), ["tree", "height", "position"], "left")
        rest = F.coalesce("path", F.array().cast("array<struct<before:binary,after:binary>>"))
    else:
        rest = F.array().cast("array<struct<before:binary,after:binary>>")
    each = each.select("n", "members", "subroot", rest.alias("rest")).select("n", "members", "subroot", "rest", F.posexplode("members").alias("i", "node"))
    first = F.when(F.col("n") == 1, F.array().cast("array<struct<before:binary,after:binary>>")).otherwise(F.array(_siblings(F.col("members"), F.col("i"))))
    return each.select(*[F.col(f"node.{c}").alias(c) for c in carried], "subroot", F.concat(first, "rest").alias("path")), root.hex()


def tree_of(group: Column) -> Column:
    """The name of a group's tree: null first, then bytewise by the group's text."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(NULL_GROUP))


def tampered(doc_id: Column) -> Column:
    """Rows whose text the contract tampers with: 3 divides the crc32 of the decimal id. A null id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def proofs(df: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of documents.

    Every row is a leaf: repeated rows are leaves of their own side by side, rows that share an id are ordered by their leaf,
    null ids come first and are not tampered with. Nulls and empty texts hash differently. Extra columns are not part of a
    leaf. An empty table has no rows. Runs several jobs and writes to the shared folder; texts are read once.
    """
    held = {c: F.col(f"`{c}`") for c in FIELDS}
    changed = held | {"text": ascii_lower(held["text"])}
    hit = tampered(held["doc_id"])
    leaves = cut_lineage(
        df.select(
            held["doc_id"].alias("doc_id"),
            tree_of(held["lang"]).alias("tree"),
            digest([field(c) for c in held.values()]).alias("digest"),
            F.when(hit, digest([field(c) for c in changed.values()])).alias("forged"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    rows, root = manifest(leaves, ["doc_id", "digest", "row"], ["doc_id", "forged"])
    folded = hexed(fold(F.coalesce("forged", "digest"), F.col("path")))
    return rows.select(
        "doc_id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        path_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same rows over the test tables.
SQL = """
WITH RECURSIVE d AS (
  SELECT *, coalesce('=' || lang, '') AS tree,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS forged_body,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda e, k: xor(e >> 1, (e & 1) * 3988292384::BIGINT)))) % 3 = 0 AS hit
  FROM documents
), leaf AS (
  SELECT doc_id, tree, sha256(head || body) AS h, CASE WHEN hit THEN sha256(head || forged_body) ELSE sha256(head || body) END AS f,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM d
), lv AS (
  SELECT tree, 0 AS height, pos, h, n FROM leaf
  UNION ALL
  SELECT tree, height + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM lv WHERE n > 1 GROUP BY tree, height, pos // 8
), sub AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM lv WHERE n = 1
), top AS (
  SELECT 0 AS height, rank AS pos, h, n FROM sub
  UNION ALL
  SELECT height + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM top WHERE n > 1 GROUP BY height, pos // 8
), node AS (
  SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT * FROM lv UNION ALL SELECT '^', height, pos, h, n FROM top) AS nodes WHERE n > 1
  WINDOW w AS (PARTITION BY tree, height, pos // 8 ORDER BY pos)
), walk AS (
  SELECT doc_id, pos AS leaf_pos, tree AS own, h AS leaf, tree, 0 AS height, pos, f AS folded, '' AS proof FROM leaf
  UNION ALL
  SELECT w.doc_id, w.leaf_pos, w.own, w.leaf,
    CASE WHEN node.tree IS NULL THEN '^' ELSE w.tree END, CASE WHEN node.tree IS NULL THEN 0 ELSE w.height + 1 END,
    CASE WHEN node.tree IS NULL THEN sub.rank ELSE w.pos // 8 END,
    CASE WHEN node.tree IS NULL THEN w.folded ELSE sha256(node.before || w.folded || node.after) END,
    CASE WHEN node.tree IS NULL THEN w.proof ELSE w.proof || node.before || node.after END
  FROM walk AS w JOIN sub ON sub.tree = w.own LEFT JOIN node ON node.tree = w.tree AND node.height = w.height AND node.pos = w.pos
  WHERE node.tree IS NOT NULL OR w.tree <> '^'
), last AS (
  SELECT * FROM walk WHERE tree = '^' QUALIFY row_number() OVER (PARTITION BY own, leaf_pos ORDER BY height DESC) = 1
)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM last JOIN sub ON sub.tree = last.own CROSS JOIN (SELECT h FROM top WHERE n = 1) AS root
"""
