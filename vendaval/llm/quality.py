"""Quality rules as a ledger: every rule is evaluated once, its failure is one bit, and policies are masks over the bits.

Only DataFrame functions. ``ledger`` needs no shuffle; a change of policy reads the ledger, never the texts again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import SEPARATORS, spare_names, without

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

#: Rule -> bit. A bit never changes its meaning; a new threshold is a new rule.
RULES = {
    "few_words": 0,
    "repeated_words": 1,
    "symbols": 2,
    "repeated_lines": 3,
    "word_length": 4,
    "shouting": 5,
    "exclamations": 6,
}
#: Policy -> the rules it enforces. Policies are added, never changed.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations")


def _starts(pairs: Column) -> Column:
    """Starts, in order, of the windows whose hash stands twice or more in the sorted (hash, start) pairs."""
    same = lambda p, k: F.coalesce(p["h"] == F.get(pairs, k)["h"], F.lit(False))
    return F.sort_array(F.transform(F.filter(pairs, lambda p, k: same(p, k - 1) | same(p, k + 1)), lambda p: p["at"]))


def _covered(starts: Column) -> Column:
    """Words in the windows at these starts: each start covers min(5, distance to the one before) new ones."""
    return F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("total")),
        lambda a, s: F.struct(s.alias("last"), (a["total"] + F.least(F.lit(WINDOW).cast("long"), s - a["last"])).alias("total")),
        lambda a: a["total"],
    )


def measure(df: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """All columns and the struct ``into`` of MEASURES (long). A null text counts as empty: every measure is 0.

    Words are runs without the six ASCII separators; lines are split at line feeds, and a line counts if it has a word.
    Windows are compared by 64-bit hashes of their words; sorted, repeats are neighbours, and only texts that have a
    repeat sort. No shuffle; a whole text is one row's work.
    """
    base = without(df, (into,))
    columns = base.columns
    held, words_at, windows, lines, pairs, starts = spare_names(base, "text_", "words_", "windows_", "lines_", "pairs_", "starts_")
    base = base.withColumn(held, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    words = F.array_remove(F.split(F.col(held), f"[{SEPARATORS}]+"), "")
    base = base.withColumn(words_at, words)
    n = F.size(words_at)
    base = base.withColumn(
        windows,
        F.when(
            n >= WINDOW,
            F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col(words_at), i + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>")),
    ).withColumn(lines, F.filter(F.split(F.col(held), "\n"), lambda line: line.rlike(f"[^{SEPARATORS}]")))
    # Each step is a column of its own, read more than once, so that none is computed again inside a later lambda.
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    base = base.withColumn(
        pairs,
        F.when(repeated, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("at"))))),
    ).withColumn(starts, F.when(F.col(pairs).isNotNull(), _starts(F.col(pairs))))
    count = lambda pattern: F.regexp_count(F.col(held), F.lit(pattern)).cast("long")
    measured = base.select(
        *[F.col(f"`{c}`") for c in columns],
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words_at, "")).cast("long").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.when(F.col(starts).isNull(), F.lit(0).cast("long")).otherwise(_covered(F.col(starts))).alias("n_repeat_words"),
            count("[A-Z]").alias("n_capitals"),
            (F.length(held) - F.length(F.replace(F.col(held), F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
        ).alias(into),
    )
    # A row of one element: no filter is moved below it, where it would repeat every expression above in its condition.
    return measured.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.array(F.col(into))).alias(into))


def failures(measures: Column) -> Column:
    """Bits of the failed rules. Whole-number comparisons only, so that any engine finds the same bits."""
    m = {name: measures[name] for name in MEASURES}
    failed = {
        "few_words": m["n_words"] < 10,
        "repeated_words": 100 * m["n_repeat_words"] > 20 * m["n_words"],
        "symbols": 100 * m["n_symbols"] > 20 * m["n_words"],
        "repeated_lines": 100 * m["n_dup_lines"] > 50 * m["n_lines"],
        "word_length": (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
        "shouting": 100 * m["n_capitals"] > 30 * m["word_chars"],
        "exclamations": 100 * m["n_exclamations"] > 20 * m["n_words"],
    }
    bits = F.lit(0).cast("long")
    for rule, bit in RULES.items():
        bits = bits.bitwiseOR(F.when(failed[rule], F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(policy: str) -> int:
    """Bits of a policy; an unknown policy is an error."""
    return sum(1 << RULES[rule] for rule in POLICIES[policy])


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns, ``measures`` and ``failed`` (bits of every rule the row fails). Columns of these names are replaced.

    Null and empty texts fail ``few_words`` only. Repeated rows are judged one by one.
    """
    return measure(without(df, ("failed",)), text).withColumn("failed", failures(F.col("measures")))


def passes(failed: Column, policy: str) -> Column:
    return failed.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def keep(df: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """Rows that pass the policy, with the columns of ``df`` as they were (also ``measures`` or ``failed``, if it has them)."""
    (into,) = spare_names(df, "measures")
    judged = measure(df, text, into)
    return judged.where(passes(failures(F.col(into)), policy)).select(*[F.col(f"`{c}`") for c in df.columns])


def ablations(ledgers: DataFrame, policies: Mapping[str, int] | None = None) -> DataFrame:
    """policy, rule, n_rejected, n_by_rule, n_only_by_rule: what each policy rejects, and what it would keep without a rule.

    Rows are first reduced to counts of each bit pattern (at most 2^rules rows), so the cost is one small aggregation.
    Every rule of every policy has a row, also over an empty ledger.
    """
    spark, policies = ledgers.sparkSession, policies or {p: mask(p) for p in POLICIES}
    wanted = [(p, r, m, 1 << b) for p, m in policies.items() for r, b in RULES.items() if m >> b & 1]
    patterns = ledgers.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    sets = spark.createDataFrame(wanted, "policy string, rule string, mask bigint, bit bigint")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return (
        sets.join(F.broadcast(patterns), hit != 0, "left")  # patterns: at most 2^len(RULES) rows
        .groupBy("policy", "rule")
        .agg(
            total(hit != 0)("n_rejected"),
            total(hit.bitwiseAND(F.col("bit")) != 0)("n_by_rule"),
            total(hit == F.col("bit"))("n_only_by_rule"),
        )
    )


def digest(df: DataFrame, policy: str = "v1") -> DataFrame:
    """Per document the base measures, whether the base rules fail, and the policy's verdict."""
    rows = ledger(df.select("doc_id", "text")).select("doc_id", "measures.*", "failed")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        (~passes(F.col("failed"), "base")).alias("base_failed"),
        (passes(F.col("failed"), "base") & passes(F.col("failed"), policy)).alias("kept"),
    )


#: The same rows over the test tables.
SQL = """
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS ws,
         [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS ls
  FROM documents
), g AS (
  SELECT k, i, array_to_string(ws[i:i+4], ' ') AS five FROM (SELECT k, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM d)
), twice AS (
  SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, five) > 1
), r AS (
  SELECT k, count(DISTINCT i + o) AS n FROM twice, range(0, 5) AS x(o) GROUP BY k
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
         length(regexp_replace(t, '[^!]', '', 'g')) AS marks
  FROM d LEFT JOIN r USING (k)
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * capitals > 30 * word_chars THEN 32 ELSE 0 END) + (CASE WHEN 100 * marks > 20 * n_words THEN 64 ELSE 0 END) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""
