"""URL verdicts: host and path rules first, then a weighted vocabulary found by one Aho-Corasick pass.

A strict term rejects by itself, soft terms only when several different ones occur. A term counts where no ASCII letter or
digit touches it.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import without

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
STRICT = ("casino", "hentai", "jackpot", "porn", "porno", "sportsbook", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "betting", "cam", "cheap", "dating", "escort", "free-download", "gambling", "nude", "pills", "poker", "sex", "slots")
#: So many different soft terms reject.
SOFT_LIMIT = 2
_ALNUM = frozenset(ascii_lowercase + "0123456789")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. Of equally long rules the first one wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def automaton(strict=STRICT, soft=SOFT) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for terms, hard in ((soft, False), (strict, True)):
        for term in terms:
            found.add_word(term.lower(), (term.lower(), hard))
    if len(found):
        found.make_automaton()
    return found


def hits(words: ahocorasick.Automaton, text: str) -> tuple[set[str], set[str]]:
    """Different strict and soft terms in a lower-cased text, with free ends."""
    strict, soft = set(), set()
    for end, (term, hard) in words.iter(text) if len(words) else ():
        start = end - len(term)
        if (start < 0 or text[start] not in _ALNUM) and (end + 1 == len(text) or text[end + 1] not in _ALNUM):
            (strict if hard else soft).add(term)
    return strict, soft


def vocabulary_hits(df: DataFrame, url: str = "url", strict=STRICT, soft=SOFT) -> DataFrame:
    """All columns, ``n_strict`` and ``n_soft``: different terms in the whole url. A null url has none. No shuffle."""
    base = without(df, ("n_strict", "n_soft"))
    kept = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton(strict, soft)
        low = str.maketrans(ascii_uppercase, ascii_lowercase)
        for batch in batches:
            got = [hits(words, (u or "").translate(low)) for u in batch.column(url).to_pylist()]
            counts = [pa.array([len(g[k]) for g in got], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[*kept, "n_strict", "n_soft"])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("n_strict", T.LongType()), T.StructField("n_soft", T.LongType())]))


def judge(df: DataFrame, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """All columns, host, path, rule, n_strict, n_soft, verdict (``allow`` or ``block``). Columns of these names are replaced.

    A fitting rule decides; else one strict or ``soft_limit`` different soft terms block. A null url or one without ``://``
    has an empty host and path and no rule; its vocabulary counts all the same. Repeated rows are judged one by one.
    """
    added = ("host", "path", "rule", "n_strict", "n_soft", "verdict")
    if url in added:
        raise ValueError(f"the url column cannot be named {url}")
    base = without(df, added)
    counted = vocabulary_hits(base, url, strict, soft).withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit), F.lit("block")).otherwise(F.lit("allow"))
    return counted.select(*[F.col(f"`{c}`") for c in base.columns], "host", "path", rule.alias("rule"), "n_strict", "n_soft", F.coalesce(said, method).alias("verdict"))


def verdicts(df: DataFrame) -> DataFrame:
    return judge(df.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


def _sql() -> str:
    low = f"translate(coalesce(url, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
    count = lambda terms: " + ".join(f"(CASE WHEN regexp_matches(l, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN 1 ELSE 0 END)" for t in terms)
    order = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    case = lambda what: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h + p if what else said}'" for said, h, p in order) + " END"
    return f"""
WITH u AS (
  SELECT page_id, {low} AS l,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{ascii_uppercase}', '{ascii_lowercase}') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), n AS (
  SELECT *, {case(1)} AS rule, {case(0)} AS said, {count(STRICT)} AS n_strict, {count(SOFT)} AS n_soft FROM u
)
SELECT page_id, host, path, rule, n_strict, n_soft,
       coalesce(said, CASE WHEN n_strict > 0 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM n
"""


SQL = _sql()
