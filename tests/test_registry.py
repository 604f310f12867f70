"""Registered queries against their SQL, on the smallest tables.

By default every query, but two of each of the families that run streams, models or versioned writes; ``VENDAVAL_ALL=1`` runs
these as well, as does ``tools/verify.py``.
"""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__
from tools.verify import TABLES, rows_of
from vendaval.checks import callables as queries
from vendaval.checks import oracles as oracle_sql

SMALL = "/root/testdata/sf0.001"


#: Families whose queries start streams, train models or write tables one after the other.
SLOW = ("IO", "W", "TM", "ML", "TX")


def chosen(names):
    """All names, but only the first two of each slow family."""
    if os.environ.get("VENDAVAL_ALL"):
        return sorted(names)
    families: dict[str, list[str]] = {}
    for name in sorted(names):
        families.setdefault(re.match("[A-Z]+", name).group(), []).append(name)
    return [n for family, members in families.items() for n in members[: 2 if family in SLOW else None]]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", chosen(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SMALL)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    assert not [k for k in kinds if k.startswith(("DECIMAL", "DATE", "TIMESTAMP", "HUGEINT"))]
    got, expected = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    assert got[1] == expected[1]
    assert got[0] == expected[0]


@pytest.mark.parametrize("name", chosen(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_every_query_is_registered_once_and_named_by_its_operator():
    names = list(queries())
    assert len(names) == len(set(names)) and set(oracle_sql()) <= set(names)
    assert set(names) <= set(__spark_entry__.queries()) and set(oracle_sql()) <= set(__spark_entry__.oracle_sql())
    assert all(re.match("(IO|PF|J|A|WF|SL|ST|SF|W|TM|DQ|GV|B|SV|GD|GF|RP|US|ML|TX)[0-9]+_", n) for n in names)


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
