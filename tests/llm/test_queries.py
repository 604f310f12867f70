"""The registered queries of the training-data operators."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__
from tools.verify import TABLES, rows_of
from vendaval.llm import queries

from .helpers import SMALL


def test_one_query_for_each_operator_and_the_pipeline():
    names = set(__spark_entry__.queries())
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op([0-9]+)_", n))) == list(range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df, result = queries.QUERIES[name](spark, SMALL), con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
