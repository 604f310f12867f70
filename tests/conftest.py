from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vendaval.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("id string, n int", ("a", 1), ...)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows_of():
    """Rows as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect


@pytest.fixture
def at():
    return lambda text: datetime.fromisoformat(text)
