"""Registration of queries and the form in which their results are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bound import Bound
from .oracle import statement

QUERIES: dict[str, Callable[[Bound], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register ``fn(bound) -> DataFrame``; ``sql`` reads the named tables of ``oracle.py``."""

    def register(fn: Callable[[Bound], DataFrame]) -> Callable[[Bound], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = statement(sql)
        return fn

    return register


def presented(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text, whole numbers as bigint: forms both engines print alike."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: presented(fn(Bound(spark, folder)))

    return {name: bind(fn) for name, fn in QUERIES.items()}
