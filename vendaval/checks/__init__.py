"""Registered queries: each operator bound to the test tables, with the SQL that must give the same rows."""

from __future__ import annotations


def _load():
    from . import (  # noqa: F401
        aggregates,
        joins,
        models,
        quality,
        registry,
        reports,
        rows,
        scalars,
        streams,
        tables,
        versions,
    )

    return registry


def callables():
    return _load().callables()


def oracles():
    return dict(_load().ORACLES)
