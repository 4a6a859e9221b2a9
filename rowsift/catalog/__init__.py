"""Named queries over the driver tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from rowsift.catalog import annotation, geometry, graph, learning, rows, tagging

    out: dict[str, Query] = {}
    for module in (rows, graph, annotation, geometry, tagging, learning):
        out.update(module.QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from rowsift.catalog import annotation, geometry, graph, learning, rows, tagging

    out: dict[str, str] = {}
    for module in (rows, graph, annotation, geometry, tagging, learning):
        out.update(module.ORACLE)
    return out
