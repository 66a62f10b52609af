"""Scans over a table: filter, projection, order, limit, and small summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scan(
    table: DataFrame,
    where: str | Column | None = None,
    columns: Sequence[str] | None = None,
    order_by: str | Sequence[Column | str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Filter by SQL text, choose columns, order, limit.

    An order given as text is what may follow ORDER BY: ``"age DESC NULLS LAST, abs(id)"``.
    """
    rows = table if where is None else table.where(where)
    if order_by is not None:
        rows = _ordered(rows, order_by) if isinstance(order_by, str) else rows.orderBy(*order_by)
    if limit is not None:
        rows = rows.limit(limit)
    return rows if columns is None else rows.select(*columns)


def _ordered(rows: DataFrame, order_by: str) -> DataFrame:
    text = order_by.replace("{", "{{").replace("}", "}}")
    return rows.sparkSession.sql(f"SELECT * FROM {{rows}} ORDER BY {text}", rows=rows)


def newest(table: DataFrame, k: int, freshness: str, tie: Sequence[str]) -> DataFrame:
    """The ``k`` freshest rows; ``tie`` columns make the choice unique."""
    return table.orderBy(F.col(freshness).desc(), *tie).limit(k)


def column_ranges(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<column>_min`` and ``<column>_max``."""
    pairs = [
        edge(c).alias(f"{c}_{name}")
        for c in columns
        for name, edge in (("min", F.min), ("max", F.max))
    ]
    return table.agg(*pairs)


def value_counts(table: DataFrame, column: str) -> DataFrame:
    """Rows per value, newest value first."""
    counted = table.groupBy(column).agg(F.count(F.lit(1)).alias("records"))
    return counted.orderBy(F.col(column).desc())


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, counted over pre-aggregated values."""
    return table.groupBy(column).agg(F.lit(1).alias("one")).agg(
        F.count(F.col(column)).alias("distinct_values")
    )


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("record_count"))
