"""Slices and dices. Each is a plain filter that Catalyst can push to the scan."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_year(df: DataFrame, year: int, column: str = "OrderDate") -> DataFrame:
    """Rows of one calendar year, as a date range: ``year(column) = y`` would not be pushed down."""
    return df.filter((F.col(column) >= F.lit(date(year, 1, 1))) & (F.col(column) < F.lit(date(year + 1, 1, 1))))


def weekend(df: DataFrame, column: str = "OrderDate") -> DataFrame:
    """Rows dated on a Sunday (1) or a Saturday (7)."""
    return df.filter(F.dayofweek(column).isin(1, 7))


def slice_(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Fix one dimension attribute."""
    return df.filter(F.col(column) == F.lit(value))


def dice(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Fix several dimension attributes at once."""
    for column, value in values.items():
        df = slice_(df, column, value)
    return df
