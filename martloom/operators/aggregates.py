"""Grouped sales, subtotals and the quarter pivot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.measures import total, total_sales


def sales_by(df: DataFrame, keys: Sequence[str | Column], name: str = "TotalSales") -> DataFrame:
    """Total sales per combination of ``keys``."""
    return df.groupBy(*keys).agg(total_sales().alias(name))


def grouping_sets_sales(
    df: DataFrame,
    keys: Sequence[str],
    sets: Sequence[Sequence[str]],
    name: str = "TotalSales",
    level: str | None = None,
) -> DataFrame:
    """Total sales for each of the key ``sets``; absent keys are NULL.

    ``level`` adds ``grouping_id()``, which tells a subtotal from a NULL key.
    The facts are summed once at the finest level and only those sums are
    expanded into the sets.
    """
    finest = sales_by(df, list(keys), name)
    outputs = [total(F.col(name)).alias(name)]
    if level:
        outputs.insert(0, F.grouping_id().cast("bigint").alias(level))
    return finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(k) for k in keys]).agg(*outputs)


def rollup_sales(df: DataFrame, keys: Sequence[str], name: str = "TotalSales", level: str | None = None) -> DataFrame:
    """Sales for every leading part of ``keys``, down to the grand total."""
    return grouping_sets_sales(df, keys, [keys[:n] for n in range(len(keys), -1, -1)], name, level)


def quarter_totals(date: str, year_total: str = "TotalYearlySales") -> list[Column]:
    """Four conditional sums, zero for an empty quarter, and the total."""
    month = F.month(date)
    quarters = [total_sales(month.between(3 * q - 2, 3 * q)).alias(f"Q{q}_Sales") for q in range(1, 5)]
    return [*quarters, total_sales().alias(year_total)]


def quarter_pivot(facts: DataFrame, product: DataFrame) -> DataFrame:
    """Quarter columns per product name.

    Folded to one row per product before the join, so a hot product is a
    single row when it is shuffled; products sharing a name are added after.
    """
    per_product = facts.groupBy("ProductID").agg(*quarter_totals("OrderDate"))
    columns = [c for c in per_product.columns if c != "ProductID"]
    return (
        per_product.join(product, "ProductID")
        .groupBy("productName")
        .agg(*[total(F.col(c)).alias(c) for c in columns])
    )


def row_counts(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """(table, n) for each table; the counts come from file footers, no column is read."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables
    ]
    return reduce(DataFrame.unionByName, counts)
