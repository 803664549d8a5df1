"""The sales measure and the date parts it is reported by."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.schemas import MONEY

LOW_BITS = 17


def sales() -> Column:
    """Quantity times price of one fact row, exact in decimal arithmetic."""
    return F.col("QuantityOrdered") * F.col("productPrice")


def with_sales(df: DataFrame, name: str = "Sales") -> DataFrame:
    return df.withColumn(name, sales())


def total(amount: Column) -> Column:
    """Sum of an amount that is already folded to few rows."""
    return F.sum(amount).cast(MONEY)


def total_sales(only: Column | None = None) -> Column:
    """Exact sum of quantity * price; rows outside ``only`` count as zero.

    ``SUM`` over a decimal this wide works on boxed numbers and is about three
    times slower than over integers. Prices have two decimals, so the sum is
    taken in cents, split into a high and a low part that are put together once
    per group. Each part stays within 64 bits until the total passes 10^22; a
    larger one raises an overflow error under ANSI mode.
    """
    cents = (F.col("productPrice") * 100).cast("bigint")
    high, low = F.shiftright(cents, LOW_BITS), cents.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("bigint"))

    def part(value: Column) -> Column:
        term = F.col("QuantityOrdered") * value
        return F.sum(term if only is None else F.when(only, term).otherwise(0)).cast("decimal(20,0)")

    in_cents = part(high) * F.lit(Decimal(2**LOW_BITS)) + part(low)
    return (in_cents * F.lit(Decimal("0.01"))).cast(MONEY)


def month_start(date: str = "OrderDate") -> Column:
    """First day of the month: one 4-byte grouping key that holds year, quarter and month."""
    return F.trunc(date, "month")


def date_parts(date: str, year: str | None = None, quarter: str | None = None, month: str | None = None) -> list[Column]:
    """The named parts of ``date``, in the order year, quarter, month."""
    parts = [(year, F.year), (quarter, F.quarter), (month, F.month)]
    return [part(date).alias(name) for name, part in parts if name]
