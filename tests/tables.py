"""Small hand-written tables in the source schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import LongType, StructField, StructType

from martloom.schemas import MASTER, STAR, TRANSACTIONS, Star

TX = StructType([*TRANSACTIONS.fields, StructField("seq", LongType())])


def at(day: int, hour: int = 9) -> dt.datetime:
    return dt.datetime(2019, 1, day, hour)


def tx_table(spark, rows):
    """Rows of (order, day, product, customer, quantity, seq)."""
    return spark.createDataFrame(
        [(o, at(d), p, c, None if c is None else f"c{c}", "f", q, s) for o, d, p, c, q, s in rows], TX
    )


def master_table(spark, rows):
    """Rows of (product, price, supplier, store)."""
    return spark.createDataFrame(
        [
            (p, f"p{p}", Decimal(price), s, None if s is None else f"s{s}", t, None if t is None else f"t{t}")
            for p, price, s, t in rows
        ],
        MASTER,
    )


def star_of(spark, facts, products, customers=(), suppliers=(), stores=()):
    rows = [(o, d, p, c, q, Decimal(str(price))) for o, d, p, c, q, price in facts]
    return Star(
        facts=spark.createDataFrame(rows, STAR["OrderFacts"]),
        product=spark.createDataFrame(list(products), STAR["ProductDimension"]),
        customer=spark.createDataFrame(list(customers), STAR["CustomerDimension"]),
        supplier=spark.createDataFrame(list(suppliers), STAR["SupplierDimension"]),
        store=spark.createDataFrame(list(stores), STAR["StoreDimension"]),
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
