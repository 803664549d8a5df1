"""The generic test tables mapped onto the feeds and the star.

Stores are nations, a product's supplier is ``p_partkey`` modulo the number of
suppliers, and every line of an order is one transaction. Keys keep the type
they have in the files.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.joins import enrich
from martloom.operators.load import order_facts
from martloom.operators.sizing import broadcast_if_small
from martloom.schemas import PRICE, Star

# Arrival order of the transactions; no two lines share all of these.
SEQ = ["Order_ID", "LineNumber", "ProductID", "LineSupplier", "ShipDate", "Quantity_Ordered"]


@lru_cache(maxsize=64)
def _schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a test table, looked up once per session."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def transactions_of(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Transactions from order lines. Orders meet their customer first: four times fewer rows to shuffle."""
    headers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("Order_ID"),
        F.col("o_orderdate").alias("Order_Date"),
        F.col("l_partkey").alias("ProductID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_mktsegment").alias("Gender"),
        F.col("l_quantity").cast("int").alias("Quantity_Ordered"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_suppkey").alias("LineSupplier"),
        F.col("l_shipdate").alias("ShipDate"),
        F.col("l_linestatus").alias("LineStatus"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(*[table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer")])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("productName"),
        (F.col("p_partkey") % suppliers).alias("supplierID"),
        F.col("p_retailprice").cast(PRICE).alias("productPrice"),
    )


def raw_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return (
        products(spark, sf_dir)
        .join(supplier, F.col("supplierID") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("ProductID").alias("productID"),
            "productName",
            "productPrice",
            "supplierID",
            F.col("s_name").alias("supplierName"),
            F.col("n_nationkey").alias("storeID"),
            F.col("n_name").alias("storeName"),
        )
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master data; hinted for broadcast only if it measures small."""
    return broadcast_if_small(raw_master(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(transactions(spark, sf_dir), master(spark, sf_dir))


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts at line grain, with only the tables the fact columns come from."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    priced = products(spark, sf_dir).select("ProductID", "productPrice")
    return order_facts(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("Order_ID"),
            F.col("o_orderdate").alias("Order_Date"),
            F.col("l_partkey").alias("ProductID"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("l_quantity").cast("int").alias("Quantity_Ordered"),
        )
        .join(priced, "ProductID")
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The warehouse over line-grain facts; stores are the whole nation table."""
    return Star(
        facts=line_facts(spark, sf_dir),
        product=products(spark, sf_dir).select("ProductID", "productName", "supplierID"),
        customer=table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("CustomerName"),
            F.col("c_mktsegment").alias("Gender"),
        ),
        supplier=table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("supplierID"), F.col("s_name").alias("supplierName")
        ),
        store=table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("storeID"), F.col("n_name").alias("storeName")
        ),
    )
