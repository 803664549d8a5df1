"""The three summary views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans import olap
from martloom.schemas import Star

STORE_ANALYSIS = "STOREANALYSIS_VIEW"
SUPPLIER_PERFORMANCE = "SUPPLIER_PERFORMANCE_VIEW"
CUSTOMER_STORE_SALES = "CUSTOMER_STORE_SALES_MV"


def create_views(star: Star) -> None:
    """Define or redefine the views; each is computed when it is read."""
    olap.store_product_totals(star).createOrReplaceTempView(STORE_ANALYSIS)
    olap.supplier_performance(star).createOrReplaceTempView(SUPPLIER_PERFORMANCE)
    olap.customer_store_monthly_sales(star).createOrReplaceTempView(CUSTOMER_STORE_SALES)


def refresh_customer_store_sales(spark: SparkSession, star: Star, path: str) -> DataFrame:
    """Materialise the customer/store view as Parquet, one folder per year, and read the view from it.

    Every refresh writes a folder of its own under ``path`` and then points the
    view at it, so whoever reads the view meanwhile keeps the old rows. Older
    folders are left to the storage's clean-up.
    """
    report = olap.customer_store_monthly_sales(star)
    # Rebalancing gathers a year into few files and still splits a year that is large.
    version = f"{path.rstrip('/')}/{uuid.uuid4()}"
    report.hint("rebalance", F.col("OrderYear")).write.partitionBy("OrderYear").parquet(version)
    stored = spark.read.parquet(version).select(*report.columns)
    stored.createOrReplaceTempView(CUSTOMER_STORE_SALES)
    return stored
