"""Ten OLAP reports over the star.

Shape shared by all of them: drop rows first (year, store, dice), join the fact
only with dimensions that carry a grouping key or drop rows, aggregate, and
attach names to the small result. Where the grouping key contains the join key
the facts are folded to one row per key before the join; otherwise a hot key
would be joined and grouped within a single task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.measures import date_parts, month_start, total
from martloom.functions.predicates import in_year, slice_, weekend
from martloom.operators.aggregates import grouping_sets_sales, quarter_pivot, rollup_sales, sales_by
from martloom.operators.joins import having, star_join, store_join
from martloom.operators.ranking import top_k
from martloom.schemas import Star


def _monthly_by_supplier(star: Star) -> DataFrame:
    """(supplierID, SalesMonth, TotalSales, supplierName)."""
    suppliers_of = star.product.select("ProductID", "supplierID")
    monthly = sales_by(
        star_join(star.facts, suppliers_of, "product"),
        ["supplierID", month_start().alias("SalesMonth")],
    )
    return star_join(monthly, star.supplier, "supplier")


def supplier_sales_drilldown(star: Star) -> DataFrame:
    """Sales per supplier, drilled down from year to quarter to month."""
    return (
        _monthly_by_supplier(star)
        .select(
            "supplierID",
            "supplierName",
            *date_parts("SalesMonth", year="Year", quarter="Quarter", month="Month"),
            "TotalSales",
        )
        .orderBy("supplierID", "Year", "Quarter", "Month")
    )


def _diced_product_sales(star: Star, supplier: str, year: int) -> DataFrame:
    """Fact rows of one supplier and year with product name, Year and Month."""
    of_supplier = having(star.product, slice_(star.supplier, "supplierName", supplier), "supplierID", "supplierID")
    return star_join(in_year(star.facts, year), of_supplier, "product").select(
        "productName", *date_parts("OrderDate", year="Year", month="Month"), "QuantityOrdered", "productPrice"
    )


def product_month_rollup(star: Star, supplier: str = "DJI", year: int = 2019) -> DataFrame:
    """Product, year and month rollup of one supplier's sales in one year."""
    return (
        rollup_sales(_diced_product_sales(star, supplier, year), ["productName", "Year", "Month"])
        .select("productName", "Month", "Year", "TotalSales")
        .orderBy("productName", "Year", "Month")
    )


def product_month_grouping_sets(star: Star, supplier: str = "DJI", year: int = 2019) -> DataFrame:
    """The same report as named grouping sets, each row marked with its level."""
    sets = [["productName", "Year", "Month"], ["productName", "Year"], ["productName"], []]
    return grouping_sets_sales(
        _diced_product_sales(star, supplier, year), ["productName", "Year", "Month"], sets, level="Level"
    ).orderBy("productName", "Year", "Month", "Level")


def weekend_top_products(star: Star, k: int = 5) -> DataFrame:
    """Products with the largest quantity sold on weekends."""
    per_product = weekend(star.facts).groupBy("ProductID").agg(F.sum("QuantityOrdered").alias("Quantity"))
    by_name = (
        star_join(per_product, star.product.select("ProductID", "productName"), "product")
        .groupBy("productName")
        .agg(F.sum("Quantity").alias("TotalQuantity"))
    )
    return top_k(by_name, "TotalQuantity", k, tie=["productName"])


def product_quarter_pivot(star: Star, year: int = 2019) -> DataFrame:
    """Quarterly and yearly sales per product, one column per quarter."""
    names = star.product.select("ProductID", "productName")
    return quarter_pivot(in_year(star.facts, year), names).orderBy("productName")


def sales_outlier_products(star: Star, ratio: str | int = 10) -> DataFrame:
    """Products whose largest sale exceeds ``ratio`` times their average sale.

    Compared as ``max * count > ratio * sum``, which needs no rounded average.
    Facts are folded per product and price: within such a group only the
    quantity varies, so the decimal products are taken once per group.
    """
    quantity, price = F.col("QuantityOrdered"), F.col("productPrice")
    per_price = (
        star.facts.filter(quantity.isNotNull() & price.isNotNull())
        .groupBy("ProductID", "productPrice")
        .agg(F.sum(quantity).alias("q"), F.count("*").alias("n"), F.min(quantity).alias("lo"), F.max(quantity).alias("hi"))
    )
    by_name = (
        star_join(per_price, star.product.select("ProductID", "productName"), "product")
        .groupBy("productName")
        .agg(
            total(F.col("q") * price).alias("s"),
            F.sum("n").alias("n"),
            F.max(F.greatest(F.col("hi") * price, F.col("lo") * price)).alias("MaxSales"),
        )
    )
    return by_name.filter(F.col("MaxSales") * F.col("n") > F.lit(Decimal(str(ratio))) * F.col("s")).select(
        "productName", (F.col("s").cast("double") / F.col("n")).alias("AverageSales"), "MaxSales"
    )


def store_product_totals(star: Star) -> DataFrame:
    """Sales per store and product, with the store found by the supplier's number."""
    sold_to_known = having(star.facts, star.customer, "CustomerID", "CustomerID")
    per_product = star_join(
        sales_by(sold_to_known, ["ProductID"], "STORE_TOTAL"), star.product.select("ProductID", "supplierID"), "product"
    )
    return store_join(per_product, star.store.select("storeID"), "supplierID").select(
        F.col("storeID").alias("STORE_ID"), F.col("ProductID").alias("PROD_ID"), "STORE_TOTAL"
    )


def store_monthly_product_sales(star: Star, store: str = "Tech Haven") -> DataFrame:
    """Monthly product sales of one store, with the store found by the customer's number."""
    of_store = having(star.facts, slice_(star.store, "storeName", store), "CustomerID", "storeID")
    names = star.product.select("ProductID", F.col("productName").alias("ProductName"))
    return (
        sales_by(star_join(of_store, names, "product"), ["ProductName", month_start().alias("SalesMonth")])
        .select(*date_parts("SalesMonth", year="Year", month="Month"), "ProductName", "TotalSales")
        .select("Month", "Year", "ProductName", "TotalSales")
        .orderBy("Year", "Month", F.desc("TotalSales"), "ProductName")
    )


def supplier_performance(star: Star) -> DataFrame:
    """Monthly sales per supplier."""
    return _monthly_by_supplier(star).select(
        *date_parts("SalesMonth", year="Year", month="Month"), "supplierID", "supplierName", "TotalSales"
    )


def top_customers_by_variety(star: Star, year: int = 2019, k: int = 5) -> DataFrame:
    """Customers who bought the most different products in one year."""
    variety = (
        in_year(star.facts, year)
        .groupBy("CustomerID")
        .agg(F.countDistinct("ProductID").alias("UniqueProductsPurchased"))
    )
    named = star_join(variety, star.customer, "customer").select("CustomerID", "CustomerName", "UniqueProductsPurchased")
    return top_k(named, "UniqueProductsPurchased", k, tie=["CustomerID"])


def customer_store_monthly_sales(star: Star) -> DataFrame:
    """Monthly sales per store and customer, with the store found by the supplier's number."""
    supplied = having(star.product, star.supplier, "supplierID", "supplierID")
    stocked = having(supplied, star.store, "supplierID", "storeID").select("ProductID", "supplierID")
    monthly = sales_by(
        star_join(star.facts, stocked, "product"),
        ["supplierID", "CustomerID", month_start().alias("SalesMonth")],
        "MonthlySales",
    )
    named = star_join(store_join(monthly, star.store, "supplierID"), star.customer, "customer")
    return named.select(
        "storeID",
        "storeName",
        "CustomerID",
        "CustomerName",
        *date_parts("SalesMonth", year="OrderYear", month="OrderMonth"),
        "MonthlySales",
    )
