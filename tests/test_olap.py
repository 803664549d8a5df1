"""Reports on hand-written stars: defaults, names shared by products, NULLs, exact money."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import fixtures
from martloom.functions.measures import total_sales, with_sales
from martloom.functions.predicates import dice, in_year, slice_, weekend
from martloom.operators.aggregates import grouping_sets_sales, rollup_sales
from martloom.plans import olap, views
from tables import rows_of, star_of

D = dt.date
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return star_of(
        spark,
        facts=[
            # Saturday, Sunday, Monday of January 2019, then other years.
            (1, D(2019, 1, 5), 1, 1, 2, "10.10"),
            (2, D(2019, 1, 6), 2, 1, 1, "0.01"),
            (3, D(2019, 1, 7), 1, 2, 5, "10.10"),
            (4, D(2019, 4, 1), 3, 2, 1, "7.00"),
            (5, D(2018, 12, 31), 3, 1, 9, "7.00"),
            (6, D(2020, 1, 1), 1, 3, 9, "10.10"),
            (7, D(2019, 1, 8), 9, 1, 1, "1.00"),  # no such product
            (8, D(2019, 1, 9), None, None, 1, "1.00"),
            (9, D(2019, 1, 10), 4, 1, 1, "3.00"),  # product without a name
        ],
        products=[(1, "cam", 1), (2, "cam", 2), (3, "pad", 2), (4, None, 1), (5, "unsold", 1)],
        customers=[(1, "ann", "f"), (2, "bob", "m")],
        suppliers=[(1, "DJI"), (2, "Acme")],
        stores=[(1, "Tech Haven"), (7, "Far")],
    )


def test_in_year_bounds(star):
    assert sorted(r.OrderID for r in in_year(star.facts, 2019).collect()) == [1, 2, 3, 4, 7, 8, 9]


def test_weekend_is_saturday_and_sunday(star):
    assert sorted(r.OrderID for r in weekend(star.facts).collect()) == [1, 2]


def test_slice_and_dice(star):
    assert slice_(star.store, "storeName", "Far").count() == 1
    assert rows_of(dice(star.product, {"productName": "cam", "supplierID": 2})) == [(2, "cam", 2)]


def test_with_sales_is_exact(star):
    assert with_sales(star.facts).filter("OrderID = 3").first()["Sales"] == Decimal("50.50")


def test_rollup_with_default_dice(star):
    got = [tuple(r) for r in olap.product_month_rollup(star).collect()]
    name_null = (None, 1, 2019, Decimal("3.00"))
    assert sorted(got, key=repr) == sorted(
        [
            (None, None, None, Decimal("73.70")),  # all
            (None, None, None, Decimal("3.00")),  # the nameless product
            (None, None, 2019, Decimal("3.00")),
            name_null,
            ("cam", None, None, Decimal("70.70")),
            ("cam", None, 2019, Decimal("70.70")),
            ("cam", 1, 2019, Decimal("70.70")),
        ],
        key=repr,
    )


def test_level_tells_subtotals_from_null_names(star):
    got = olap.product_month_grouping_sets(star).filter("productName IS NULL AND Year IS NULL")
    assert {(r.Level, r.TotalSales) for r in got.collect()} == {(7, Decimal("73.70")), (3, Decimal("3.00"))}


def test_quarter_pivot_has_zero_for_an_empty_quarter(star):
    zero = Decimal("0.00")
    assert [tuple(r) for r in olap.product_quarter_pivot(star).collect()] == [
        (None, Decimal("3.00"), zero, zero, zero, Decimal("3.00")),
        ("cam", Decimal("70.71"), zero, zero, zero, Decimal("70.71")),
        ("pad", zero, Decimal("7.00"), zero, zero, Decimal("7.00")),
    ]


def test_weekend_top_products_adds_products_of_one_name(star):
    assert [tuple(r) for r in olap.weekend_top_products(star).collect()] == [("cam", 3)]


def test_store_reports_use_the_written_predicates(star):
    assert rows_of(olap.store_product_totals(star)) == [
        (1, 1, Decimal("70.70")),  # order 6 has no known customer
        (1, 4, Decimal("3.00")),
    ]
    monthly = [tuple(r) for r in olap.store_monthly_product_sales(star).collect()]
    assert monthly == [
        (12, 2018, "pad", Decimal("63.00")),
        (1, 2019, "cam", Decimal("20.21")),
        (1, 2019, None, Decimal("3.00")),
    ]
    assert rows_of(olap.customer_store_monthly_sales(star)) == [
        (1, "Tech Haven", 1, "ann", 2019, 1, Decimal("23.20")),
        (1, "Tech Haven", 2, "bob", 2019, 1, Decimal("50.50")),
    ]


def test_top_customers_counts_products_once(star):
    assert [tuple(r) for r in olap.top_customers_by_variety(star).collect()] == [(1, "ann", 4), (2, "bob", 2)]


def test_outliers_compare_without_rounding(spark):
    def products(quantities):
        facts = [(i, D(2019, 1, 1), 1, 1, q, "0.03") for i, q in enumerate(quantities)]
        return olap.sales_outlier_products(star_of(spark, facts, [(1, "x", 1)]))

    # Exactly ten times the average is not more than ten times.
    assert products([19, 1] + [0] * 8).collect() == []
    (row,) = products([200] + [1] * 11).collect()
    assert (row.productName, row.MaxSales) == ("x", Decimal("6.00"))
    assert row.AverageSales == pytest.approx(211 * 0.03 / 12)


def test_outliers_with_negative_and_missing_values(spark):
    facts = [(1, D(2019, 1, 1), 1, 1, -4, "-2.00"), (2, D(2019, 1, 1), 1, 1, 1, "-2.00"), (3, D(2019, 1, 1), 1, 1, None, "1.00")]
    (row,) = olap.sales_outlier_products(star_of(spark, facts, [(1, "x", 1)]), ratio=2).collect()
    assert (row.AverageSales, row.MaxSales) == (3.0, Decimal("8.00"))


def test_total_sales_equals_the_decimal_sum(spark):
    rows = [
        (1, 2**31 - 1, "99999999.99"),
        (1, 2**31 - 1, "99999999.99"),
        (1, -5, "0.01"),
        (2, 7, "-12345.67"),
        (2, -(2**31), "-99999999.99"),
        (3, None, "1.00"),
        (3, 1, None),
        (4, 3, "0.00"),
    ]
    df = spark.createDataFrame(
        [(k, q, None if p is None else Decimal(p)) for k, q, p in rows],
        "k int, QuantityOrdered int, productPrice decimal(10,2)",
    )
    got = df.groupBy("k").agg(
        total_sales().alias("t"), F.sum(F.expr("QuantityOrdered * productPrice")).cast("decimal(38,2)").alias("d")
    )
    assert all(r.t == r.d for r in got.collect())
    assert got.filter("k = 3").first()["t"] is None


def test_star_refuses_another_price_type(spark, star):
    from dataclasses import replace

    with pytest.raises(TypeError):
        replace(star, facts=star.facts.withColumn("productPrice", F.col("productPrice").cast("double")))


def test_rollup_levels_add_up(spark):
    facts = fixtures.star(spark, SF).facts
    sold = facts.select(
        F.year("OrderDate").alias("y"), F.month("OrderDate").alias("m"), "QuantityOrdered", "productPrice"
    )
    rolled = rollup_sales(sold, ["y", "m"], level="level")
    sums = {r.level: r.t for r in rolled.groupBy("level").agg(F.sum("TotalSales").alias("t")).collect()}
    assert set(sums) == {0, 1, 3} and len(set(sums.values())) == 1
    assert rows_of(rolled) == rows_of(grouping_sets_sales(sold, ["y", "m"], [["y", "m"], ["y"], []], level="level"))


def test_views_can_be_redefined_and_refreshed(spark, star, tmp_path):
    views.create_views(star)
    views.create_views(star)
    assert spark.table(views.STORE_ANALYSIS).count() == 2
    assert spark.table(views.SUPPLIER_PERFORMANCE).columns == ["Year", "Month", "supplierID", "supplierName", "TotalSales"]
    before = rows_of(spark.table(views.CUSTOMER_STORE_SALES))
    for _ in range(2):
        stored = views.refresh_customer_store_sales(spark, star, str(tmp_path / "mv"))
        assert rows_of(stored) == rows_of(spark.table(views.CUSTOMER_STORE_SALES)) == before


def test_star_answers_plain_sql(spark, star):
    star.register()
    got = spark.sql(
        """SELECT productName, MONTH(OrderDate) AS m, SUM(QuantityOrdered * productPrice) AS s
           FROM ProductDimension JOIN OrderFacts USING (ProductID)
           WHERE DAYOFWEEK(OrderDate) IN (7, 1) AND OrderDate LIKE '2019%'
           GROUP BY productName, m WITH ROLLUP"""
    )
    assert ("cam", 1, Decimal("20.21")) in rows_of(got)
