"""The same queries in DuckDB's SQL, over the same tables."""

from __future__ import annotations

from martloom.catalogue import RATIO, SHARES, SINCE, SPLIT, STORE, SUPPLIER, YEAR

PRODUCT = """product AS (
  SELECT p_partkey AS ProductID, p_name AS productName,
         p_partkey % (SELECT COUNT(*) FROM supplier) AS supplierID,
         CAST(p_retailprice AS DECIMAL(10, 2)) AS productPrice
  FROM part)"""

FACTS = f"""{PRODUCT},
facts AS (
  SELECT l_orderkey AS OrderID, CAST(o_orderdate AS DATE) AS OrderDate, l_partkey AS ProductID,
         o_custkey AS CustomerID, CAST(l_quantity AS INTEGER) AS QuantityOrdered, p.productPrice,
         CAST(CAST(l_quantity AS INTEGER) * p.productPrice AS DECIMAL(21, 2)) AS Sales
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN product p ON l_partkey = p.ProductID)"""

MASTER = f"""{PRODUCT},
master AS (
  SELECT ProductID AS productID, productName, productPrice, supplierID, s_name AS supplierName,
         n_nationkey AS storeID, n_name AS storeName
  FROM product JOIN supplier ON supplierID = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

TX = """tx AS (
  SELECT l_orderkey AS Order_ID, o_orderdate AS Order_Date, l_partkey AS ProductID, o_custkey AS CustomerID,
         c_name AS CustomerName, c_mktsegment AS Gender, CAST(l_quantity AS INTEGER) AS Quantity_Ordered,
         l_linenumber AS LineNumber, l_suppkey AS LineSupplier, l_shipdate AS ShipDate, l_linestatus AS LineStatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

TX_COLUMNS = "Order_ID, Order_Date, ProductID, CustomerID, CustomerName, Gender, Quantity_Ordered"

JOINED = f"""{MASTER}, {TX},
joined AS (
  SELECT tx.*, m.productName, m.productPrice, m.supplierID, m.supplierName, m.storeID, m.storeName
  FROM tx JOIN master m ON tx.ProductID = m.productID)"""

JOINED_COLUMNS = (
    "Order_ID, Order_Date, ProductID, CustomerID, Quantity_Ordered, productPrice, CustomerName, Gender, "
    "supplierID, supplierName, productName, storeID, storeName"
)

# Passes: every line numbered by arrival, each product by its first arrival in the pass.
PASSES = f"""{JOINED},
numbered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY Order_ID, LineNumber, ProductID, LineSupplier, ShipDate,
                               Quantity_Ordered) AS seq
  FROM joined),
one_pass AS (SELECT *, MIN(seq) OVER (PARTITION BY ProductID) AS seen FROM numbered),
two_passes AS (
  SELECT *, MIN(seq) OVER (PARTITION BY pass, ProductID) AS seen
  FROM (SELECT *, CASE LineStatus WHEN 'F' THEN 1 ELSE 2 END AS pass FROM numbered))"""


def _upserted(rows: str, order: str) -> str:
    """First product, and everything else from the last row, of each order in ``rows``."""
    backwards = ", ".join(f"{c.strip()} DESC" for c in order.split(","))
    return f"""WITH {PASSES},
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY Order_ID ORDER BY {order}) AS r,
         ROW_NUMBER() OVER (PARTITION BY Order_ID ORDER BY {backwards}) AS b
  FROM {rows})
SELECT l.Order_ID AS OrderID, CAST(l.Order_Date AS DATE) AS OrderDate, f.ProductID, l.CustomerID,
       l.Quantity_Ordered AS QuantityOrdered, l.productPrice
FROM ranked l JOIN ranked f ON l.Order_ID = f.Order_ID
WHERE l.b = 1 AND f.r = 1"""


# Every pass takes all lines that landed so far of the products that arrived in it.
REJOINED = f"""(
  SELECT n.*, a.pass, a.arrived
  FROM (SELECT ProductID, Order_ID % {SPLIT} AS pass, MIN(seq) AS arrived FROM numbered GROUP BY 1, 2) a
  JOIN numbered n ON n.ProductID = a.ProductID AND n.Order_ID % {SPLIT} <= a.pass)"""


LOADED_SALES = f"""WITH loaded AS ({_upserted("one_pass", "seq")}), {JOINED},
stores AS (SELECT DISTINCT storeID, storeName FROM joined),
products AS (SELECT DISTINCT ProductID, supplierID FROM joined)
SELECT storeID, storeName, CustomerID, c_name AS CustomerName, CAST(YEAR(OrderDate) AS INTEGER) AS OrderYear,
       CAST(MONTH(OrderDate) AS INTEGER) AS OrderMonth,
       CAST(SUM(CAST(QuantityOrdered * productPrice AS DECIMAL(21, 2))) AS DECIMAL(38, 2)) AS MonthlySales
FROM loaded JOIN products USING (ProductID) JOIN stores ON supplierID = storeID JOIN customer ON CustomerID = c_custkey
GROUP BY ALL"""


def _first_of(key: str, columns: str) -> str:
    """The first-loaded attributes of each key over two passes."""
    return f"""WITH {PASSES},
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY pass, seen, seq) AS r
  FROM two_passes WHERE {key} IS NOT NULL)
SELECT {columns} FROM ranked WHERE r = 1"""


MONTHLY_BY_SUPPLIER = """
FROM facts f JOIN product p ON f.ProductID = p.ProductID JOIN supplier s ON p.supplierID = s.s_suppkey"""

STORE_TOTALS = f"""WITH {FACTS}
SELECT n_nationkey AS STORE_ID, p.ProductID AS PROD_ID, CAST(SUM(Sales) AS DECIMAL(38, 2)) AS STORE_TOTAL
FROM facts f JOIN product p ON f.ProductID = p.ProductID
JOIN customer ON f.CustomerID = c_custkey
JOIN nation ON p.supplierID = n_nationkey
GROUP BY n_nationkey, p.ProductID"""

SUPPLIER_PERFORMANCE = f"""WITH {FACTS}
SELECT CAST(YEAR(OrderDate) AS INTEGER) AS "Year", CAST(MONTH(OrderDate) AS INTEGER) AS "Month",
       p.supplierID, s_name AS supplierName, CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales
{MONTHLY_BY_SUPPLIER}
GROUP BY ALL"""

CUSTOMER_STORE_SALES = f"""WITH {FACTS}
SELECT n_nationkey AS storeID, n_name AS storeName, c_custkey AS CustomerID, c_name AS CustomerName,
       CAST(YEAR(OrderDate) AS INTEGER) AS OrderYear, CAST(MONTH(OrderDate) AS INTEGER) AS OrderMonth,
       CAST(SUM(Sales) AS DECIMAL(38, 2)) AS MonthlySales
FROM facts f JOIN product p ON f.ProductID = p.ProductID
JOIN supplier s ON p.supplierID = s.s_suppkey
JOIN nation ON s.s_suppkey = n_nationkey
JOIN customer ON f.CustomerID = c_custkey
GROUP BY ALL"""

DICED = f"""{FACTS},
diced AS (
  SELECT p.productName, CAST(YEAR(OrderDate) AS INTEGER) AS "Year", CAST(MONTH(OrderDate) AS INTEGER) AS "Month", Sales
  {MONTHLY_BY_SUPPLIER}
  WHERE s.s_name = '{SUPPLIER}' AND YEAR(OrderDate) = {YEAR})"""


def _quarter(q: int) -> str:
    return (
        f"CAST(SUM(CASE WHEN MONTH(OrderDate) BETWEEN {3 * q - 2} AND {3 * q} THEN Sales ELSE 0 END)"
        f" AS DECIMAL(38, 2)) AS Q{q}_Sales"
    )


def _rates(unit: str) -> str:
    """Arrivals of both feeds in every tick from the first to the last."""
    return f"""WITH feeds AS (
  SELECT TIME_BUCKET(INTERVAL '1 {unit}', ts) AS tick, event_type FROM events WHERE event_type IN ('purchase', 'view')),
ticks AS (
  SELECT UNNEST(GENERATE_SERIES(MIN(tick), MAX(tick), INTERVAL '1 {unit}')) AS tick FROM feeds)
SELECT t.tick, COUNT(*) FILTER (WHERE event_type = 'purchase') AS transaction_rate,
       COUNT(*) FILTER (WHERE event_type = 'view') AS master_rate
FROM ticks t LEFT JOIN feeds f ON t.tick = f.tick
GROUP BY t.tick"""


DUAL_ARRIVALS = """SELECT TIME_BUCKET(INTERVAL '1 hour', ts) AS tick,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS transaction_rate,
       COUNT(*) FILTER (WHERE event_type = 'view') AS master_rate
FROM events
GROUP BY 1
HAVING transaction_rate > 0 AND master_rate > 0"""


def _count(name: str, rows: str) -> str:
    return f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {rows}"


ORACLE_SQL: dict[str, str] = {
    "supplier_sales_drilldown": f"""WITH {FACTS}
SELECT p.supplierID, s_name AS supplierName, CAST(YEAR(OrderDate) AS INTEGER) AS "Year",
       CAST(QUARTER(OrderDate) AS INTEGER) AS "Quarter", CAST(MONTH(OrderDate) AS INTEGER) AS "Month",
       CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales
{MONTHLY_BY_SUPPLIER}
GROUP BY ALL
ORDER BY 1, 3, 4, 5""",
    "product_month_rollup": f"""WITH {DICED}
SELECT productName, "Month", "Year", CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales
FROM diced
GROUP BY ROLLUP (productName, "Year", "Month")
ORDER BY productName, "Year", "Month" """,
    "product_month_grouping_sets": f"""WITH {DICED}
SELECT productName, "Year", "Month", CAST(GROUPING(productName, "Year", "Month") AS BIGINT) AS Level,
       CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales
FROM diced
GROUP BY GROUPING SETS ((productName, "Year", "Month"), (productName, "Year"), (productName), ())""",
    "weekend_top_products": f"""WITH {FACTS}
SELECT p.productName, CAST(SUM(QuantityOrdered) AS BIGINT) AS TotalQuantity
FROM facts f JOIN product p ON f.ProductID = p.ProductID
WHERE DAYOFWEEK(OrderDate) IN (0, 6)
GROUP BY p.productName
ORDER BY TotalQuantity DESC, p.productName
LIMIT 5""",
    "product_quarter_pivot": f"""WITH {FACTS}
SELECT p.productName, {", ".join(_quarter(q) for q in range(1, 5))},
       CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalYearlySales
FROM facts f JOIN product p ON f.ProductID = p.ProductID
WHERE YEAR(OrderDate) = {YEAR}
GROUP BY p.productName
ORDER BY p.productName""",
    # Compared in whole cents, so that no product outgrows the decimal width.
    "sales_outlier_products": f"""WITH {FACTS}
SELECT p.productName, CAST(SUM(Sales) AS DOUBLE) / COUNT(Sales) AS AverageSales,
       CAST(MAX(Sales) AS DECIMAL(21, 2)) AS MaxSales
FROM facts f JOIN product p ON f.ProductID = p.ProductID
GROUP BY p.productName
HAVING CAST(MAX(Sales) * 100 AS HUGEINT) * COUNT(Sales) * 100
       > CAST(SUM(Sales) * 100 AS HUGEINT) * {round(float(RATIO) * 100)}""",
    "store_product_totals": STORE_TOTALS,
    "store_monthly_product_sales": f"""WITH {FACTS}
SELECT CAST(MONTH(OrderDate) AS INTEGER) AS "Month", CAST(YEAR(OrderDate) AS INTEGER) AS "Year",
       p.productName AS ProductName, CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales
FROM facts f JOIN product p ON f.ProductID = p.ProductID
JOIN nation ON f.CustomerID = n_nationkey
WHERE n_name = '{STORE}'
GROUP BY ALL
ORDER BY "Year", "Month", TotalSales DESC""",
    "supplier_performance": SUPPLIER_PERFORMANCE,
    "top_customers_by_variety": f"""WITH {FACTS}
SELECT c_custkey AS CustomerID, c_name AS CustomerName, COUNT(DISTINCT ProductID) AS UniqueProductsPurchased
FROM facts JOIN customer ON CustomerID = c_custkey
WHERE YEAR(OrderDate) = {YEAR}
GROUP BY c_custkey, c_name
ORDER BY UniqueProductsPurchased DESC, c_custkey
LIMIT 5""",
    "customer_store_monthly_sales": CUSTOMER_STORE_SALES,
    "facts_with_sales": f"WITH {FACTS} SELECT * FROM facts",
    "facts_in_year": f"WITH {FACTS} SELECT * EXCLUDE (Sales) FROM facts WHERE YEAR(OrderDate) = {YEAR}",
    "weekend_facts": f"WITH {FACTS} SELECT * EXCLUDE (Sales) FROM facts WHERE DAYOFWEEK(OrderDate) IN (0, 6)",
    "store_slice": f"""WITH {FACTS}
SELECT f.* EXCLUDE (Sales), n_nationkey AS storeID, n_name AS storeName
FROM facts f JOIN nation ON f.CustomerID = n_nationkey WHERE n_name = '{STORE}'""",
    "supplier_year_dice": f"""WITH {FACTS}
SELECT p.ProductID, p.productName, s_name AS supplierName, CAST(SUM(QuantityOrdered) AS BIGINT) AS TotalQuantity
{MONTHLY_BY_SUPPLIER}
WHERE s_name = '{SUPPLIER}' AND YEAR(OrderDate) = {YEAR}
GROUP BY ALL""",
    "monthly_aggregates": f"""WITH {FACTS}
SELECT CAST(YEAR(OrderDate) AS INTEGER) AS "Year", CAST(QUARTER(OrderDate) AS INTEGER) AS "Quarter",
       CAST(MONTH(OrderDate) AS INTEGER) AS "Month", CAST(SUM(Sales) AS DECIMAL(38, 2)) AS TotalSales,
       CAST(SUM(QuantityOrdered) AS BIGINT) AS TotalQuantity, CAST(SUM(Sales) AS DOUBLE) / COUNT(Sales) AS AverageSales,
       MAX(Sales) AS MaxSales, COUNT(*) AS NumberOfRows, COUNT(DISTINCT ProductID) AS UniqueProducts
FROM facts GROUP BY 1, 2, 3""",
    "facts_with_product": f"""WITH {FACTS}
SELECT f.* EXCLUDE (Sales), p.productName, p.supplierID FROM facts f JOIN product p ON f.ProductID = p.ProductID""",
    "products_with_supplier": f"""WITH {PRODUCT}
SELECT ProductID, productName, supplierID, s_name AS supplierName FROM product JOIN supplier ON supplierID = s_suppkey""",
    "facts_with_customer": f"""WITH {FACTS}
SELECT f.* EXCLUDE (Sales), c_name AS CustomerName, c_mktsegment AS Gender
FROM facts f JOIN customer ON CustomerID = c_custkey""",
    "products_with_store": f"""WITH {PRODUCT}
SELECT ProductID, productName, supplierID, n_nationkey AS storeID, n_name AS storeName
FROM product JOIN nation ON supplierID = n_nationkey""",
    "store_analysis_view": STORE_TOTALS,
    "supplier_performance_view": SUPPLIER_PERFORMANCE,
    "customer_store_sales_view": CUSTOMER_STORE_SALES,
    "refreshed_customer_store_sales": CUSTOMER_STORE_SALES,
    "incremental_customer_store_sales": LOADED_SALES,
    "incremental_top_customers": f"""WITH loaded AS ({_upserted("one_pass", "seq")})
SELECT CustomerID, c_name AS CustomerName, COUNT(DISTINCT ProductID) AS UniqueProductsPurchased
FROM loaded JOIN customer ON CustomerID = c_custkey
WHERE YEAR(OrderDate) = {YEAR}
GROUP BY CustomerID, c_name
ORDER BY UniqueProductsPurchased DESC, CustomerID
LIMIT 5""",
    "scan_transactions": f"WITH {TX} SELECT {TX_COLUMNS} FROM tx",
    "scan_master": f"WITH {MASTER} SELECT * FROM master",
    "stream_master_feed": f"WITH {MASTER} SELECT * FROM master",
    "csv_transactions": f"""WITH {TX}
SELECT Order_ID, CAST(Order_Date AS TIMESTAMP) AS Order_Date, ProductID, CustomerID, CustomerName, Gender, Quantity_Ordered
FROM tx""",
    "preview_master": f"WITH {MASTER} SELECT * FROM master",
    "stream_csv_transactions": f"""WITH {TX}
SELECT Order_ID, CAST(Order_Date AS TIMESTAMP) AS Order_Date, ProductID, CustomerID, CustomerName, Gender, Quantity_Ordered
FROM tx WHERE Order_ID % 10 <> 0""",
    "stream_csv_rejected": f"""WITH {TX}
SELECT Order_ID, 'about ' || Quantity_Ordered AS quantity, COUNT(*) AS n FROM tx WHERE Order_ID % 10 = 0 GROUP BY ALL""",
    "csv_master_reordered": f"WITH {MASTER} SELECT * REPLACE (CAST(storeID AS BIGINT) AS storeID) FROM master",
    "conform_transactions": f"""WITH {TX}
SELECT Order_ID, CAST(Order_Date AS TIMESTAMP) AS Order_Date, ProductID, CustomerID,
       CustomerName, Gender, Quantity_Ordered
FROM tx""",
    "table_row_counts": f"""WITH {JOINED}
{_count("cleaned_transactions", "tx")}
UNION ALL {_count("master_data_cleaned", "master")}
UNION ALL {_count("OrderFacts", "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey")}
UNION ALL {_count("ProductDimension", "part")}
UNION ALL {_count("CustomerDimension", "customer")}
UNION ALL {_count("SupplierDimension", "supplier")}
UNION ALL {_count("StoreDimension", "nation")}""",
    "enrich_transactions": f"WITH {JOINED} SELECT {JOINED_COLUMNS} FROM joined",
    "refresh_pending_products": f"""WITH {JOINED}
SELECT {JOINED_COLUMNS} FROM joined
WHERE ProductID IN (SELECT ProductID FROM tx WHERE Order_Date >= DATE '{SINCE}')""",
    "pending_product_keys": f"WITH {TX} SELECT DISTINCT ProductID FROM tx WHERE ProductID IS NOT NULL",
    # Empty on these tables: every part's supplier exists.
    "orphan_products": f"""WITH {PRODUCT}
SELECT supplierID, ProductID, productName FROM product
WHERE supplierID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = supplierID)""",
    "orphan_products_by_store": f"""WITH {PRODUCT}
SELECT ProductID, productName, supplierID FROM product
WHERE supplierID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = supplierID)""",
    # Empty on these tables: every line's part exists.
    "unmatched_transactions": f"""WITH {MASTER}, {TX}
SELECT {TX_COLUMNS} FROM tx
WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.productID = tx.ProductID)""",
    "unmatched_stocked_transactions": f"""WITH {MASTER}, {TX}
SELECT {TX_COLUMNS} FROM tx
WHERE NOT EXISTS (SELECT 1 FROM master m JOIN nation ON m.supplierID = n_nationkey
                  WHERE m.productID = tx.ProductID)""",
    "upsert_order_facts": _upserted("one_pass", "seen, seq"),
    "upsert_order_facts_second_pass": _upserted("two_passes", "pass, seen, seq"),
    "load_supplier_dim": _first_of("supplierID", "supplierID, supplierName || ' ' || ProductID AS supplierName"),
    "load_product_dim": _first_of("ProductID", "ProductID, productName, supplierID"),
    "load_customer_dim": _first_of(
        "CustomerID", "CustomerID, CustomerName, Gender || ' ' || Order_ID || ' ' || LineNumber || ' ' || LineStatus AS Gender"
    ),
    "load_store_dim": _first_of("storeID", "storeID, storeName || ' ' || ProductID AS storeName"),
    "load_report": f"""WITH {JOINED}
SELECT COUNT(*) AS joined_rows, COUNT(DISTINCT Order_ID) AS distinct_orders FROM joined""",
    "arrival_rate_per_tick": _rates("hour"),
    "stream_arrival_rate_per_tick": _rates("minute"),
    "dual_arrival_ticks": DUAL_ARRIVALS,
    "stream_dual_arrival_ticks": DUAL_ARRIVALS,
    "stream_arrival_rate": """SELECT TIME_BUCKET(INTERVAL '1 hour', ts) AS tick, COUNT(*) AS arrivals
FROM events GROUP BY 1""",
    "stream_load_order_facts": _upserted("one_pass", "seq"),
    "stream_load_split_order_facts": _upserted("one_pass", "seq"),
    "stream_load_history": _upserted(REJOINED, "pass, arrived, seq"),
    "gated_load_order_facts": _upserted(f"(SELECT * FROM one_pass WHERE Order_ID % {SHARES} <> {SHARES - 1})", "seq"),
    "gated_load_waiting": f"""WITH {TX}
SELECT ProductID, COUNT(*) AS transactions FROM tx WHERE Order_ID % {SHARES} = {SHARES - 1} GROUP BY ProductID""",
    "gated_load_progress": f"""WITH {JOINED},
passes AS (SELECT UNNEST(RANGE({SHARES})) AS pass),
came AS (SELECT Order_ID % {SHARES} AS pass, COUNT(*) AS n FROM tx GROUP BY 1),
made AS (
  SELECT CASE Order_ID % {SHARES} WHEN 1 THEN 2 ELSE Order_ID % {SHARES} END AS pass, COUNT(*) AS joined_rows,
         COUNT(DISTINCT Order_ID) AS distinct_orders
  FROM joined GROUP BY 1),
fed AS (SELECT productID % 2 * 2 AS pass, COUNT(*) AS n FROM master GROUP BY 1)
SELECT p.pass, p.pass % 2 = 0 AS gate_open, COALESCE(came.n, 0) AS transactions, COALESCE(fed.n, 0) AS master_rows,
       CASE p.pass % 2 WHEN 1 THEN came.n ELSE 0 END AS waiting,
       CASE p.pass % 2 WHEN 0 THEN joined_rows ELSE 0 END AS joined_rows,
       CASE p.pass % 2 WHEN 0 THEN distinct_orders ELSE 0 END AS distinct_orders
FROM passes p LEFT JOIN came USING (pass) LEFT JOIN made USING (pass) LEFT JOIN fed USING (pass)""",
    "stream_load_dimensions": f"""WITH {JOINED}
SELECT DISTINCT 'supplier' AS dimension, supplierID AS id, supplierName AS name, CAST(NULL AS VARCHAR) AS detail FROM joined
UNION ALL SELECT DISTINCT 'product', ProductID, productName, CAST(supplierID AS VARCHAR) FROM joined
UNION ALL SELECT DISTINCT 'customer', CustomerID, CustomerName, Gender FROM joined
UNION ALL SELECT DISTINCT 'store', storeID, storeName, CAST(NULL AS VARCHAR) FROM joined""",
    "stream_load_row_counts": f"""WITH {JOINED}
{_count("OrderFacts", "(SELECT DISTINCT Order_ID FROM joined)")}
UNION ALL {_count("ProductDimension", "(SELECT DISTINCT ProductID FROM joined)")}
UNION ALL {_count("CustomerDimension", "(SELECT DISTINCT CustomerID FROM joined)")}
UNION ALL {_count("SupplierDimension", "(SELECT DISTINCT supplierID FROM joined)")}
UNION ALL {_count("StoreDimension", "(SELECT DISTINCT storeID FROM joined)")}""",
}
