"""Every registered query: the operators applied to the test tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom import fixtures
from martloom.fixtures import SEQ
from martloom.functions.measures import date_parts, month_start, total_sales, with_sales
from martloom.functions.predicates import dice, in_year, slice_, weekend
from martloom.operators.aggregates import row_counts
from martloom.operators.joins import enrich, orphans, refresh_keys, star_join, store_join, unmatched
from martloom.operators.load import (
    FIRST_SEEN,
    insert_ignore,
    load_report,
    order_facts,
    pass_lines,
    product_order,
    products_seen,
    reduce_batch,
    upsert,
)
from martloom.operators.sizing import fits_broadcast
from martloom.plans import olap, views
from martloom.plans.incremental import CustomerStoreSales, CustomerVariety
from martloom.schemas import DIMENSION_KEYS, FACT_KEEP_FIRST, FACT_KEYS, MASTER, STAR, TRANSACTIONS, Star, conform
from martloom.session import work_dir
from martloom.sources.feeds import preview, read_csv, read_master, read_transactions, split_corrupt
from martloom.sources.warehouse import Warehouse
from martloom.streaming.feeds import land_csv, stream_csv, stream_files, stream_master
from martloom.streaming.loader import pending_keys, run_load
from martloom.streaming.rates import arrival_rate, arrival_rate_stream, gated_tick_stream, gated_ticks, past_clock

Query = Callable[[SparkSession, str], DataFrame]

# Arguments that suit the test tables.
YEAR = 1997
SUPPLIER = "Supplier#000000007"
STORE = "NATION_3"
RATIO = "2.05"
SINCE = date(2001, 7, 26)
HOUR, MINUTE = 3600, 60
# Columns that tell the lines of a hot product apart.
DEAL = ["Order_ID", "Quantity_Ordered"]
# Bounds the work and the cached rows of one pass on tables of many files; facts
# carry their arrival order, so it does not change them.
FILES_PER_PASS = 1000

ENRICHED_COLUMNS = [
    "Order_ID",
    "Order_Date",
    "ProductID",
    "CustomerID",
    "Quantity_Ordered",
    "productPrice",
    "CustomerName",
    "Gender",
    "supplierID",
    "supplierName",
    "productName",
    "storeID",
    "storeName",
]


def _olap(report: Callable[..., DataFrame], **arguments) -> Query:
    return lambda spark, sf_dir: report(fixtures.star(spark, sf_dir), **arguments)


def _facts(report: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(fixtures.star(spark, sf_dir))


def monthly_aggregates(star: Star) -> DataFrame:
    """Every aggregate function of the reports, per year, quarter and month."""
    amount = F.col("Sales")
    return (
        with_sales(star.facts)
        .groupBy(month_start().alias("SalesMonth"))
        .agg(
            total_sales().alias("TotalSales"),
            F.sum("QuantityOrdered").alias("TotalQuantity"),
            (total_sales().cast("double") / F.count(amount)).alias("AverageSales"),
            F.max(amount).alias("MaxSales"),
            F.count("*").alias("NumberOfRows"),
            F.countDistinct("ProductID").alias("UniqueProducts"),
        )
        .select(
            *date_parts("SalesMonth", year="Year", quarter="Quarter", month="Month"),
            *["TotalSales", "TotalQuantity", "AverageSales", "MaxSales", "NumberOfRows", "UniqueProducts"],
        )
    )


def supplier_year_dice(star: Star) -> DataFrame:
    """Sold quantity per product of one supplier in one year."""
    diced = dice(star_join(star.product, star.supplier, "supplier"), {"supplierName": SUPPLIER})
    per_product = in_year(star.facts, YEAR).groupBy("ProductID").agg(F.sum("QuantityOrdered").alias("TotalQuantity"))
    return star_join(per_product, diced, "product").select("ProductID", "productName", "supplierName", "TotalQuantity")


def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it was landed, with columns that a scan does not read."""
    path = work_dir(spark, "transactions")
    fixtures.transactions(spark, sf_dir).write.parquet(path)
    return read_transactions(spark, path)


def scan_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "master")
    fixtures.master(spark, sf_dir).write.parquet(path)
    return read_master(spark, path)


def _csv(rows: Callable[[SparkSession, str], DataFrame], schema: StructType, columns: list[str] | None = None) -> Query:
    """A feed written as CSV, its columns in the given order, and read by its header."""

    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_dir(spark, "csv")
        rows(spark, sf_dir).select(*(columns or schema.names)).write.option("header", True).csv(path)
        return split_corrupt(read_csv(spark, path, schema))[0]

    return read_back


def conform_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(fixtures.transactions(spark, sf_dir), TRANSACTIONS)


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = [
        ("cleaned_transactions", fixtures.transactions(spark, sf_dir)),
        ("master_data_cleaned", fixtures.master(spark, sf_dir)),
    ]
    return row_counts([*staging, *fixtures.star(spark, sf_dir).tables()])


def enrich_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.enriched(spark, sf_dir).select(*ENRICHED_COLUMNS)


def refresh_pending_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions of the products that arrived since the given day."""
    tx = fixtures.transactions(spark, sf_dir)
    master = fixtures.raw_master(spark, sf_dir)
    # No more products can be pending and known than the master data has rows.
    small = fits_broadcast(master)
    arrived = tx.filter(F.col("Order_Date") >= F.lit(SINCE))
    pending = enrich(pending_keys(arrived), master).select("ProductID")
    return refresh_keys(tx, F.broadcast(master) if small else master, pending, small).select(*ENRICHED_COLUMNS)


def pending_product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_keys(fixtures.transactions(spark, sf_dir))


def orphan_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = fixtures.star(spark, sf_dir)
    return orphans(star.product, star.supplier, "supplierID", "supplierID")


def orphan_products_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = fixtures.star(spark, sf_dir)
    return orphans(star.product, star.store, "supplierID", "storeID").select("ProductID", "productName", "supplierID")


def unmatched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = fixtures.raw_master(spark, sf_dir)
    return unmatched(fixtures.transactions(spark, sf_dir), master, DEAL).select(*TRANSACTIONS.names)


def unmatched_stocked_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions lost when only products kept by a store (supplier = store number) count as known."""
    master, store = fixtures.raw_master(spark, sf_dir), fixtures.star(spark, sf_dir).store
    stocked = master.join(store.select(F.col("storeID").alias("supplierID")), "supplierID", "left_semi")
    return unmatched(fixtures.transactions(spark, sf_dir), stocked, DEAL).select(*TRANSACTIONS.names)


PASS = [FIRST_SEEN, *SEQ]
FACT_COLUMNS = STAR["OrderFacts"].names


def _pass(spark: SparkSession, sf_dir: str, fulfilled: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines and products of one pass: all transactions, or those that are or are not fulfilled."""
    tx = fixtures.transactions(spark, sf_dir)
    if fulfilled is not None:
        done = F.col("LineStatus").eqNullSafe("F")
        tx = tx.filter(done if fulfilled else ~done)
    master = fixtures.raw_master(spark, sf_dir)
    # A pass has at most as many products as the master data has rows, and narrower ones.
    small = fits_broadcast(master)
    described = enrich(products_seen(tx, SEQ), F.broadcast(master) if small else master)
    return pass_lines(tx, described, small), described


def upsert_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in one pass over an empty fact table."""
    lines, _ = _pass(spark, sf_dir)
    return reduce_batch(order_facts(lines, PASS), FACT_COLUMNS, FACT_KEYS, PASS, FACT_KEEP_FIRST)


def upsert_order_facts_second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled lines in a first pass, open lines upserted in a second."""
    lines, _ = _pass(spark, sf_dir, fulfilled=True)
    first = reduce_batch(order_facts(lines, PASS), FACT_COLUMNS, FACT_KEYS, PASS, FACT_KEEP_FIRST)
    lines, _ = _pass(spark, sf_dir, fulfilled=False)
    return upsert(first, order_facts(lines, PASS), FACT_KEYS, PASS, FACT_KEEP_FIRST)


def _told_apart(rows: DataFrame) -> DataFrame:
    """Attributes that differ between the rows of one key, so that it shows which row was taken."""
    if "supplierName" in rows.columns:
        return rows.withColumns({c: F.concat_ws(" ", c, "ProductID") for c in ("supplierName", "storeName")})
    return rows.withColumn("Gender", F.concat_ws(" ", "Gender", "Order_ID", "LineNumber", "LineStatus"))


def _load_dimension(name: str) -> Query:
    """Two passes, fulfilled lines and then open ones, into an empty dimension."""

    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, columns = DIMENSION_KEYS[name], STAR[name].names
        loaded = None
        for fulfilled in (True, False):
            lines, described = (_told_apart(x) for x in _pass(spark, sf_dir, fulfilled))
            rows, order = (lines, PASS) if name == "CustomerDimension" else (described, product_order(described))
            if loaded is None:
                loaded = reduce_batch(rows, columns, [key], order, keep_first=[c for c in columns if c != key])
            else:
                loaded = loaded.unionByName(insert_ignore(loaded, rows, key, order))
        return loaded

    return load


def report_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(fixtures.enriched(spark, sf_dir))


def _view(name: str) -> Query:
    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        views.create_views(fixtures.star(spark, sf_dir))
        return spark.table(name)

    return read_back


def refreshed_customer_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third view written to the shared folder and read from there."""
    path = work_dir(spark, "customer-store-sales")
    return views.refresh_customer_store_sales(spark, fixtures.star(spark, sf_dir), path)


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases stand in for transactions and views for master data."""
    events = fixtures.table(spark, sf_dir, "events").select("ts", "event_type")
    return events.filter(F.col("event_type") == "purchase"), events.filter(F.col("event_type") == "view")


def arrival_rate_per_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrival_rate(*_feeds(spark, sf_dir), "ts", HOUR)


def dual_arrival_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_ticks(*_feeds(spark, sf_dir), "ts", HOUR)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = fixtures.table(spark, sf_dir, name).schema
    return stream_files(spark, f"{sf_dir}/{name}.parquet*", schema, max_files=FILES_PER_PASS)


# Seconds that an event may come after others of later ticks.
LATE = 1800


def _all_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every file there is in one pass, so that no clock runs ahead of a file."""
    return stream_files(spark, path, schema)


def _appended(rows: DataFrame, name: str) -> DataFrame:
    """A streaming append run to the end of its input, and what the file sink holds then."""
    out = work_dir(rows.sparkSession, name)
    query = (
        rows.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{out}/rows")


def _event_streams(spark: SparkSession, sf_dir: str, every: bool) -> tuple[DataFrame, DataFrame]:
    """The events as a stream, and the clock that ran meanwhile."""
    events = fixtures.table(spark, sf_dir, "events")
    past, path = past_clock(events, "ts", HOUR, LATE, every), work_dir(spark, "clock")
    past.write.parquet(path)
    return _all_files(spark, f"{sf_dir}/events.parquet*", events.schema), _all_files(spark, path, past.schema)


def stream_arrival_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per hour of the events stream, hour by hour as they close."""
    events, clock = _event_streams(spark, sf_dir, every=False)
    return _appended(arrival_rate_stream({"arrivals": events}, clock, "ts", HOUR, LATE), "arrival-rate")


def stream_arrival_rate_per_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes in which neither, either or both of the feeds advanced, of two streams."""
    purchases, views = _feeds(spark, sf_dir)
    past, path = past_clock(purchases.unionByName(views), "ts", MINUTE, LATE), work_dir(spark, "clock")
    past.write.parquet(path)
    streams = {
        name: _all_files(spark, f"{sf_dir}/events.parquet*", fixtures.table(spark, sf_dir, "events").schema).filter(F.col("event_type") == kind)
        for name, kind in (("transaction_rate", "purchase"), ("master_rate", "view"))
    }
    return _appended(arrival_rate_stream(streams, _all_files(spark, path, past.schema), "ts", MINUTE, LATE), "rates")


def stream_dual_arrival_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours in which both feeds advanced, from a join of two streams."""
    events, clock = _event_streams(spark, sf_dir, every=False)
    feeds = [events.filter(F.col("event_type") == kind) for kind in ("purchase", "view")]
    return _appended(gated_tick_stream(*feeds, clock, "ts", HOUR, LATE), "dual-arrivals")


def stream_master_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master feed landed, streamed to its end by the file sink, and read back."""
    path, master = work_dir(spark, "master"), fixtures.master(spark, sf_dir)
    master.write.parquet(path)
    return _appended(stream_master(spark, path, master.schema, max_files=FILES_PER_PASS), "master-stream")


def _landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The transactions as CSV lines, those of every tenth order with a quantity in words, streamed into clean and rejected."""
    path, out = work_dir(spark, "csv"), work_dir(spark, "landed")
    tx = fixtures.transactions(spark, sf_dir).select(*TRANSACTIONS.names)
    spoilt = F.when(F.col("Order_ID") % 10 == 0, F.concat_ws(" ", F.lit("about"), "Quantity_Ordered")).otherwise(F.col("Quantity_Ordered").cast("string"))
    tx.withColumn("Quantity_Ordered", spoilt).write.option("header", True).csv(path)
    lines = stream_csv(spark, path, TRANSACTIONS.names, TRANSACTIONS, FILES_PER_PASS)
    land_csv(lines, out, {"availableNow": True}).awaitTermination()
    return out


def stream_csv_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean lines of a CSV feed, streamed."""
    return spark.read.schema(TRANSACTIONS).parquet(f"{_landed_csv(spark, sf_dir)}/clean/pass=*")


def stream_csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of the same feed per order, and what their last field was."""
    lines = spark.read.schema("line string").parquet(f"{_landed_csv(spark, sf_dir)}/rejected/pass=*")
    order, quantity = F.substring_index("line", ",", 1).cast("bigint"), F.substring_index("line", ",", -1)
    return lines.groupBy(order.alias("Order_ID"), quantity.alias("quantity")).agg(F.count("*").alias("n"))


def preview_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole master data to look at, without a limit."""
    return preview(fixtures.master(spark, sf_dir))


def _schemas_of(star: Star) -> dict:
    return {name: table.select(*STAR[name].names).schema for name, table in star.tables()}


SPLIT = 3


def _split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines landed again, dealt by hash, to be read in about as many passes as ``SPLIT``."""
    path, lines = work_dir(spark, "lines"), fixtures.table(spark, sf_dir, "lineitem")
    dealt = F.pmod(F.xxhash64(*lines.columns), F.lit(SPLIT))
    # A write per share: rows stay in the task that read them, and no task sorts a share.
    for share in range(SPLIT):
        lines.filter(dealt == share).write.parquet(f"{path}/dealt={share}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").count()
    return stream_files(spark, f"{path}/dealt=*/", lines.schema, max_files=-(-files // SPLIT))


def _stream_load(spark: SparkSession, sf_dir: str, split: bool = False) -> Warehouse:
    """Stream the order lines through the loader, run to the end of the files."""
    lines = _split_lines(spark, sf_dir) if split else _stream(spark, sf_dir, "lineitem")
    orders, customer = (fixtures.table(spark, sf_dir, n) for n in ("orders", "customer"))
    warehouse = Warehouse(spark, work_dir(spark, "warehouse"), _schemas_of(fixtures.star(spark, sf_dir)))
    query = run_load(
        warehouse,
        fixtures.transactions_of(lines, orders, customer),
        master=lambda: fixtures.master(spark, sf_dir),
        seq=SEQ,
        history=None,
        by_product=False,
        trigger={"availableNow": True},
        compact_every=2,
    )
    query.awaitTermination()
    return warehouse


def stream_load_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_load(spark, sf_dir).table("OrderFacts")


def stream_load_split_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of lines that arrived out of order in several passes, with a compaction between them."""
    return _stream_load(spark, sf_dir, split=True).table("OrderFacts")


def stream_load_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the four dimensions after a stream load and compaction."""
    warehouse = _stream_load(spark, sf_dir)
    warehouse.compact()

    def rows(table: DataFrame, dimension: str, key: str, name: str, detail: str | None = None) -> DataFrame:
        more = F.col(detail).cast("string") if detail else F.lit(None).cast("string")
        return table.select(F.lit(dimension).alias("dimension"), F.col(key).alias("id"), F.col(name).alias("name"), more.alias("detail"))

    star = warehouse.star()
    parts = [
        rows(star.supplier, "supplier", "supplierID", "supplierName"),
        rows(star.product, "product", "ProductID", "productName", "supplierID"),
        rows(star.customer, "customer", "CustomerID", "CustomerName", "Gender"),
        rows(star.store, "store", "storeID", "storeName"),
    ]
    return reduce(DataFrame.union, parts)


def stream_load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream load, compaction, and the rows of each table after it."""
    warehouse = _stream_load(spark, sf_dir)
    warehouse.compact()
    return row_counts(warehouse.star().tables())


SHARES = 4


def _load_in_steps(
    spark: SparkSession, sf_dir: str, steps: int, gated: bool, after: Callable[[Warehouse], None] | None = None, **options
) -> Warehouse:
    """Shares of the orders landed one after another, the loader started anew after each.

    With ``gated``, half of the master feed lands beside every other share.
    """
    root = work_dir(spark, "steps")
    lines, orders, customer = (fixtures.table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer"))
    master = fixtures.master(spark, sf_dir)
    warehouse = Warehouse(spark, f"{root}/warehouse", _schemas_of(fixtures.star(spark, sf_dir)))
    for step in range(steps):
        lines.filter(F.col("l_orderkey") % steps == step).write.parquet(f"{root}/lines/{step}", compression="zstd")
        if gated and step % 2 == 0:
            master.filter(F.col("productID") % 2 == step // 2 % 2).write.parquet(f"{root}/master/{step}")
        landed = stream_files(spark, f"{root}/lines/*", lines.schema)
        run_load(
            warehouse,
            # Lines of a share only meet orders of that share.
            fixtures.transactions_of(landed, orders.filter(F.col("o_orderkey") % steps == step), customer),
            master=lambda: fixtures.master(spark, sf_dir),
            seq=SEQ,
            history=None,
            trigger={"availableNow": True},
            compact_every=2,
            gate=stream_master(spark, f"{root}/master/*", master.schema) if gated else None,
            **options,
        ).awaitTermination()
        if after:
            after(warehouse)
    return warehouse


def gated_load_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four passes, the gate closed in the second and the last: the last share waits still."""
    return _load_in_steps(spark, sf_dir, SHARES, gated=True, by_product=False).table("OrderFacts")


def gated_load_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that wait for the gate after those passes, and their transactions."""
    waiting = _load_in_steps(spark, sf_dir, SHARES, gated=True, by_product=False).waiting()
    return waiting.groupBy("ProductID").agg(F.count("*").alias("transactions"))


def gated_load_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of those passes saw and did."""
    return _load_in_steps(spark, sf_dir, SHARES, gated=True, by_product=False).progress()


def stream_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three passes, each joining again all landed transactions of its products, product by product."""
    return _load_in_steps(spark, sf_dir, SPLIT, gated=False, landed=True).table("OrderFacts")


def incremental_customer_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third view brought up to date after each of three passes, the second one followed by a compaction."""
    path, kept = work_dir(spark, "incremental-sales"), []

    def refresh(warehouse: Warehouse) -> None:
        kept.append(CustomerStoreSales(warehouse, path).refresh())

    _load_in_steps(spark, sf_dir, SPLIT, gated=False, after=refresh, by_product=False)
    return kept[-1]


def incremental_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers with the most different products, from counts brought up to date after each of three passes."""
    path, views_ = work_dir(spark, "incremental-variety"), []

    def refresh(warehouse: Warehouse) -> None:
        views_.append(CustomerVariety(warehouse, path))
        views_[-1].refresh()

    _load_in_steps(spark, sf_dir, SPLIT, gated=False, after=refresh, by_product=False)
    return views_[-1].top(YEAR)


QUERIES: dict[str, Query] = {
    # Reports.
    "supplier_sales_drilldown": _olap(olap.supplier_sales_drilldown),
    "product_month_rollup": _olap(olap.product_month_rollup, supplier=SUPPLIER, year=YEAR),
    "product_month_grouping_sets": _olap(olap.product_month_grouping_sets, supplier=SUPPLIER, year=YEAR),
    "weekend_top_products": _olap(olap.weekend_top_products),
    "product_quarter_pivot": _olap(olap.product_quarter_pivot, year=YEAR),
    "sales_outlier_products": _olap(olap.sales_outlier_products, ratio=RATIO),
    "store_product_totals": _olap(olap.store_product_totals),
    "store_monthly_product_sales": _olap(olap.store_monthly_product_sales, store=STORE),
    "supplier_performance": _olap(olap.supplier_performance),
    "top_customers_by_variety": _olap(olap.top_customers_by_variety, year=YEAR),
    "customer_store_monthly_sales": _olap(olap.customer_store_monthly_sales),
    # The building blocks of the reports.
    "facts_with_sales": _facts(lambda star: with_sales(star.facts)),
    "facts_in_year": _facts(lambda star: in_year(star.facts, YEAR)),
    "weekend_facts": _facts(lambda star: weekend(star.facts)),
    "store_slice": _facts(lambda star: store_join(star.facts, slice_(star.store, "storeName", STORE), "CustomerID")),
    "supplier_year_dice": _facts(supplier_year_dice),
    "monthly_aggregates": _facts(monthly_aggregates),
    "facts_with_product": _facts(lambda star: star_join(star.facts, star.product, "product")),
    "products_with_supplier": _facts(lambda star: star_join(star.product, star.supplier, "supplier")),
    "facts_with_customer": _facts(lambda star: star_join(star.facts, star.customer, "customer")),
    "products_with_store": _facts(lambda star: store_join(star.product, star.store, "supplierID")),
    # Views.
    "store_analysis_view": _view(views.STORE_ANALYSIS),
    "supplier_performance_view": _view(views.SUPPLIER_PERFORMANCE),
    "customer_store_sales_view": _view(views.CUSTOMER_STORE_SALES),
    "refreshed_customer_store_sales": refreshed_customer_store_sales,
    "incremental_customer_store_sales": incremental_customer_store_sales,
    "incremental_top_customers": incremental_top_customers,
    # Feeds.
    "scan_transactions": scan_transactions,
    "scan_master": scan_master,
    "csv_transactions": _csv(fixtures.transactions, TRANSACTIONS),
    "csv_master_reordered": _csv(fixtures.master, MASTER, sorted(MASTER.names)),
    "preview_master": preview_master,
    "conform_transactions": conform_transactions,
    "table_row_counts": table_row_counts,
    # Joins.
    "enrich_transactions": enrich_transactions,
    "refresh_pending_products": refresh_pending_products,
    "pending_product_keys": pending_product_keys,
    "orphan_products": orphan_products,
    "orphan_products_by_store": orphan_products_by_store,
    "unmatched_transactions": unmatched_transactions,
    "unmatched_stocked_transactions": unmatched_stocked_transactions,
    # Loads.
    "upsert_order_facts": upsert_order_facts,
    "upsert_order_facts_second_pass": upsert_order_facts_second_pass,
    "load_supplier_dim": _load_dimension("SupplierDimension"),
    "load_product_dim": _load_dimension("ProductDimension"),
    "load_customer_dim": _load_dimension("CustomerDimension"),
    "load_store_dim": _load_dimension("StoreDimension"),
    "load_report": report_load,
    # Streams.
    "arrival_rate_per_tick": arrival_rate_per_tick,
    "dual_arrival_ticks": dual_arrival_ticks,
    "stream_arrival_rate": stream_arrival_rate,
    "stream_arrival_rate_per_tick": stream_arrival_rate_per_tick,
    "stream_dual_arrival_ticks": stream_dual_arrival_ticks,
    "stream_master_feed": stream_master_feed,
    "stream_csv_transactions": stream_csv_transactions,
    "stream_csv_rejected": stream_csv_rejected,
    "stream_load_order_facts": stream_load_order_facts,
    "stream_load_split_order_facts": stream_load_split_order_facts,
    "stream_load_dimensions": stream_load_dimensions,
    "stream_load_row_counts": stream_load_row_counts,
    "stream_load_history": stream_load_history,
    "gated_load_order_facts": gated_load_order_facts,
    "gated_load_waiting": gated_load_waiting,
    "gated_load_progress": gated_load_progress,
}
