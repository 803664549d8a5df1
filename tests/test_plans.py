"""Physical plans: what reaches the scan, what is shuffled, what happens to a hot key."""

from __future__ import annotations

import datetime as dt
import re
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.catalogue import QUERIES
from martloom.operators.joins import SALT, enrich, hot_keys, salted_join
from martloom.operators.load import upsert
from martloom.operators.sizing import broadcast_if_small, broadcast_limit, fits_broadcast, measured_bytes
from martloom.plans import olap
from martloom.schemas import Star
from tables import master_table, rows_of, star_of, tx_table

SF = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.startswith(("stream_", "gated_", "incremental_", "refreshed_"))}


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Rows and the plan adaptive execution ended with."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


no_broadcast = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_query_needs_a_cross_join_window_or_python(spark, name):
    with settings(spark, **no_broadcast):
        text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "Window [", "Python", "Pandas", "BroadcastExchange"):
        assert word not in text, word
    # One partition only ever takes partial aggregates: scalar counts and bounds.
    for match in re.finditer(r"Exchange SinglePartition.*\n(.*)", text):
        assert "HashAggregate(keys=[]" in match.group(1)


def test_year_filter_and_columns_reach_the_scan(spark):
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        text = plan(QUERIES["product_quarter_pivot"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_top_k_is_taken_per_partition(spark):
    for name in ("weekend_top_products", "top_customers_by_variety"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_upsert_of_a_small_batch_leaves_the_target_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", (F.col("id") * 2).alias("v"), F.col("id").alias("w")).write.parquet(path)
    target = spark.read.parquet(path)
    spark.createDataFrame([(1, 5, 6, 7)], "id long, v long, w long, s long").write.parquet(f"{path}-batch")
    batch = spark.read.parquet(f"{path}-batch")
    result = upsert(target, batch, ["id"], ["s"])
    assert "BroadcastHashJoin" in plan(result) and "SortMergeJoin" not in plan(result)
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        filtered = plan(result.filter("v > 100").select("id", "v"))
    scan = filtered[: filtered.index("BroadcastExchange")]
    assert "GreaterThan(v,100)" in scan and "ReadSchema: struct<id:bigint,v:bigint>" in scan


def test_measured_broadcast(spark):
    small = master_table(spark, [(1, "1.00", 2, 3)])
    assert measured_bytes(small) == 8 + 8 * 7 + 6
    assert fits_broadcast(small) and broadcast_limit(small) == 10 * 1024 * 1024
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="64b"):
        assert broadcast_limit(small) == 64 and not fits_broadcast(small)
        assert "BroadcastHashJoin" not in plan(tx_table(spark, []).join(broadcast_if_small(small), "ProductID"))
    with settings(spark, **no_broadcast):
        assert not fits_broadcast(small)
    nothing = small.limit(0)
    assert measured_bytes(nothing) == 0


skewed = {
    **no_broadcast,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20kb",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """60,000 fact rows, a third of them on one product."""
    path = str(tmp_path_factory.mktemp("hot") / "facts")
    i = F.col("id")
    (
        spark.range(0, 60_000, 1, 8)
        .select(
            i.cast("int").alias("OrderID"),
            F.date_add(F.lit(dt.date(2019, 1, 1)), (i % 365).cast("int")).alias("OrderDate"),
            F.when(i % 3 == 0, 0).otherwise(i % 997).cast("int").alias("ProductID"),
            (i % 1009).cast("int").alias("CustomerID"),
            (i % 7).cast("int").alias("QuantityOrdered"),
            F.lit(Decimal("1.01")).cast("decimal(10,2)").alias("productPrice"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def hot_star(spark, hot):
    products = [(p, f"p{p}", p % 50) for p in range(997)]
    base = star_of(spark, [], products, [(c, f"c{c}", "f") for c in range(1009)], [(s, f"s{s}") for s in range(50)])
    return Star(hot, base.product, base.customer, base.supplier, base.store)


def test_a_hot_product_is_split_in_a_join(spark, hot):
    master = master_table(spark, [(p, "1.00", p % 50, 1) for p in range(997)])
    with settings(spark, **skewed):
        joined = enrich(hot.drop("productPrice"), master)
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
        grouped = joined.groupBy("ProductID").agg(F.sum("QuantityOrdered").alias("q"))
        assert "SortMergeJoin(skew=true)" in final_plan(grouped)


def partition_rows(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_salted_join_deals_out_a_hot_key(spark, hot, how):
    keys = spark.range(1, 997, 2).union(spark.createDataFrame([(0,), (0,)], "id long"))
    known = keys.select(F.col("id").cast("int").alias("ProductID")).distinct()
    if how == "left_anti":
        known = known.filter("ProductID > 0")
    tx = hot.withColumn("ProductID", F.when(F.col("ProductID") == 500, None).otherwise(F.col("ProductID")))
    with settings(spark, **no_broadcast, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32"):
        dealt = salted_join(tx, known, "ProductID", how)
        assert "SortMergeJoin" in plan(dealt)
        # The hot product has 20,000 of 60,000 rows.
        assert max(partition_rows(dealt)) < 8_000
        got = rows_of(dealt)
    assert got == rows_of(tx.join(known, "ProductID", how))
    assert len(got) > 20_000


def test_only_hot_keys_are_salted_and_copied(spark, hot, monkeypatch):
    tx = hot.withColumn("ProductID", F.when(F.col("ProductID") == 500, None).otherwise(F.col("ProductID")))
    found, nulls = hot_keys(tx, "ProductID", 32)
    # A third of the rows is some eleven of 32 shares; no other key has two shares.
    assert [(r.ProductID, r._salts) for r in found.collect()] == [(0, 11)] and nulls == 1
    assert hot_keys(tx.filter("ProductID IS NULL OR ProductID > 990"), "ProductID", 4)[1] >= 1
    assert hot_keys(tx.limit(0), "ProductID", 4)[0].collect() == []
    known = spark.range(997).select(F.col("id").cast("int").alias("ProductID"))
    with settings(spark, **no_broadcast, spark__sql__shuffle__partitions="32", spark__sql__adaptive__enabled="false"):
        salted = salted_join(tx, known, "ProductID")
        made, drop = [], type(salted).drop
        monkeypatch.setattr(type(salted), "drop", lambda self, *c: made.append(self) or drop(self, *c))
        salted_join(tx, known, "ProductID")
        copied = next(df for df in made if set(df.columns) == {"ProductID", "_salts", SALT})
        assert {r.ProductID: r["count"] for r in copied.groupBy("ProductID").count().filter("count > 1").collect()} == {0: 11}
        assert copied.count() == 997 + 10


def test_monthly_sales_split_a_hot_product(spark, hot):
    star = hot_star(spark, hot)
    with settings(spark, **skewed):
        report = olap.supplier_performance(star)
        assert "SortMergeJoin(skew=true)" in final_plan(report)
        split = rows_of(report)
    assert split == rows_of(olap.supplier_performance(star))


@pytest.mark.parametrize("report", [olap.product_quarter_pivot, olap.sales_outlier_products, olap.weekend_top_products])
def test_product_reports_fold_before_they_shuffle(spark, hot, report):
    star = hot_star(spark, hot)
    with settings(spark, **skewed):
        text = plan(report(star))
    scan = text.index("FileScan parquet [", text.rindex("SortMergeJoin"))
    below_join = text[text.rindex("SortMergeJoin") : scan]
    assert re.search(r"Exchange hashpartitioning\(ProductID.*\n.*HashAggregate\(keys=\[ProductID", below_join)
