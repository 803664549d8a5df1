"""Load operators on hand-computed tables, and their properties."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType

from martloom.operators.joins import enrich, orphans, refresh_keys, unmatched
from martloom.operators.load import (
    FIRST_SEEN,
    insert_ignore,
    known_lines,
    listings,
    load_report,
    order_facts,
    pass_lines,
    priced_facts,
    product_order,
    products_seen,
    ranked_products,
    reduce_batch,
    unknown_products,
    unpriced_facts,
    upsert,
)
from martloom.schemas import FACT_KEEP_FIRST, FACT_KEYS, PRICE, STAR
from martloom.streaming.loader import pending_keys
from tables import at, master_table, rows_of, tx_table

KV = "k int, p int, v int, s int"


def kv(spark, rows, schema=KV):
    return spark.createDataFrame(rows, schema)


def kv_upsert(target, batch):
    return upsert(target, batch, ["k"], ["s"], ["p"])


def test_upsert_new_key_takes_first_product_and_last_value(spark):
    target = kv(spark, [], "k int, p int, v int")
    batch = kv(spark, [(1, 10, 100, 1), (1, 20, 200, 2), (2, 30, 300, 3)])
    assert rows_of(kv_upsert(target, batch)) == [(1, 10, 200), (2, 30, 300)]


def test_upsert_present_key_keeps_its_product(spark):
    target = kv(spark, [(1, 5, 50), (9, 9, 90)], "k int, p int, v int")
    batch = kv(spark, [(1, 20, 200, 2), (1, 10, 100, 1)])
    assert rows_of(kv_upsert(target, batch)) == [(1, 5, 200), (9, 9, 90)]


def test_upsert_null_of_the_winning_row_stays(spark):
    target = kv(spark, [(1, None, 50)], "k int, p int, v int")
    batch = kv(spark, [(1, 10, 100, 1), (1, 20, None, 2), (2, None, 1, 3), (2, 7, 2, 4)])
    assert rows_of(kv_upsert(target, batch)) == [(1, None, None), (2, None, 2)]


def test_upsert_leaves_out_null_keys(spark):
    target = kv(spark, [(1, 5, 50)], "k int, p int, v int")
    assert rows_of(kv_upsert(target, kv(spark, [(None, 1, 2, 3)]))) == [(1, 5, 50)]


def test_upsert_orders_by_several_columns(spark):
    target = kv(spark, [], "k int, p int, v int")
    batch = kv(spark, [(1, 10, 100, 1), (1, 20, 200, 1), (1, 30, 300, 0)])
    assert rows_of(upsert(target, batch, ["k"], ["s", "p"], ["p"])) == [(1, 30, 200)]


def test_upsert_without_kept_columns_replaces(spark):
    target = kv(spark, [(1, 5, 50), (2, 6, 60)], "k int, p int, v int")
    batch = kv(spark, [(1, 10, 100, 1)])
    assert rows_of(upsert(target, batch, ["k"], ["s"])) == [(1, 10, 100), (2, 6, 60)]


def _model(target, batch):
    state = {k: (p, v) for k, p, v in target}
    for k, p, v, _ in sorted(batch, key=lambda r: r[3]):
        state[k] = (state[k][0] if k in state else p, v)
    return sorted((k, p, v) for k, (p, v) in state.items())


VALUE = st.integers(0, 9)
BATCH = st.lists(st.tuples(st.integers(0, 4), VALUE, VALUE), max_size=12).map(
    lambda rows: [(*r, i) for i, r in enumerate(rows)]
)
TARGET = st.dictionaries(st.integers(0, 6), st.tuples(VALUE, VALUE), max_size=5).map(
    lambda d: [(k, p, v) for k, (p, v) in d.items()]
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(TARGET, BATCH, st.integers(0, 12))
def test_upsert_properties(spark, target, batch, cut):
    t, b = kv(spark, target, "k int, p int, v int"), kv(spark, batch)
    once = kv_upsert(t, b)
    want = _model(target, batch)
    assert rows_of(once) == want
    assert rows_of(kv_upsert(once, b)) == want
    split = kv_upsert(kv_upsert(t, kv(spark, batch[:cut])), kv(spark, batch[cut:]))
    assert rows_of(split) == want


DIM = "supplierID int, supplierName string"


def test_insert_ignore_appends_only_absent_keys(spark):
    target = spark.createDataFrame([(1, "old")], DIM)
    batch = spark.createDataFrame(
        [(1, "new", 1), (2, "late", 5), (2, "early", 2), (None, "none", 3), (3, None, 4)], f"{DIM}, seq int"
    )
    assert rows_of(insert_ignore(target, batch, "supplierID", ["seq"])) == [(2, "early"), (3, None)]


def test_insert_ignore_replay_adds_nothing(spark):
    target = spark.createDataFrame([], DIM)
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], f"{DIM}, seq int")
    new = insert_ignore(target, batch, "supplierID", ["seq"])
    assert rows_of(insert_ignore(target.unionByName(new), batch, "supplierID", ["seq"])) == []


TX_ROWS = [
    # order, day, product, customer, quantity, seq
    (1, 1, 10, 7, 1, 1),
    (2, 1, 20, 8, 2, 2),
    (1, 2, 20, 7, 3, 3),
    (3, 3, 99, 9, 4, 4),
    (4, 3, None, 9, 5, 5),
    (2, 4, 10, 8, 6, 6),
]
MASTER_ROWS = [(10, "1.25", 100, 1000), (20, "2.50", 200, 2000), (30, "3.00", None, None)]


def test_enrich_and_unmatched_split_the_input(spark):
    tx, master = tx_table(spark, TX_ROWS), master_table(spark, MASTER_ROWS)
    assert sorted(r.seq for r in enrich(tx, master).collect()) == [1, 2, 3, 6]
    assert sorted(r.seq for r in unmatched(tx, master).collect()) == [4, 5]


def test_enrich_multiplies_on_a_duplicate_master_key(spark):
    tx, master = tx_table(spark, TX_ROWS[:1]), master_table(spark, [(10, "1.00", 1, 1), (10, "2.00", 2, 2)])
    assert sorted(str(r.productPrice) for r in enrich(tx, master).collect()) == ["1.00", "2.00"]


def test_refresh_keys_rejoins_history(spark):
    tx, master = tx_table(spark, TX_ROWS), master_table(spark, MASTER_ROWS)
    keys = spark.createDataFrame([(10,), (10,), (99,)], "ProductID int")
    assert sorted(r.seq for r in refresh_keys(tx, master, keys).collect()) == [1, 6]


def test_orphans_ignore_null_foreign_keys(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "ProductID int, supplierID int")
    parent = spark.createDataFrame([(5,)], "supplierID int")
    assert [r.ProductID for r in orphans(child, parent, "supplierID", "supplierID").collect()] == [2]


def test_pending_keys_are_distinct_and_set(spark):
    assert rows_of(pending_keys(tx_table(spark, TX_ROWS))) == [(10,), (20,), (99,)]


def _pass(spark, tx_rows, master_rows):
    tx, master = tx_table(spark, tx_rows), master_table(spark, master_rows)
    described = enrich(products_seen(tx, ["seq"]), master)
    return pass_lines(tx, described), described


def test_pass_loads_product_by_product(spark):
    lines, _ = _pass(spark, TX_ROWS, MASTER_ROWS)
    order = [FIRST_SEEN, "seq"]
    facts = reduce_batch(order_facts(lines, order), STAR["OrderFacts"].names, FACT_KEYS, order, FACT_KEEP_FIRST)
    # Product 10 (first seen at 1) is visited before 20 (first seen at 2), so
    # order 2 keeps product 10 and ends with its product-20 row.
    assert rows_of(facts) == [
        (1, dt.date(2019, 1, 2), 10, 7, 3, Decimal("2.50")),
        (2, dt.date(2019, 1, 1), 10, 8, 2, Decimal("2.50")),
    ]


def test_dimensions_come_from_the_products_of_the_pass(spark):
    _, described = _pass(spark, TX_ROWS, MASTER_ROWS)
    empty = spark.createDataFrame([], STAR["SupplierDimension"])
    loaded = insert_ignore(empty, described, "supplierID", product_order(described))
    assert rows_of(loaded) == [(100, "s100"), (200, "s200")]


def test_a_product_listed_twice_loads_the_same_way_every_time(spark):
    rows = [(10, "2.00", 2, 2), (10, "1.00", 1, 1)]
    for master_rows in (rows, rows[::-1]):
        lines, described = _pass(spark, TX_ROWS[:1], master_rows)
        empty = spark.createDataFrame([], STAR["ProductDimension"])
        assert rows_of(insert_ignore(empty, described, "ProductID", product_order(described))) == [(10, "p10", 1)]
        assert lines.count() == 2


def test_facts_lose_the_time_of_day(spark):
    assert order_facts(enrich(tx_table(spark, TX_ROWS), master_table(spark, MASTER_ROWS))).schema[
        "OrderDate"
    ].dataType == STAR["OrderFacts"]["OrderDate"].dataType
    assert at(1).hour == 9


def test_load_report_counts_rows_and_orders(spark):
    joined = enrich(tx_table(spark, TX_ROWS), master_table(spark, MASTER_ROWS))
    assert rows_of(load_report(joined)) == [(4, 2)]


def test_prices_looked_up_once_an_order_give_the_facts_of_all_priced_lines(spark):
    seq = ["seq", "ProductID"]
    rng = random.Random(7)
    rows = [(rng.choice([1, 2, 3, 4, None]), 1 + n % 9, rng.choice([10, 20, 30, 99, None]), n % 3, n, n) for n in range(60)]
    tx = tx_table(spark, rows)
    # Product 20 is listed twice, 99 never.
    master = master_table(spark, [(10, "1.00", 1, 1), (20, "2.00", 1, 1), (20, "9.00", 2, 1), (30, "3.00", None, None)])
    seen = products_seen(tx, seq)
    described = enrich(seen, master)
    order = [*seq, "productPrice"]
    columns, span = STAR["OrderFacts"].names, ("_earliest", "_latest")
    want = reduce_batch(
        order_facts(pass_lines(tx, described), order), columns, FACT_KEYS, order, FACT_KEEP_FIRST, rows="_rows", span=span
    )
    unknown = unknown_products(seen, described)
    assert rows_of(unknown) == [(99,)]
    for few in (unknown, None):
        known = known_lines(tx, described, few)
        assert rows_of(known) == rows_of(tx.filter("ProductID IN (10, 20, 30)"))
        bare = unpriced_facts(known, PRICE, columns, FACT_KEYS, seq, FACT_KEEP_FIRST, "_rows", span)
        for small in (True, False):
            got = priced_facts(bare, listings(described), span, small)
            assert rows_of(got.select(*columns, "_latest")) == rows_of(want.select(*columns, "_latest"))


def test_prices_are_looked_up_by_order_numbers_alone(spark):
    tx = tx_table(spark, [(n % 20, 1, n % 5, 1, 1, n) for n in range(50)])
    described = enrich(products_seen(tx, ["seq"]), master_table(spark, [(p, "1.00", 1, 1) for p in range(5)]))
    columns, span = STAR["OrderFacts"].names, ("_earliest", "_latest")
    bare = unpriced_facts(tx, PRICE, columns, FACT_KEYS, ["seq"], FACT_KEEP_FIRST, "_rows", span).persist()
    got = priced_facts(bare, listings(described), span, small=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    bare.unpersist()
    assert re.search(r"InMemoryTableScan \[OrderID#\d+L, _priced#\d+L\]", plan)


def test_known_lines_stay_where_they_are(spark):
    tx = tx_table(spark, [(n, 1, n % 5, 1, 1, n) for n in range(50)])
    seen = products_seen(tx, ["seq"])
    described = enrich(seen, master_table(spark, [(p, "1.00", 1, 1) for p in range(4)]))
    lines = known_lines(tx, described, unknown_products(seen, described).localCheckpoint())
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_ranks_order_products_as_their_first_transaction_does(spark):
    rng = random.Random(3)
    tx = tx_table(spark, [(n, 1, rng.randrange(40), 1, 1, 1000 - n) for n in range(300)]).repartition(5)
    seen = products_seen(tx, ["Order_ID", "seq"])
    ranked = ranked_products(seen)
    assert ranked.schema[FIRST_SEEN].dataType == LongType()
    by_rank = [r[0] for r in ranked.sort(FIRST_SEEN).collect()]
    assert by_rank == [r[0] for r in seen.sort(FIRST_SEEN).collect()]
    assert len({r[1] for r in ranked.collect()}) == len(by_rank)
