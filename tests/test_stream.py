"""Streams: rates, gate, load, restart, compaction."""

from __future__ import annotations

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.joins import enrich
from martloom.operators.load import FIRST_SEEN, order_facts, pass_lines, products_seen, reduce_batch
from martloom.schemas import FACT_KEEP_FIRST, FACT_KEYS, MASTER, STAR, TRANSACTIONS
from martloom.sources.warehouse import Warehouse
from martloom.streaming.feeds import land_csv, stream_csv, stream_master, stream_transactions
from martloom.streaming.loader import ArrivalLog, load_pass, run_load
from martloom.streaming.rates import TICKS_PER_BLOCK, arrival_rate, arrival_rate_stream, gated_tick_stream, gated_ticks, past_clock
from tables import TX, master_table, rows_of, tx_table

MASTER_ROWS = [(10, "1.25", 100, 1000), (20, "2.50", 200, 2000), (30, "3.00", None, None)]
FILES = [
    [(1, 1, 10, 7, 1, 1), (2, 1, 20, 8, 2, 2)],
    [(1, 2, 20, 7, 3, 3), (3, 3, 99, 9, 4, 4), (4, 3, None, 9, 5, 5)],
    [(2, 4, 10, 8, 6, 6), (5, 5, 30, None, 7, 7), (1, 6, 10, 6, 8, 8)],
]
SEQ = ["seq"]
ONCE = {"availableNow": True}


def times(spark, *seconds):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(seconds=s),) for s in seconds], "ts timestamp")


def test_arrival_rate_shows_quiet_ticks(spark):
    got = arrival_rate(times(spark, 0, 1, 9), times(spark, 31), "ts", 10)
    assert [(r.tick.second, r.transaction_rate, r.master_rate) for r in got.orderBy("tick").collect()] == [
        (0, 3, 0),
        (10, 0, 0),
        (20, 0, 0),
        (30, 0, 1),
    ]


def test_arrival_rate_over_many_blocks(spark):
    far = TICKS_PER_BLOCK * 3 + 17
    got = arrival_rate(times(spark, 0, far), times(spark, 5), "ts", 1)
    assert got.count() == far + 1 == got.select("tick").distinct().count()
    assert got.filter("transaction_rate + master_rate > 0").count() == 3


def test_arrival_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    assert arrival_rate(empty, empty, "ts", 1).count() == 0


def test_gate_opens_only_when_both_feeds_advance(spark):
    got = gated_ticks(times(spark, 0, 1, 25), times(spark, 2, 15), "ts", 10)
    assert [(r.tick.second, r.transaction_rate, r.master_rate) for r in got.collect()] == [(0, 2, 1)]


@pytest.fixture
def landed(spark, tmp_path):
    """Transactions landed as one file per batch, in arrival order."""
    path = tmp_path / "tx"

    def add(*numbers):
        for n in numbers:
            tx_table(spark, FILES[n]).coalesce(1).write.mode("append").parquet(str(path))
        return str(path)

    return add


def load(spark, path, root, history=False, by_product=True, master_rows=MASTER_ROWS):
    reports = []
    warehouse = Warehouse(spark, str(root))
    run_load(
        warehouse,
        stream_transactions(spark, path, TX, max_files=1),
        master=lambda: master_table(spark, master_rows),
        seq=SEQ,
        history=(lambda: spark.read.schema(TX).parquet(path)) if history else None,
        by_product=by_product,
        trigger=ONCE,
        report=lambda batch_id, counts: reports.append((batch_id, counts["joined_rows"], counts["distinct_orders"])),
    ).awaitTermination()
    return warehouse, reports


def batch_facts(spark, rows, order):
    tx, master = tx_table(spark, rows), master_table(spark, MASTER_ROWS)
    lines = pass_lines(tx, enrich(products_seen(tx, SEQ), master))
    return reduce_batch(order_facts(lines, order), STAR["OrderFacts"].names, FACT_KEYS, order, FACT_KEEP_FIRST)


ALL = [row for file in FILES for row in file]


def tables_of(warehouse):
    return {name: rows_of(table) for name, table in warehouse.star().tables()}


def test_stream_in_arrival_order_equals_one_batch(spark, landed, tmp_path):
    warehouse, reports = load(spark, landed(0, 1, 2), tmp_path / "dw", by_product=False)
    got = tables_of(warehouse)
    assert got["OrderFacts"] == rows_of(batch_facts(spark, ALL, SEQ))
    assert got["OrderFacts"] == [
        (1, dt.date(2019, 1, 6), 10, 6, 8, Decimal("1.25")),
        (2, dt.date(2019, 1, 4), 20, 8, 6, Decimal("1.25")),
        (5, dt.date(2019, 1, 5), 30, None, 7, Decimal("3.00")),
    ]
    assert got["ProductDimension"] == [(10, "p10", 100), (20, "p20", 200), (30, "p30", None)]
    assert got["SupplierDimension"] == [(100, "s100"), (200, "s200")]
    assert got["StoreDimension"] == [(1000, "t1000"), (2000, "t2000")]
    assert got["CustomerDimension"] == [(6, "c6", "f"), (7, "c7", "f"), (8, "c8", "f")]
    assert [r[0] for r in reports] == [0, 1, 2] and sum(r[1] for r in reports) == 6


def test_one_pass_by_product_equals_the_batch_operator(spark, tmp_path):
    tx_table(spark, ALL).coalesce(1).write.parquet(str(tmp_path / "tx"))
    warehouse, reports = load(spark, str(tmp_path / "tx"), tmp_path / "dw")
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(batch_facts(spark, ALL, [FIRST_SEEN, *SEQ]))
    assert reports == [(0, 6, 3)]


def test_history_is_joined_again_at_todays_price(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    old, new = tx_table(spark, [(1, 1, 10, 7, 1, 1), (2, 1, 20, 8, 1, 2)]), tx_table(spark, [(3, 2, 10, 9, 1, 3)])
    load_pass(warehouse, old, 0, master_table(spark, MASTER_ROWS), SEQ)
    dearer = master_table(spark, [(10, "9.99", 100, 1000), (20, "9.99", 200, 2000)])
    counts = load_pass(warehouse, new, 1, dearer, SEQ, history=old.unionByName(new))
    assert counts == {"joined_rows": 2, "distinct_orders": 2}
    assert [(r.OrderID, str(r.productPrice)) for r in warehouse.table("OrderFacts").orderBy("OrderID").collect()] == [
        (1, "9.99"),
        (2, "2.50"),
        (3, "9.99"),
    ]


def test_streamed_history(spark, landed, tmp_path):
    warehouse, reports = load(spark, landed(0, 1, 2), tmp_path / "dw", history=True)
    assert sorted(r.OrderID for r in warehouse.table("OrderFacts").collect()) == [1, 2, 5]
    assert [r[0] for r in reports] == [0, 1, 2]


def test_restart_continues_and_replay_changes_nothing(spark, landed, tmp_path):
    path, root = landed(0), tmp_path / "dw"
    load(spark, path, root, by_product=False)
    landed(1, 2)
    warehouse, reports = load(spark, path, root, by_product=False)
    assert [r[0] for r in reports] == [1, 2]
    once = tables_of(warehouse)
    _, reports = load(spark, path, root, by_product=False)
    assert reports == [] and tables_of(warehouse) == once
    # A pass that is run again replaces its own folders.
    load_pass(warehouse, tx_table(spark, FILES[2]), 2, master_table(spark, MASTER_ROWS), SEQ, by_product=False)
    assert tables_of(warehouse) == once


def test_compaction_keeps_the_tables_and_later_passes_build_on_it(spark, landed, tmp_path):
    path, root = landed(0, 1), tmp_path / "dw"
    warehouse, _ = load(spark, path, root, by_product=False)
    assert Warehouse(spark, str(tmp_path / "empty")).compact() == -1
    before = tables_of(warehouse)
    assert warehouse.compact() == 1
    assert warehouse.compact() == 1
    assert tables_of(warehouse) == before
    landed(2)
    load(spark, path, root, by_product=False)
    assert tables_of(warehouse)["OrderFacts"] == rows_of(batch_facts(spark, ALL, SEQ))
    assert warehouse.compact() == 2
    assert warehouse.state()["tables"]["OrderFacts"]["log"] == []
    assert tables_of(warehouse)["OrderFacts"] == rows_of(batch_facts(spark, ALL, SEQ))


def dealt(spark, path, rows, files, seed):
    """The rows at random over so many files, as they would come from several sources."""
    rng = random.Random(seed)
    piles = [[] for _ in range(files)]
    for row in rows:
        rng.choice(piles).append(row)
    for pile in piles:
        tx_table(spark, pile).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("compact_every", [1, 2, 20])
def test_facts_do_not_depend_on_the_cut_into_passes(spark, tmp_path, compact_every):
    rng = random.Random(9)
    rows = [
        (rng.randint(1, 25), rng.randint(1, 28), rng.choice([10, 20, 30]), rng.randint(1, 9), rng.randint(1, 9), seq)
        for seq in range(120)
    ]
    dealt(spark, str(tmp_path / "tx"), rows, 5, compact_every)
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    run_load(
        warehouse, stream_transactions(spark, str(tmp_path / "tx"), TX, max_files=1),
        master=lambda: master_table(spark, MASTER_ROWS), seq=SEQ, history=None, by_product=False, trigger=ONCE, compact_every=compact_every,
    ).awaitTermination()
    assert warehouse.passes()[-1] == 4
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(batch_facts(spark, rows, SEQ))


def test_passes_count_without_marker_files_and_data_without_manifest_is_refused(spark, landed, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        warehouse, _ = load(spark, landed(0, 1, 2), tmp_path / "dw", by_product=False)
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(batch_facts(spark, ALL, SEQ))
    assert warehouse.table("SupplierDimension").count() == 2
    # Rows of a pass that did not finish are in no manifest.
    tx_table(spark, FILES[0]).write.parquet(str(tmp_path / "dw/OrderFacts/log/3-unfinished"))
    assert warehouse.table("OrderFacts").count() == 3
    for manifest in (tmp_path / "dw/_manifests").iterdir():
        manifest.rename(tmp_path / manifest.name)
    with pytest.raises(RuntimeError, match="no manifest"):
        warehouse.table("OrderFacts")
    assert Warehouse(spark, str(tmp_path / "none")).table("OrderFacts").count() == 0


def test_looking_stays_constant_and_old_folders_go(spark, tmp_path, monkeypatch):
    from martloom.sources import paths

    calls, locate = [], paths._locate
    monkeypatch.setattr(paths, "_locate", lambda *a: calls.append(a) or locate(*a))
    warehouse, counts = Warehouse(spark, str(tmp_path / "dw"), grace=3), []
    for n in range(14):
        del calls[:]
        rows = tx_table(spark, [(n % 4, 1 + n, 10, 7, n + 1, n)])
        load_pass(warehouse, rows, n, master_table(spark, MASTER_ROWS), SEQ, by_product=False)
        counts.append(len(calls))
        if n % 3 == 2:
            warehouse.compact()
    assert max(counts[7:]) <= max(counts[:7]) + 2
    assert len(warehouse.passes()) <= 5 and len(list((tmp_path / "dw/OrderFacts/log").iterdir())) <= 8
    assert len(warehouse.state()["tables"]["OrderFacts"]["log"]) <= 3
    assert sorted((r.OrderID, r.QuantityOrdered) for r in warehouse.table("OrderFacts").collect()) == [(0, 13), (1, 14), (2, 11), (3, 12)]


def test_compaction_reads_and_rewrites_touched_years_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))

    def pass_of(number, orders):
        rows = [(dt.datetime(year, 2, 3), order, 10, 7, order, order) for order, year in orders]
        tx = spark.createDataFrame([(o, d, p, c, "c", "f", q, s) for d, o, p, c, q, s in rows], TX)
        load_pass(warehouse, tx, number, master_table(spark, MASTER_ROWS), SEQ)
        return warehouse.state()

    pass_of(0, [(1, 2017), (2, 2018), (3, 2019)])
    warehouse.compact()
    old = warehouse.state()["tables"]["OrderFacts"]["parts"]
    years, merged = warehouse.touched_years(pass_of(1, [(2, 2020)]))
    files = " ".join(merged.inputFiles())
    assert years == ["2018"] and "OrderYear=2018" in files and "OrderYear=2017" not in files and "OrderYear=2019" not in files
    warehouse.compact()
    new = warehouse.state()["tables"]["OrderFacts"]["parts"]
    assert {y: new[y] == old[y] for y in ("2017", "2019")} == {"2017": True, "2019": True} and set(new) == {"2017", "2019", "2020"}
    assert sorted((r.OrderID, r.OrderDate.year) for r in warehouse.table("OrderFacts").collect()) == [(1, 2017), (2, 2020), (3, 2019)]


def test_a_pass_reads_its_inputs_once(spark, tmp_path):
    batch, history = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(df, counter):
        def count(rows):
            for part in rows:
                counter.add(part.num_rows)
                yield part

        return df.mapInArrow(count, df.schema)

    rows = tx_table(spark, ALL)
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    load_pass(warehouse, counted(rows, batch), 0, master_table(spark, MASTER_ROWS), SEQ)
    assert batch.value == len(ALL)
    load_pass(warehouse, tx_table(spark, FILES[1]), 1, master_table(spark, MASTER_ROWS), SEQ, history=counted(rows, history))
    assert history.value == len(ALL)


def test_log_without_checkpoint_is_refused(spark, landed, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    load_pass(warehouse, tx_table(spark, FILES[0]), 0, master_table(spark, MASTER_ROWS), SEQ)
    with pytest.raises(RuntimeError, match="no checkpoint"):
        load(spark, landed(0), tmp_path / "dw")


def test_checkpoint_without_log_is_refused(spark, landed, tmp_path):
    commits = tmp_path / "dw" / "checkpoint" / "commits"
    commits.mkdir(parents=True)
    (commits / "0").write_text("v1")
    with pytest.raises(RuntimeError, match="does not hold"):
        load(spark, landed(0), tmp_path / "dw")


def test_master_stream_rate_and_arrival_log(spark, tmp_path):
    path = str(tmp_path / "m")
    master_table(spark, MASTER_ROWS).write.parquet(path)
    lines: list[str] = []
    listener = ArrivalLog(lines.append)
    spark.streams.addListener(listener)
    try:
        query = (
            stream_master(spark, path)
            .groupBy()
            .count()
            .writeStream.outputMode("complete")
            .format("memory")
            .queryName("master_arrivals")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        assert spark.table("master_arrivals").first()["count"] == 3
        deadline = dt.datetime.now() + dt.timedelta(seconds=20)
        while not any("stopped" in line for line in lines) and dt.datetime.now() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert any("3 rows" in line for line in lines)


def run_ticks(spark, rows, tmp_path, name):
    query = (
        rows.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rows_of(spark.read.schema(rows.schema).parquet(str(tmp_path / name))), query.recentProgress


def landed_times(spark, path, piles):
    """A file per pile, in order, and the stream that reads one of them a pass."""
    for n, pile in enumerate(piles):
        times(spark, *pile).coalesce(1).write.parquet(f"{path}/{n}")
    return spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_rates_of_running_feeds_show_quiet_ticks_and_keep_open_ones_only(spark, tmp_path):
    minutes = [[60 * n + s for s in range(0, 60, 4)] for n in range(8)]
    transactions = landed_times(spark, tmp_path / "t", [m[:5] if n % 3 == 0 else m[:1] for n, m in enumerate(minutes)])
    master = landed_times(spark, tmp_path / "m", [[m[7]] for m in minutes])
    clock = landed_times(spark, tmp_path / "c", minutes)
    rates = arrival_rate_stream({"transaction_rate": transactions, "master_rate": master}, clock, "ts", 10, 15)
    got, progress = run_ticks(spark, rates, tmp_path, "out")
    batch = [times(spark, *[x for n, m in enumerate(minutes) for x in (m[:5] if n % 3 == 0 else m[:1])]), times(spark, *[m[7] for m in minutes])]
    expected = rows_of(arrival_rate(*batch, "ts", 10))
    # The newest instant is 476, so ticks that end by 461 are over.
    closed = [r for r in expected if (r[0] - dt.datetime(2024, 1, 1)).total_seconds() + 10 <= 461]
    quiet = [r for r in got if r[1:] == (0, 0)]
    assert [r for r in got if r[0] <= closed[-1][0]] == closed and len(quiet) >= 24
    state = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    # A pass brings 6 ticks; 2 or 3 stay open behind it.
    assert len(state) >= 8 and max(state) <= 9 and state[-1] <= 3


def test_rates_drop_and_count_what_comes_too_late(spark, tmp_path):
    feed = landed_times(spark, tmp_path / "t", [[0, 5], [300], [400], [7]])
    clock = landed_times(spark, tmp_path / "c", [[0], [310], [420], [500]])
    got, progress = run_ticks(spark, arrival_rate_stream({"n": feed}, clock, "ts", 10, 15), tmp_path, "out")
    start = dt.datetime(2024, 1, 1)
    assert [((t - start).seconds, n) for t, n in got if n] == [(0, 2), (300, 1), (400, 1)]
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress if p["stateOperators"]) == 1


def test_gate_of_running_feeds_equals_the_batch(spark, tmp_path):
    rng = random.Random(8)
    feeds = [[sorted(rng.sample(range(100 * n, 100 * n + 100), 6)) for n in range(4)] for _ in range(2)]
    clock = landed_times(spark, tmp_path / "c", [[100 * n + 99] for n in range(4)])
    streams = [landed_times(spark, tmp_path / f"f{i}", f) for i, f in enumerate(feeds)]
    got, _ = run_ticks(spark, gated_tick_stream(*streams, clock, "ts", 10, 100), tmp_path, "out")
    expected = rows_of(gated_ticks(*[times(spark, *sum(f, [])) for f in feeds], "ts", 10))
    start = dt.datetime(2024, 1, 1)
    closed = [r for r in expected if (r[0] - start).seconds + 10 <= 299]
    assert closed and got == closed


def test_the_clock_of_past_feeds_closes_their_last_tick(spark, tmp_path):
    rows = times(spark, 3, 41)
    for every, ticks in ((True, [0, 10, 20, 30, 40, 65]), (False, [65])):
        past = past_clock(rows, "ts", 10, 15, every)
        assert sorted((r.ts - dt.datetime(2024, 1, 1)).seconds for r in past.collect()) == ticks
    assert past_clock(rows.limit(0), "ts", 10, 15).collect() == []


def gated(spark, root, **options):
    warehouse = Warehouse(spark, str(root / "dw"))
    run_load(
        warehouse,
        spark.readStream.schema(TX).parquet(str(root / "tx")),
        master=lambda: master_table(spark, MASTER_ROWS),
        seq=SEQ,
        history=None,
        trigger=ONCE,
        gate=spark.readStream.schema(MASTER).parquet(str(root / "m")),
        **options,
    ).awaitTermination()
    return warehouse


@pytest.mark.parametrize("options", [{"by_product": False}, {"landed": True}, {"by_product": False, "compact_every": 1}])
def test_keys_wait_for_both_feeds_and_survive_a_restart(spark, tmp_path, options):
    (tmp_path / "m").mkdir()
    for n in (0, 1):
        tx_table(spark, FILES[n]).write.mode("append").parquet(str(tmp_path / "tx"))
        warehouse = gated(spark, tmp_path, **options)
        assert warehouse.table("OrderFacts").count() == 0
    assert rows_of(warehouse.waiting()) == rows_of(tx_table(spark, FILES[0] + FILES[1]))
    master_table(spark, MASTER_ROWS[:2]).write.parquet(str(tmp_path / "m/a"))
    # Master rows alone do not open it either.
    warehouse = gated(spark, tmp_path, **options)
    assert warehouse.table("OrderFacts").count() == 0 and warehouse.waiting().count() == 5
    (tmp_path / "m").rename(tmp_path / "old")
    master_table(spark, MASTER_ROWS[2:]).write.parquet(str(tmp_path / "m"))
    tx_table(spark, FILES[2]).write.mode("append").parquet(str(tmp_path / "tx"))
    warehouse = gated(spark, tmp_path, **options)
    order = [FIRST_SEEN, *SEQ] if options.get("landed") else SEQ
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(batch_facts(spark, ALL, order))
    assert warehouse.waiting() is None
    noted = rows_of(warehouse.progress())
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in noted] == [
        (0, False, 2, 2, 0), (1, False, 3, 5, 0), *([(2, False, 0, 5, 0)] if len(noted) == 4 else []), (noted[-1][0], True, 3, 0, 6)
    ]


def test_a_gated_pass_that_is_run_again_loads_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    held, batch, master = tx_table(spark, FILES[0]), tx_table(spark, FILES[1]), master_table(spark, MASTER_ROWS)
    warehouse.hold(held, 0)
    warehouse.hold(held, 0)
    assert warehouse.waiting().count() == 2
    for _ in range(2):
        waited = warehouse.waiting(before=1)
        load_pass(warehouse, batch.unionByName(waited), 1, master, SEQ, by_product=False, changes=warehouse.released(1))
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(batch_facts(spark, FILES[0] + FILES[1], SEQ))
    assert warehouse.waiting() is None and warehouse.progress().count() == 2


def test_landed_history_equals_all_transactions_and_opens_touched_buckets_only(spark, tmp_path):
    warehouse, plain = Warehouse(spark, str(tmp_path / "dw"), buckets=8), Warehouse(spark, str(tmp_path / "plain"))
    rng, past, passes = random.Random(4), [], 11
    products = {p: (p, f"{p}.50", p % 3, p % 2) for p in range(12)}
    for n in range(passes):
        rows = [(rng.randrange(30), 1 + n, rng.choice([n, n + 1, 99, None]), rng.randrange(5), rng.randrange(9), 10 * n + k) for k in range(6)]
        past += rows
        batch, master = tx_table(spark, rows), master_table(spark, list(products.values()))
        load_pass(warehouse, batch, n, master, SEQ, landed=True)
        load_pass(plain, batch, n, master, SEQ, history=tx_table(spark, past))
        if n % 3 == 2:
            warehouse.compact()
    assert rows_of(warehouse.table("OrderFacts")) == rows_of(plain.table("OrderFacts"))
    keys = spark.createDataFrame([(3,)], "ProductID int")
    files = warehouse.history(keys).inputFiles()
    buckets = {f.split("bucket=")[1].split("/")[0] for f in files}
    assert len(buckets) == 1 and len(files) < len(warehouse.history(tx_table(spark, past)).inputFiles())
    assert rows_of(warehouse.history(keys).filter("ProductID = 3")) == rows_of(tx_table(spark, past).filter("ProductID = 3"))
    assert max(map(len, warehouse.state()["landed"]["folders"].values())) <= 11
    assert warehouse.history(keys.limit(0)).count() == 0


def test_a_crash_in_a_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    from martloom.sources import warehouse as module

    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    for n in (0, 1):
        load_pass(warehouse, tx_table(spark, [(n, 1, 10, 7, 1, n)]), n, master_table(spark, MASTER_ROWS), SEQ, by_product=False)

    def crash(*_):
        raise OSError("no rename")

    with monkeypatch.context() as patch:
        patch.setattr(module, "write_text", crash)
        with pytest.raises(OSError):
            warehouse.compact()
    assert warehouse.table("OrderFacts").count() == 2 and warehouse.passes() == [-1, 0, 1]
    with monkeypatch.context() as patch:
        patch.setattr(module, "delete", crash)
        warehouse.compact()
    assert warehouse.table("OrderFacts").count() == 2
    assert warehouse.state()["tables"]["OrderFacts"]["log"] == [] and warehouse.passes() == [-1, 0, 1]


def test_a_csv_stream_lands_every_line_once_clean_or_rejected(spark, tmp_path):
    header = "Gender,Order_ID,Order_Date,ProductID,CustomerID,CustomerName,Quantity_Ordered,extra"
    piles = [
        ['f,1,2019-01-05 10:11:12,2,3,"ann, b",4,x', "f,2,yesterday,2,3,ann,4,x", ",,,,,,,"],
        ["f,3,2019-01-06 00:00:00,2,3,ann,many,x", "f,4,2019-01-07 00:00:00,,,,1,", "too,short", "m,5,2019-01-08 00:00:00,1,1,a,1,x,more"],
    ]
    (tmp_path / "in").mkdir()
    for n, lines in enumerate(piles):
        (tmp_path / f"in/{n}.csv").write_text("\n".join([header, *lines]) + "\n")
        feed = stream_csv(spark, str(tmp_path / "in"), header.split(","), TRANSACTIONS, max_files=1)
        land_csv(feed, str(tmp_path / "out"), ONCE).awaitTermination()
    clean = spark.read.schema(TRANSACTIONS).parquet(str(tmp_path / "out/clean/pass=*")).collect()
    rejected = [r.line for r in spark.read.parquet(str(tmp_path / "out/rejected/pass=*")).collect()]
    assert sorted(((r.Order_ID, r.CustomerName, r.Quantity_Ordered) for r in clean), key=repr) == [(1, "ann, b", 4), (4, None, 1), (None, None, None)]
    assert sorted(rejected) == sorted([piles[0][1], piles[1][0], piles[1][2], piles[1][3]])
    assert len(clean) + len(rejected) == sum(map(len, piles))
    with pytest.raises(ValueError, match="Quantity_Ordered"):
        stream_csv(spark, str(tmp_path / "in"), ["Order_ID"], TRANSACTIONS)


@pytest.mark.parametrize("landed", [False, True])
def test_the_incremental_view_equals_a_full_one_after_random_passes(spark, tmp_path, monkeypatch, landed):
    from martloom.plans import incremental, olap

    monkeypatch.setattr(incremental, "FOLDERS", 3)
    warehouse, rng = Warehouse(spark, str(tmp_path / "dw"), buckets=2), random.Random(6 + landed)
    view = incremental.CustomerStoreSales(warehouse, str(tmp_path / "view"))
    variety = incremental.CustomerVariety(warehouse, str(tmp_path / "variety"))
    # Stores come to be known one by one, some long after the products of their number.
    products = [(p, f"{p}.25", p % 4, (p * 3) % 4) for p in range(8)]
    for n in range(7):
        rows = [(rng.randrange(12), 1 + rng.randrange(28), rng.choice(range(n + 2)), rng.randrange(4), rng.choice([None, 1, 2, 3]), 10 * n + k) for k in range(5)]
        load_pass(warehouse, tx_table(spark, rows), n, master_table(spark, products), SEQ, by_product=False, landed=landed)
        if n in (2, 5):
            warehouse.compact()
        if n != 3:
            assert rows_of(view.refresh()) == rows_of(olap.customer_store_monthly_sales(warehouse.star()))
            facts = warehouse.table("OrderFacts").groupBy("CustomerID", F.year("OrderDate").alias("OrderYear"))
            assert rows_of(variety.refresh()) == rows_of(facts.agg(F.countDistinct("ProductID").alias("UniqueProductsPurchased")))
            assert variety.top(2019, 3).collect() == olap.top_customers_by_variety(warehouse.star(), 2019, 3).collect()
    assert rows_of(view.refresh()) == rows_of(view.read()) and view.read().count() > 3
    assert len(list((tmp_path / "view/_manifests").glob("*.json"))) <= 2


def test_a_share_of_the_lines_is_written_by_the_tasks_that_read_it(spark, tmp_path, monkeypatch):
    from martloom import catalogue

    lines = spark.range(4000).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey").repartition(4)
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(catalogue, "work_dir", lambda spark, name: str(tmp_path / name))
    assert catalogue._split_lines(spark, str(tmp_path)).isStreaming
    shares = [sorted((tmp_path / "lines" / f"dealt={n}").glob("*.parquet")) for n in range(catalogue.SPLIT)]
    assert all(len(files) > 1 for files in shares)
    assert rows_of(spark.read.parquet(*[str(f) for files in shares for f in files])) == rows_of(lines)


def test_facts_of_a_single_pass_are_read_as_they_are(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    counts = load_pass(
        warehouse, tx_table(spark, FILES[0]), 0, master_table(spark, [*MASTER_ROWS, MASTER_ROWS[0]]), SEQ, by_product=False
    )
    facts = warehouse.table("OrderFacts")
    assert "Exchange" not in facts._jdf.queryExecution().executedPlan().toString()
    seen = products_seen(tx_table(spark, FILES[0]), SEQ)
    lines = pass_lines(tx_table(spark, FILES[0]), enrich(seen, master_table(spark, [*MASTER_ROWS, MASTER_ROWS[0]])))
    assert counts == {"joined_rows": lines.count(), "distinct_orders": facts.count()}
    assert lines.count() > len(FILES[0])


@pytest.mark.parametrize("shared", [0, 1, 20])
def test_only_orders_that_lie_in_several_folders_are_gathered(spark, tmp_path, shared):
    rows = [(n, 1 + n % 9, 10, 7, n + 1, n) for n in range(25)]
    more = [(25 - shared + n, 2 + n % 9, 20, 8, n + 1, 100 - n) for n in range(25)]
    compacted, warehouse = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200b")
        for house in (compacted, warehouse):
            for number, part in enumerate((rows, more)):
                load_pass(house, tx_table(spark, part), number, master_table(spark, MASTER_ROWS), SEQ, by_product=False)
                if house is compacted:
                    house.compact()
        facts = [house.table("OrderFacts") for house in (compacted, warehouse)]
        plan, got = facts[1]._jdf.queryExecution().executedPlan().toString(), [rows_of(table) for table in facts]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got[0] == got[1] == rows_of(batch_facts(spark, rows + more, SEQ))
    assert ("Exchange hashpartitioning" in plan) == (shared > 0) and ("LeftAnti, BuildRight" in plan) == (shared == 1)


def test_a_view_reads_the_facts_of_a_pass_that_shares_no_order_from_its_folder_alone(spark, tmp_path, monkeypatch):
    from martloom.plans.incremental import CustomerStoreSales

    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    view, read, contributions = CustomerStoreSales(warehouse, str(tmp_path / "view")), [], CustomerStoreSales.contributions
    monkeypatch.setattr(
        CustomerStoreSales, "contributions", lambda self, star, facts: read.append(facts.inputFiles()) or contributions(self, star, facts)
    )
    master = master_table(spark, [(10, "1.25", 100, 100), (20, "2.50", 100, 100)])
    for number, rows in enumerate(([(1, 1, 10, 7, 1, 1), (2, 1, 20, 8, 2, 2)], [(3, 2, 20, 7, 3, 3)], [(3, 2, 10, 7, 5, 4), (1, 3, 10, 9, 4, 5)])):
        load_pass(warehouse, tx_table(spark, rows), number, master, SEQ, by_product=False)
        del read[:]
        got = view.refresh()
        if number == 1:
            assert all("/log/1-" in file for files in read for file in files) and any(read)
        fresh = CustomerStoreSales(warehouse, str(tmp_path / f"fresh-{number}")).refresh()
        assert rows_of(got) == rows_of(fresh)


@pytest.fixture
def narrow(spark):
    """Too little room for a broadcast of anything but a few keys."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60b")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def many_lines(rng, passes, products):
    """Passes of lines whose orders come again, with lines of one order and product that only a tie-break tells apart."""
    for n in range(passes):
        yield [
            (rng.choice([None, *range(40)]), 1 + rng.randrange(28), rng.choice([None, 99, *range(products)]), rng.choice([None, *range(6 + 3 * n)]), rng.randrange(9), 1000 * n + k)
            for k in range(80)
        ]


def test_landed_history_too_large_to_broadcast_loads_as_lines_reduced_at_once(narrow, tmp_path):
    spark, past, rng = narrow, [], random.Random(8)
    warehouse, plain = Warehouse(spark, str(tmp_path / "dw"), buckets=4), Warehouse(spark, str(tmp_path / "plain"))
    for n, rows in enumerate(many_lines(rng, 3, 12)):
        # A hot product, but for the first pass.
        rows += [(rng.randrange(40), 1, 0, 1, 2, 1000 * n + 100 + k) for k in range(200 * n)]
        past += rows
        # Product 3 is listed twice; prices change from pass to pass.
        master = master_table(spark, [*[(p, f"{p + n}.50", p % 3, p % 2) for p in range(12)], (3, "0.25", 1, 1)])
        counts = load_pass(warehouse, tx_table(spark, rows), n, master, SEQ, landed=True)
        tx = tx_table(spark, past)
        seen = products_seen(tx_table(spark, rows), SEQ)
        lines = pass_lines(tx, enrich(seen, master), small=True)
        order = [FIRST_SEEN, *SEQ, "productPrice"]
        facts = reduce_batch(order_facts(lines, order), STAR["OrderFacts"].names, FACT_KEYS, order, FACT_KEEP_FIRST)
        assert counts == {"joined_rows": lines.filter("Order_ID IS NOT NULL").count(), "distinct_orders": facts.count()}
        plain.write_star(lines, enrich(seen, master), n, order)
        if n == 1:
            warehouse.compact()
    assert tables_of(warehouse) == tables_of(plain)


def test_a_landed_pass_keeps_nothing_of_the_size_of_its_history(narrow, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(set(self.columns)) or persist(self, *a))
    warehouse, rng = Warehouse(narrow, str(tmp_path / "dw"), buckets=4), random.Random(3)
    master = master_table(narrow, [(p, f"{p}.50", p % 3, p % 2) for p in range(12)])
    load_pass(warehouse, tx_table(narrow, next(many_lines(rng, 1, 12))), 0, master, SEQ, landed=True)
    # Products, and what the master data say of them; no transactions.
    assert len(kept) == 2 and not any("Order_ID" in columns for columns in kept)


def test_lines_of_a_pass_travel_once_by_product_and_once_by_order(narrow, tmp_path):
    from martloom.operators.load import facts_by_product, ranked_products

    spark, order = narrow, [FIRST_SEEN, *SEQ, "productPrice"]
    tx_table(spark, ALL * 3).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.schema(TX).parquet(str(tmp_path / "tx"))
    described = enrich(ranked_products(products_seen(tx, SEQ)), master_table(spark, MASTER_ROWS)).persist()
    lines = pass_lines(tx, described, small=False, deal=["Order_ID"], keep_salt=True)
    facts = facts_by_product(lines, STAR["OrderFacts"].names, FACT_KEYS, order, FACT_KEEP_FIRST, "_rows")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    described.unpersist()
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.split("InMemoryRelation")[0].splitlines() if "hashpartitioning(" in line]
    assert keys.count("OrderID") == 1 and not {"Order_ID", "CustomerID"} & set(keys)
    assert rows_of(facts.drop("_rows")) == rows_of(batch_facts(spark, ALL, [FIRST_SEEN, *SEQ]))
    by_order = next(line for line in plan.splitlines() if line.lstrip(" +-:").startswith("SortAggregate(key=[OrderID"))
    assert "seq" not in by_order


@pytest.mark.parametrize("second", [10, 40])
def test_a_large_log_that_repeats_most_orders_is_gathered_whole(narrow, tmp_path, second):
    spark, warehouse = narrow, Warehouse(narrow, str(tmp_path / "dw"))
    rows = [(n, 1 + n % 9, 10, 7, n + 1, n) for n in range(30)]
    more = [(n, 2 + n % 9, 20, 8, n + 1, 100 - n) for n in range(second)]
    for number, part in enumerate((rows, more)):
        load_pass(warehouse, tx_table(spark, part), number, master_table(spark, MASTER_ROWS), SEQ, by_product=False)
        if not number:
            warehouse.compact()
    facts = warehouse.table("OrderFacts")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert ("LeftSemi" in plan) == (second < len(rows))
    assert rows_of(facts) == rows_of(batch_facts(spark, rows + more, SEQ))
