"""The near-real-time load: each micro-batch joins master data and lands in the star."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from martloom.operators.joins import enrich, pending_history
from martloom.operators.load import FIRST_SEEN, known_lines, pass_lines, products_seen, ranked_products, unknown_products
from martloom.operators.sizing import fits_broadcast
from martloom.session import free_shuffles
from martloom.sources.paths import children, exists
from martloom.sources.warehouse import BY_PASS, Warehouse

log = logging.getLogger(__name__)

Table = Callable[[], DataFrame]


def pending_keys(batch: DataFrame) -> DataFrame:
    """The products a pass has to join, once each; NULL products join nothing."""
    return batch.select("ProductID").filter(F.col("ProductID").isNotNull()).distinct()


def load_pass(
    warehouse: Warehouse,
    batch: DataFrame,
    batch_id: int,
    master: DataFrame,
    seq: Sequence[str],
    history: DataFrame | None = None,
    by_product: bool = True,
    landed: bool = False,
    changes: dict | None = None,
    progress: dict | None = None,
) -> dict[str, Any]:
    """Load one batch and return its joined rows and distinct orders.

    With ``history``, all transactions of the batch's products are joined
    again, old ones at today's price; without it, only the batch. With ``landed``
    the warehouse keeps the history itself, by product, and a pass reads the
    buckets of its products. ``changes`` and ``progress`` go to the manifest.
    Products are visited in the order in which they arrived in the batch.
    ``by_product`` orders the pass product by product. Without it and without
    history, rows count in ``seq`` order alone, across passes too: each stored
    fact keeps the order of the transactions behind it, so that it does not
    matter how the input was cut into passes. Otherwise a later pass follows an
    earlier one.
    """
    # Products and lines are worked out once a pass and kept for its five writes.
    # A lost executor's share is recomputed from the files behind it. What landed is
    # not kept a second time: its files are read, and of them only what a write needs.
    kept, changes = [], dict(changes or {})

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table.persist(StorageLevel.MEMORY_AND_DISK))
        return table

    try:
        if landed:
            warehouse.open(BY_PASS)
            changes |= warehouse.landed(batch, batch_id)
            free_shuffles(warehouse.spark)
            batch = warehouse.arrived(changes, batch_id, batch.schema)
        elif history is None:
            keep(batch)
        seen = products_seen(batch, seq)
        seen = keep(ranked_products(seen) if by_product else seen)
        described = keep(enrich(seen, master))
        if landed:
            history = warehouse.history(pending_keys(seen), changes)
        small = by_product and fits_broadcast(described.select("ProductID", "productPrice", FIRST_SEEN))

        def joined(some: DataFrame) -> DataFrame:
            """The lines of some transactions; one shuffle brings them to the pass's products and to their prices."""
            own = pending_history(some, pending_keys(seen), deal=["Order_ID"])
            own = own if landed else keep(own)
            return pass_lines(own, described, small, ["Order_ID"], weigh=some if landed else None, keep_salt=True)

        behind, unknown = None, None
        if by_product and history is not None:
            lines = joined(history) if landed else keep(joined(history))
            behind = (history, joined) if landed else None
        elif by_product:
            lines = keep(pass_lines(batch, described, small, ["Order_ID"], keep_salt=True))
        else:
            tx = batch if history is None else keep(pending_history(history, pending_keys(seen)))
            unknown = unknown_products(seen, described)
            few = fits_broadcast(unknown)
            lines = known_lines(tx, described, unknown) if few else keep(known_lines(tx, described))
        # A product listed twice yields two rows per transaction; the price tells them apart.
        order = [*([FIRST_SEEN] if by_product else []), *seq, "productPrice"]
        counted = Observation(f"load-{batch_id}")
        arrival = history is None and not by_product
        return warehouse.write_star(
            lines, described, batch_id, order, counted, arrival, changes, progress, by_product and not small, behind
        )
    finally:
        for table in reversed(kept):
            table.unpersist()
        if landed:
            free_shuffles(warehouse.spark)


def check_root(warehouse: Warehouse, checkpoint: str) -> None:
    """Batch numbers live in the checkpoint and name the log folders: refuse one without the other."""
    has_log = any(n >= 0 for n in warehouse.passes())
    if has_log and not exists(warehouse.spark, checkpoint):
        raise RuntimeError(f"{warehouse.root} holds loaded batches but no checkpoint; batch numbers would restart")
    if not has_log and children(warehouse.spark, f"{checkpoint}/commits"):
        raise RuntimeError(f"{checkpoint} counts committed batches that {warehouse.root} does not hold")


FEED = "_feed"


def beside(transactions: DataFrame, master_feed: DataFrame) -> DataFrame:
    """Both feeds as one stream, so that a pass sees what either brought; of master rows only that they came."""
    return transactions.withColumn(FEED, F.lit("transactions")).unionByName(
        master_feed.select(F.lit("master").alias(FEED)), allowMissingColumns=True
    )


def run_load(
    warehouse: Warehouse,
    transactions: DataFrame,
    master: Table,
    seq: Sequence[str],
    history: Table | None,
    by_product: bool = True,
    trigger: dict[str, Any] | None = None,
    report: Callable[[int, dict[str, Any]], None] | None = None,
    compact_every: int = 20,
    landed: bool = False,
    gate: DataFrame | None = None,
) -> StreamingQuery:
    """Start loading the ``transactions`` stream into ``warehouse``.

    ``master`` and ``history`` are called in every pass, so each pass sees the
    master data and the landed transactions of that moment. ``history=None``
    joins only what arrived, which keeps the work of a pass proportional to the
    pass; ``landed`` keeps the history by product; see :func:`load_pass`. The
    default trigger is a pass per second. The log is compacted after every
    ``compact_every`` passes, which bounds what a pass and a reader have to look at.

    ``gate`` is the master feed as a stream. With it a pass loads only if both
    feeds advanced in it; otherwise its transactions wait in the warehouse, from
    where the next pass in which both advance loads them with its own. They
    survive a restart, and a pass that is run again finds those that waited
    before it. What every pass saw and did is :meth:`Warehouse.progress`.
    """
    checkpoint = f"{warehouse.root}/checkpoint"
    check_root(warehouse, checkpoint)

    def finished(batch_id: int, counts: dict[str, Any]) -> None:
        log.info("pass %s: %s rows joined into %s orders", batch_id, counts["joined_rows"], counts["distinct_orders"])
        if report:
            report(batch_id, counts)
        if (batch_id + 1) % compact_every == 0:
            warehouse.compact()

    def load(batch: DataFrame, batch_id: int, **noted: Any) -> None:
        past = history() if history else None
        finished(batch_id, load_pass(warehouse, batch, batch_id, master(), seq, past, by_product, landed, **noted))

    def load_gated(both: DataFrame, batch_id: int) -> None:
        both = both.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            arrived = dict(both.groupBy(FEED).count().collect())  # A row per feed.
            batch, counts = both.filter(F.col(FEED) == "transactions").drop(FEED), {"joined_rows": 0, "distinct_orders": 0}
            waited = warehouse.waiting(before=batch_id)
            came, held = arrived.get("transactions", 0), waited.count() if waited is not None else 0
            progress = {"transactions": came, "master_rows": arrived.get("master", 0)}
            if came and progress["master_rows"]:
                batch = batch if waited is None else batch.unionByName(waited)
                changes = warehouse.released(batch_id) if waited is not None else {}
                load(batch, batch_id, changes=changes, progress=progress | {"waiting": 0})
            else:
                warehouse.hold(batch, batch_id, progress | {"waiting": came + held})
                finished(batch_id, counts)
        finally:
            both.unpersist()

    rows, each = (transactions, load) if gate is None else (beside(transactions, gate), load_gated)
    return (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


class ArrivalLog(StreamingQueryListener):
    """Logs the arrival rate of every stream once per pass, quiet passes included.

    Add with ``spark.streams.addListener(ArrivalLog())``.
    """

    def __init__(self, report: Callable[[str], None] = log.info):
        self.report = report

    def onQueryStarted(self, event) -> None:
        self.report(f"stream {event.name or event.id} started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.report(f"stream {p.name or p.id} pass {p.batchId}: {p.numInputRows} rows, {p.inputRowsPerSecond} rows/s")

    def onQueryIdle(self, event) -> None:
        self.report(f"stream {event.id}: 0 rows")

    def onQueryTerminated(self, event) -> None:
        self.report(f"stream {event.id} stopped")
