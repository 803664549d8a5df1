"""The five warehouse tables on plain Parquet, with a manifest per pass.

Every write goes to a folder of its own, and a pass counts once its manifest is
there: a small file, written last and renamed into place, that names all
folders the tables consist of. Readers follow the newest manifest alone, so they
list nothing else, need no marker files, and never see part of a pass.

    <root>/_manifests/<pass>.json           and <pass>.<n>.json for what follows in the same pass
    <root>/<table>/log/<pass>-<id>          rows of one pass
    <root>/<table>/part/<pass>-<id>[/OrderYear=Y]   compacted rows
    <root>/_landed/log/<pass>-<id>/bucket=B         transactions as they came, by product
    <root>/_waiting/log/<pass>-<id>         transactions that the gate holds back
    <root>/_progress/part/<pass>-<id>       what earlier passes did

A manifest is never replaced: a compaction, or a pass that is run again, writes
one of the next number, and older ones go when no reader can need them.

A fact carries the order of the earliest and the latest transaction behind it,
so facts of several passes combine to what one pass over all would give.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from martloom.operators.joins import salted_join
from martloom.operators.load import (
    facts_by_product,
    gather_facts,
    insert_ignore,
    listings,
    merge_facts,
    order_facts,
    priced_facts,
    product_order,
    reduce_batch,
    repeated_keys,
    unpriced_facts,
)
from martloom.operators.sizing import broadcast_limit, fits_broadcast, measured_bytes
from martloom.schemas import DIMENSION_KEYS, FACT_KEEP_FIRST, FACT_KEYS, FACT_TABLE, STAR, Star
from martloom.sources.paths import children, delete, read_text, write_text

ROWS = "_rows"
SPAN = ("_earliest", "_latest")
BY_PASS = StructType([StructField("pass", LongType())])
YEAR = "OrderYear"
# Passes for which replaced folders and old manifests stay for readers that began before.
GRACE = 100
# Compacted folders of a dimension that are joined into one when there are more.
PARTS = 8
# Sets of fact folders of which it is remembered how they merge.
REMEMBERED = 8
# Shares that landed transactions are dealt into by product.
BUCKETS = 64
BUCKET = "bucket"
PROGRESS = StructType(
    [
        StructField("pass", LongType()),
        StructField("gate_open", BooleanType()),
        *[StructField(c, LongType()) for c in ("transactions", "master_rows", "waiting", "joined_rows", "distinct_orders")],
    ]
)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: dict[str, StructType] | None = None,
        grace: int = GRACE,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas or STAR
        self.grace = max(1, grace)
        self.buckets = buckets
        self._overlaps: dict[tuple[str, ...], tuple[int, DataFrame | None, bool]] = {}

    # Manifests

    def _manifests(self) -> dict[tuple[int, int], str]:
        """Paths of the manifests by pass and by number within it."""
        names = children(self.spark, f"{self.root}/_manifests")
        found = {name: re.fullmatch(r"(-?\d+)(?:\.(\d+))?\.json", name) for name in names}
        return {(int(m[1]), int(m[2] or 0)): f"{self.root}/_manifests/{name}" for name, m in found.items() if m}

    def passes(self) -> list[int]:
        """Passes that have a manifest; -1 stands for the empty warehouse."""
        return sorted({number for number, _ in self._manifests()})

    def state(self, before: int | None = None) -> dict | None:
        """The newest manifest, or the newest before a pass; None for a warehouse that was never opened."""
        manifests = {at: path for at, path in self._manifests().items() if before is None or at[0] < before}
        if manifests:
            return json.loads(read_text(self.spark, manifests[max(manifests)]))
        if set(children(self.spark, self.root)) & set(self.schemas):
            raise RuntimeError(f"{self.root} holds data but no manifest" + (f" before pass {before}" if before else ""))
        return None

    def open(self, position: StructType = BY_PASS) -> None:
        """Begin an empty warehouse, or check that facts are still ordered by ``position``."""
        state = self.state()
        if state is None:
            tables = {name: {"log": [], "parts": {} if name == FACT_TABLE else []} for name in self.schemas}
            self._commit({"pass": -1, "position": position.jsonValue(), "tables": tables, "retired": []})
        elif state["position"] != position.jsonValue() and any(state["tables"][FACT_TABLE].values()):
            raise RuntimeError(f"{self.root} orders facts by {state['position']}, not by {position.jsonValue()}")

    def _commit(self, state: dict) -> None:
        """Write the next manifest of its pass, then remove what no reader within the grace can need."""
        number = state["pass"]
        old = [x for x in state["retired"] if x[1] <= number - self.grace]
        state["retired"] = [x for x in state["retired"] if x not in old]
        manifests = self._manifests()
        again = max((n for at, n in manifests if at == number), default=-1) + 1
        name = f"{number}.{again}" if again else f"{number}"
        write_text(self.spark, f"{self.root}/_manifests/{name}.json", json.dumps(state))
        for folder, _ in old:
            delete(self.spark, folder)
        for at, path in manifests.items():
            if 0 <= at[0] < number - self.grace:
                delete(self.spark, path)

    # Reading

    def _schema(self, table: str, state: dict) -> StructType:
        if table != FACT_TABLE:
            return self.schemas[table]
        position = StructType.fromJson(state["position"])
        return StructType([*self.schemas[table].fields, *[StructField(name, position) for name in SPAN]])

    def _read(self, table: str, state: dict, folders: Sequence[str]) -> DataFrame:
        schema = self._schema(table, state)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _current(self, table: str, state: dict) -> DataFrame:
        own = state["tables"][table]
        if table != FACT_TABLE:
            return self._read(table, state, [*own["parts"], *own["log"]])
        if not own["parts"] and len(own["log"]) == 1:
            return self._read(table, state, own["log"])  # A pass writes an order once.
        parts = sorted(set(own["parts"].values()))
        return self._merged(state, parts, own["log"]) if own["log"] else self._read(table, state, parts)

    def _overlap(self, folders: tuple[str, ...], stored: DataFrame, log: DataFrame) -> tuple[int, DataFrame | None, bool]:
        """Bytes of the orders that lie in several of the folders, and those orders, if the log is not small itself.

        Last whether they are many, and the log no smaller than what is stored. Folders never
        change, so it is found out once.
        """
        if folders not in self._overlaps:
            found = (-1, None, False)
            if not fits_broadcast(log.select(*FACT_KEYS)):
                repeated = repeated_keys(stored, log, FACT_KEYS)
                size = measured_bytes(repeated)
                found = (size, repeated, size > max(broadcast_limit(log), 0) and stored.count() <= log.count())
            while len(self._overlaps) >= REMEMBERED:
                del self._overlaps[next(iter(self._overlaps))]
            self._overlaps[folders] = found
        return self._overlaps[folders]

    def _merged(self, state: dict, parts: Sequence[str], logs: Sequence[str]) -> DataFrame:
        """The facts of some compacted folders and some of the log, one per order.

        Of a large log only those orders are gathered that lie in several folders, if they are few.
        If they are many, and the log is no smaller than what is stored, all are: finding the
        stored orders to gather would take more than gathering them.
        """
        stored, log = (self._read(FACT_TABLE, state, folders) for folders in (parts, logs))
        size, repeated, whole = self._overlap((*parts, "", *logs), stored, log)
        if size == 0:
            return stored.unionByName(log)
        if whole:
            return gather_facts(stored.unionByName(log), FACT_KEYS, FACT_KEEP_FIRST, SPAN)
        few = repeated if 0 < size <= broadcast_limit(log) else None
        return merge_facts(stored, log, FACT_KEYS, FACT_KEEP_FIRST, SPAN, few)

    def table(self, name: str, before: int | None = None) -> DataFrame:
        """Current rows; with ``before``, as they were before that pass."""
        state = self.state(before)
        if state is None:
            return self.spark.createDataFrame([], self.schemas[name])
        return self._current(name, state).select(*self.schemas[name].names)

    def star(self) -> Star:
        return Star(
            facts=self.table("OrderFacts"),
            product=self.table("ProductDimension"),
            customer=self.table("CustomerDimension"),
            supplier=self.table("SupplierDimension"),
            store=self.table("StoreDimension"),
        )

    def star_at(self, state: dict) -> Star:
        """The tables as a manifest names them."""
        names = {"facts": FACT_TABLE, **{name.removesuffix("Dimension").lower(): name for name in DIMENSION_KEYS}}
        return Star(**{field: self._current(name, state).select(*self.schemas[name].names) for field, name in names.items()})

    def facts_only(self, state: dict, folders: Sequence[str]) -> dict:
        """A manifest that names, of the fact folders, only some."""
        own = state["tables"][FACT_TABLE]
        some = {"log": [f for f in own["log"] if f in folders], "parts": {y: f for y, f in own["parts"].items() if f in folders}}
        return state | {"tables": state["tables"] | {FACT_TABLE: some}}

    def dimensions_at(self, state: dict) -> Star:
        """The tables as a manifest names them, without facts."""
        return self.star_at(self.facts_only(state, []))

    def facts_in(self, state: dict, folders: Sequence[str]) -> DataFrame:
        """The fact rows in some folders, as they were written."""
        return self._read(FACT_TABLE, state, folders)

    # Writing

    def _write(self, df: DataFrame, table: str, kind: str, number: int, by: str | None = None) -> str | None:
        """A new folder with the rows, or None (and no folder) if there are none."""
        path, counted = f"{self.root}/{table}/{kind}/{number}-{uuid.uuid4()}", Observation()
        writer = df.observe(counted, F.count("*").alias("n")).write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
        if counted.get["n"]:
            return path
        delete(self.spark, path)
        return None

    def write_star(
        self,
        lines: DataFrame,
        described: DataFrame,
        batch_id: int,
        order: Sequence[str],
        observation=None,
        arrival: bool = False,
        changes: dict | None = None,
        progress: dict | None = None,
        gathered: bool = False,
        behind: tuple[DataFrame, Callable[[DataFrame], DataFrame]] | None = None,
    ) -> dict:
        """Load pass ``batch_id``: dimensions, facts, and then the manifest that makes them count.

        ``lines`` are the pass's transactions with price (:func:`pass_lines`), or
        without it (:func:`known_lines`) if ``order`` needs nothing of the products
        but the price: then prices are looked up once an order. ``described`` are its
        products; suppliers, products and stores come from the latter and never
        touch the transactions. Returns what ``observation`` found. With ``arrival``, ``order``
        also ranks transactions of different passes; otherwise a later pass
        follows an earlier one. ``observation`` receives ``joined_rows`` and
        ``distinct_orders`` from the fact write itself; they are noted with
        ``progress``. ``changes`` are other parts of the manifest, as :meth:`landed`
        and :meth:`hold` return them, that begin to count with the pass. ``gathered``
        lines come from a join that shuffled them by product. ``behind`` are the
        transactions that lines are made of, and how, if lines are not kept: then
        customers to add are looked for among the transactions.
        """
        priced, price = "productPrice" in lines.columns, described.schema["productPrice"]
        seq = [c for c in order if priced or c != price.name]
        by = StructType([*lines.select(*seq).schema, *([] if priced else [price])]) if arrival else BY_PASS
        self.open(by)
        # Before the first fact the order is open: passes that only waited say nothing of it.
        state = self.state(before=batch_id) | {"position": by.jsonValue()}
        for table, key in DIMENSION_KEYS.items():
            rows, position = (lines, seq) if table == "CustomerDimension" else (described, product_order(described))
            if rows is lines and (state["tables"][table]["log"] or state["tables"][table]["parts"]):
                rows = self._lacking(lines, table, key, state, behind)
            # A stored dimension is first reduced to the keys asked for: a small
            # pass is broadcast to it, so it is read but not shuffled.
            asked = (behind[0] if behind and rows is lines else rows).select(key).distinct()
            present = self._current(table, state).join(asked, key, "left_semi")
            folder = self._write(insert_ignore(present, rows, key, position), table, "log", batch_id)
            state["tables"][table]["log"] += [folder] if folder else []
        columns, kept, again = self.schemas[FACT_TABLE].names, None, 0
        if priced and gathered and not arrival:
            facts = facts_by_product(lines, columns, FACT_KEYS, order, FACT_KEEP_FIRST, ROWS)
        elif priced:
            facts = reduce_batch(order_facts(lines, order), columns, FACT_KEYS, order, FACT_KEEP_FIRST, rows=ROWS, span=SPAN)
        else:
            kept = unpriced_facts(lines, price.dataType, columns, FACT_KEYS, seq, FACT_KEEP_FIRST, ROWS, SPAN)
            kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
            listed = listings(described)
            facts = priced_facts(kept, listed, SPAN, fits_broadcast(listed)).select(*columns, ROWS, *SPAN)
            again = _listed_again(lines, listed)
        if not arrival:
            place = F.struct(F.lit(batch_id).cast("long").alias("pass"))
            facts = facts.withColumns({name: place for name in SPAN})
        if observation is not None:
            facts = facts.observe(
                observation,
                F.coalesce(F.sum(ROWS), F.lit(0)).alias("joined_rows"),
                F.count("*").alias("distinct_orders"),
            )
        folder = self._write(facts.drop(ROWS), FACT_TABLE, "log", batch_id)
        if kept is not None:
            kept.unpersist()
        state["tables"][FACT_TABLE]["log"] += [folder] if folder else []
        counts = observation.get if observation is not None else {}
        if counts:
            counts = counts | {"joined_rows": counts["joined_rows"] + again}
        self._finish(state, batch_id, changes or {}, {"gate_open": True, **(progress or {}), **counts})
        return counts

    def _lacking(
        self,
        lines: DataFrame,
        table: str,
        key: str,
        state: dict,
        behind: tuple[DataFrame, Callable[[DataFrame], DataFrame]] | None = None,
    ) -> DataFrame:
        """The lines whose dimension row is not stored yet, if their keys are few; else all."""
        source, made = behind or (lines, lambda some: some)
        asked = source.select(key).filter(F.col(key).isNotNull()).distinct()
        missing = asked.join(self._current(table, state).select(key), key, "left_anti")
        size = measured_bytes(missing)
        if size == 0:
            return self.spark.createDataFrame([], lines.schema)
        if size > broadcast_limit(missing):
            return lines
        return made(source.join(F.broadcast(missing), key, "left_semi").select(*source.columns))

    def _finish(self, state: dict, batch_id: int, changes: dict, progress: dict) -> None:
        noted = state.get("progress", {"log": [], "parts": []})
        noted["log"].append({**progress, "pass": batch_id})
        self._commit(state | {"progress": noted} | changes | {"pass": batch_id})

    # Transactions as they came

    def _bucket(self, buckets: int) -> Column:
        # As text, so that keys of another integer type find the same bucket.
        return F.pmod(F.xxhash64(F.col("ProductID").cast("string")), F.lit(buckets)).cast("int")

    def landed(self, batch: DataFrame, batch_id: int) -> dict:
        """Write a pass's transactions by product; returns the change of the manifest that makes them count.

        Every bucket is a list of folders of its own, so that the history of some
        products is read without looking at the others'. Transactions without a
        product join nothing and are not kept.
        """
        state = self.state(before=batch_id)
        own = state.get("landed") or {"buckets": self.buckets, "schema": batch.schema.jsonValue(), "folders": {}}
        return {"landed": self._laid(batch, own, "log", batch_id)}

    def _laid(self, rows: DataFrame, own: dict, kind: str, number: int) -> dict:
        dealt = rows.filter(F.col("ProductID").isNotNull()).withColumn(BUCKET, self._bucket(own["buckets"]))
        # Rebalancing gathers a bucket into few files and still splits a hot one.
        folder = self._write(dealt.hint("rebalance", F.col(BUCKET)), "_landed", kind, number, by=BUCKET)
        folders = {b: list(paths) for b, paths in own["folders"].items()}
        for name in children(self.spark, folder) if folder else []:
            if name.startswith(f"{BUCKET}="):
                folders.setdefault(name.removeprefix(f"{BUCKET}="), []).append(f"{folder}/{name}")
        return own | {"folders": folders}

    def arrived(self, landed: dict, batch_id: int, schema: StructType) -> DataFrame:
        """The transactions that :meth:`landed` wrote for a pass, from its folders."""
        own = f"{self.root}/_landed/log/{batch_id}-"
        folders = [f for paths in landed["landed"]["folders"].values() for f in paths if f.startswith(own)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def history(self, keys: DataFrame, landed: dict | None = None) -> DataFrame:
        """Landed transactions in the buckets of the products in ``keys``, which hold all of theirs.

        ``landed`` is a change that does not count yet; otherwise the newest manifest's.
        """
        own = (landed or self.state())["landed"]
        # At most as many rows as there are buckets.
        touched = [str(r[0]) for r in keys.select(self._bucket(own["buckets"])).distinct().collect()]
        schema, folders = StructType.fromJson(own["schema"]), [f for b in sorted(touched) for f in own["folders"].get(b, [])]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # The gate

    def hold(self, batch: DataFrame, batch_id: int, progress: dict | None = None, changes: dict | None = None) -> None:
        """Pass ``batch_id`` loads nothing: its transactions wait, as the manifest says, for a pass that does."""
        if self.state(before=batch_id) is None:
            self.open()
        state = self.state(before=batch_id)
        waiting = state.get("waiting") or {"schema": batch.schema.jsonValue(), "folders": []}
        folder = self._write(batch, "_waiting", "log", batch_id)
        waiting["folders"] += [folder] if folder else []
        held = {"waiting": waiting} | (changes or {})
        self._finish(state, batch_id, held, {"joined_rows": 0, "distinct_orders": 0, **(progress or {}), "gate_open": False})

    def waiting(self, before: int | None = None) -> DataFrame | None:
        """Transactions that the gate holds back; None if there are none."""
        own = (self.state(before) or {}).get("waiting")
        if not own or not own["folders"]:
            return None
        return self.spark.read.schema(StructType.fromJson(own["schema"])).parquet(*own["folders"])

    def released(self, batch_id: int) -> dict:
        """The change of the manifest by which nothing waits any more."""
        state = self.state(before=batch_id)
        own = state.get("waiting")
        if not own:
            return {}
        return {"waiting": None, "retired": state["retired"] + [[folder, batch_id] for folder in own["folders"]]}

    def progress(self) -> DataFrame:
        """A row per pass: what arrived, whether the gate was open, what waited, and what was loaded."""
        own = (self.state() or {}).get("progress", {"log": [], "parts": []})
        fresh = self.spark.createDataFrame([tuple(r.get(c) for c in PROGRESS.names) for r in own["log"]], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(*own["parts"]).unionByName(fresh) if own["parts"] else fresh

    def compact(self) -> int:
        """Fold the log of the finished passes into the compacted parts; returns the last pass (-1 if none).

        Facts lie in a folder per year, sorted by date; only years that hold a row
        of an order in the log, or get one, are rewritten. The log's rows of a
        dimension become one more part, and many parts one. So do the passes'
        progress and the folders of a bucket of landed transactions.
        """
        state = self.state()
        if state is None or state["pass"] < 0:
            return -1
        upto = state["pass"]
        for table in self.schemas:
            own = state["tables"][table]
            if not own["log"]:
                continue
            gone = list(own["log"])
            if table == FACT_TABLE:
                gone += self._compact_facts(own, state)
            else:
                whole = len(own["parts"]) >= PARTS
                gone += own["parts"] if whole else []
                rows = self._read(table, state, gone)
                kept = [] if whole else own["parts"]
                own["parts"] = [*kept, self._write(rows.hint("rebalance"), table, "part", upto)]
            own["log"] = []
            state["retired"] += [[folder, upto] for folder in gone]
        self._compact_progress(state)
        self._compact_landed(state)
        self._commit(state)
        return upto

    def _compact_progress(self, state: dict) -> None:
        own = state.get("progress")
        if not own or not own["log"]:
            return
        gone = own["parts"] if len(own["parts"]) >= PARTS else []
        rows = self.spark.createDataFrame([tuple(r.get(c) for c in PROGRESS.names) for r in own["log"]], PROGRESS)
        if gone:
            rows = rows.unionByName(self.spark.read.schema(PROGRESS).parquet(*gone))
        kept = [p for p in own["parts"] if p not in gone]
        state["progress"] = {"log": [], "parts": [*kept, self._write(rows.coalesce(1), "_progress", "part", state["pass"])]}
        state["retired"] += [[folder, state["pass"]] for folder in gone]

    def _compact_landed(self, state: dict) -> None:
        """Join the folders of buckets that have many; the other buckets are not read."""
        own = state.get("landed")
        many = {b: paths for b, paths in own["folders"].items() if len(paths) > PARTS} if own else {}
        if not many:
            return
        gone = [f for paths in many.values() for f in paths]
        rows = self.spark.read.schema(StructType.fromJson(own["schema"])).parquet(*gone)
        kept = own | {"folders": {b: paths for b, paths in own["folders"].items() if b not in many}}
        state["landed"] = self._laid(rows, kept, "part", state["pass"])
        state["retired"] += [[folder, state["pass"]] for folder in gone]

    def touched_years(self, state: dict) -> tuple[list[str], DataFrame]:
        """Years of stored facts that the log changes, and those facts merged with the log."""
        own = state["tables"][FACT_TABLE]
        log = self._read(FACT_TABLE, state, own["log"])
        stored = self._read(FACT_TABLE, state, sorted(own["parts"].values())).select(*FACT_KEYS, "OrderDate")
        year = F.coalesce(F.year("OrderDate").cast("string"), F.lit("none"))
        held = stored.join(log.select(*FACT_KEYS).distinct(), FACT_KEYS, "left_semi").select(year.alias(YEAR))
        # As many rows as there are years.
        found = {r[0] for r in held.union(log.select(year.alias(YEAR))).distinct().collect()}
        years = sorted(found & set(own["parts"]))
        if not years and len(own["log"]) == 1:
            merged = log  # A pass writes an order once.
        else:
            merged = self._merged(state, [own["parts"][y] for y in years], own["log"])
        return years, merged.withColumn(YEAR, year)

    def _compact_facts(self, own: dict, state: dict) -> list[str]:
        """Replace the years that the log touches; returns their old folders."""
        years, merged = self.touched_years(state)
        # Rebalancing gathers a year into few files and still splits a large one.
        laid = merged.hint("rebalance", F.col(YEAR)).sortWithinPartitions(YEAR, "OrderDate", *FACT_KEYS)
        folder = self._write(laid, FACT_TABLE, "part", state["pass"], by=YEAR)
        gone = [own["parts"].pop(y) for y in years]
        for name in children(self.spark, folder):
            if name.startswith(f"{YEAR}="):
                own["parts"][name.removeprefix(f"{YEAR}=")] = f"{folder}/{name}"
        return gone


def _listed_again(lines: DataFrame, listed: DataFrame) -> int:
    """How many rows a join of the lines with the master data has above one per line."""
    often = listed.filter("_listings > 1").select("ProductID", "_listings")
    if often.isEmpty():
        return 0
    joined = salted_join(lines.filter(F.col("Order_ID").isNotNull()).select("ProductID", "Order_ID"), often, "ProductID")
    return joined.agg(F.coalesce(F.sum(F.col("_listings") - 1), F.lit(0)).alias("n")).first()["n"]
