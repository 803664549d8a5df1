"""Views kept up to date by what passes change, not from all facts."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.measures import date_parts, month_start, sales, total, total_sales
from martloom.operators.joins import having, star_join, store_join
from martloom.operators.ranking import top_k
from martloom.schemas import FACT_KEYS, FACT_TABLE, Star
from martloom.sources.paths import children, delete, read_text, write_text
from martloom.sources.warehouse import Warehouse

# Folders of differences that are added up into one when there are more.
FOLDERS = 8


class KeptSums:
    """Sums over a warehouse's facts, kept under ``path``.

    Every refresh adds a folder with the difference that the passes since the last
    one make: what the orders they touched gave before goes out, what they give now
    comes in, and so do orders that a new dimension row lets in. The other facts are
    looked through for those orders but neither joined nor summed again. A manifest,
    written last, names the folders that count and the warehouse's state behind
    them; a reader never sees half a refresh. Once the folders of that state may be
    gone (after the warehouse's ``grace`` of passes) the view starts anew from all
    facts.

    A subclass says by which ``keys`` it sums, what facts contribute (``n`` counts
    rows, ``sums`` are its other columns, ``amount`` in exact cents), which facts
    come in late, and how the sums read.
    """

    keys: list[str]
    sums: list[str]

    def contributions(self, star: Star, facts: DataFrame) -> DataFrame:
        raise NotImplementedError

    def late(self, before: dict, now: dict) -> DataFrame | None:
        """Keys of facts that count from now on although no pass between two states touched them, if there can be any."""
        return None

    def named(self, star: Star, sums: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _added(self, parts: DataFrame) -> DataFrame:
        """Contributions added up; those that cancel out are gone."""
        sums = parts.groupBy(*self.keys).agg(
            F.sum("n").alias("n"), *[(total(F.col(c)) if c == "amount" else F.sum(c)).alias(c) for c in self.sums]
        )
        return sums.filter(reduce(Column.__or__, [F.col(c) != 0 for c in ("n", *self.sums)]))

    def __init__(self, warehouse: Warehouse, path: str) -> None:
        self.warehouse, self.spark, self.path = warehouse, warehouse.spark, path.rstrip("/")

    def _state(self) -> dict | None:
        names = [m for name in children(self.spark, f"{self.path}/_manifests") if (m := re.fullmatch(r"(\d+)\.json", name))]
        if not names:
            return None
        number = max(int(m[1]) for m in names)
        return json.loads(read_text(self.spark, f"{self.path}/_manifests/{number}.json")) | {"number": number}

    def _commit(self, state: dict, last: dict | None) -> None:
        number = last["number"] + 1 if last else 0
        write_text(self.spark, f"{self.path}/_manifests/{number}.json", json.dumps(state | {"number": number}))
        # What the manifest before the last one named, no reader needs by now.
        for folder in (last or {}).get("retired", []):
            delete(self.spark, folder)
        delete(self.spark, f"{self.path}/_manifests/{number - 2}.json")

    def _write(self, rows: DataFrame) -> str:
        folder = f"{self.path}/{uuid.uuid4()}"
        rows.write.parquet(folder)
        return folder

    def _difference(self, before: dict, now: dict) -> DataFrame:
        """Contributions between two states of the warehouse, those of the older one negative."""
        house = self.warehouse
        folders = [{*state["tables"][FACT_TABLE]["log"], *state["tables"][FACT_TABLE]["parts"].values()} for state in (before, now)]
        changed, same = sorted(folders[0] ^ folders[1]), sorted(folders[0] & folders[1])
        # Facts that only the changed folders hold: all of them are touched.
        old, new = (house.star_at(house.facts_only(state, changed)) for state in (before, now))
        touched = house.facts_in(before, changed).select(*FACT_KEYS)
        late = self.late(before, now) if same else None
        if late is not None:
            touched = touched.union(late)
        touched = touched.distinct()
        if same and not house.facts_in(before, same).select(*FACT_KEYS).join(touched, FACT_KEYS, "left_semi").isEmpty():
            old, new = (house.star_at(state) for state in (before, now))
            facts = [star.facts.join(touched, FACT_KEYS, "left_semi") for star in (old, new)]
        else:
            facts = [star.facts for star in (old, new)]
        out, in_ = (self.contributions(star, rows) for star, rows in zip((old, new), facts))
        return in_.unionByName(out.select(*self.keys, *[(-F.col(c)).alias(c) for c in ("n", *self.sums)]))

    def refresh(self) -> DataFrame:
        """Bring the view up to the warehouse's newest pass, and read it."""
        now, last = self.warehouse.state(), self._state()
        if now is None:
            raise RuntimeError(f"{self.warehouse.root} was never opened")
        if last and last["tables"] == now["tables"]:
            return self.read()
        fresh = last is None or now["pass"] - last["pass"] >= self.warehouse.grace
        if fresh:
            star = self.warehouse.star_at(now)
            rows, kept = self.contributions(star, star.facts), []
        else:
            rows, kept = self._difference(last, now), last["folders"]
        folders, retired = [*kept, self._write(self._added(rows))], last["folders"] if last and fresh else []
        if len(folders) > FOLDERS:
            folders, retired = [self._write(self._added(self.spark.read.parquet(*folders)))], folders
        own = {name: now[name] for name in ("pass", "position", "tables")}
        self._commit(own | {"folders": folders, "retired": retired}, last)
        return self.read()

    def read(self) -> DataFrame:
        """The view as of the last refresh."""
        state = self._state()
        sums = self._added(self.spark.read.parquet(*state["folders"]))
        return self.named(self.warehouse.dimensions_at(state), sums.filter("n > 0"))


class CustomerStoreSales(KeptSums):
    """Monthly sales per store and customer: the third view, in exact cents."""

    keys = ["supplierID", "CustomerID", "SalesMonth"]
    sums = ["amount", "sold"]

    def contributions(self, star: Star, facts: DataFrame) -> DataFrame:
        """Per store number, customer and month the sales, the rows, and the rows with sales."""
        supplied = having(star.product, star.supplier, "supplierID", "supplierID")
        stocked = having(supplied, star.store, "supplierID", "storeID").select("ProductID", "supplierID")
        joined = having(star_join(facts, stocked, "product"), star.customer, "CustomerID", "CustomerID")
        return joined.groupBy("supplierID", "CustomerID", month_start().alias("SalesMonth")).agg(
            F.count("*").alias("n"),
            F.coalesce(total_sales(), F.lit(0).cast("decimal(38,2)")).alias("amount"),
            F.count(sales()).alias("sold"),
        )

    def late(self, before: dict, now: dict) -> DataFrame | None:
        """Orders of products whose store became known only now."""
        old, new = (self.warehouse.dimensions_at(state) for state in (before, now))
        opened = new.store.join(old.store.select("storeID"), "storeID", "left_anti").select(F.col("storeID").alias("supplierID"))
        if opened.isEmpty():
            return None
        stocked = new.product.join(opened, "supplierID", "left_semi").select("ProductID")
        return self.warehouse.star_at(now).facts.join(stocked, "ProductID", "left_semi").select(*FACT_KEYS)

    def named(self, star: Star, sums: DataFrame) -> DataFrame:
        joined = star_join(store_join(sums, star.store, "supplierID"), star.customer, "customer")
        return joined.select(
            *["storeID", "storeName", "CustomerID", "CustomerName"],
            *date_parts("SalesMonth", year="OrderYear", month="OrderMonth"),
            F.when(F.col("sold") > 0, F.col("amount")).alias("MonthlySales"),
        )


class CustomerVariety(KeptSums):
    """How many different products each customer bought per year, exactly.

    Distinct counts do not add up, and neither a sketch nor a bitmap can give up an
    order that a later pass moves to another product, customer or year. Kept are
    therefore the orders per customer, year and product, which add and subtract;
    the different products are those with any order left.
    """

    keys = ["CustomerID", "OrderYear", "ProductID"]
    sums = []

    def contributions(self, star: Star, facts: DataFrame) -> DataFrame:
        return facts.groupBy("CustomerID", F.year("OrderDate").alias("OrderYear"), "ProductID").agg(F.count("*").alias("n"))

    def named(self, star: Star, sums: DataFrame) -> DataFrame:
        return sums.groupBy("CustomerID", "OrderYear").agg(F.count("ProductID").alias("UniqueProductsPurchased"))

    def top(self, year: int, k: int = 5) -> DataFrame:
        """The report on the customers with the most different products of a year, as of the last refresh."""
        of_year = self.read().filter(F.col("OrderYear") == year).drop("OrderYear")
        star = self.warehouse.dimensions_at(self._state())
        named = star_join(of_year, star.customer, "customer").select("CustomerID", "CustomerName", "UniqueProductsPurchased")
        return top_k(named, "UniqueProductsPurchased", k, tie=["CustomerID"])
