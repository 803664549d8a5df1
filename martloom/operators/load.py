"""Keyed loads: fact upsert, dimension insert-if-absent, and their report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from martloom.operators.joins import SALT, salted_join

FIRST_SEEN = "_first_seen"
PRICED = "_priced"


def _position(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def products_seen(tx: DataFrame, seq: Sequence[str]) -> DataFrame:
    """The products of a pass, once each, with ``_first_seen``, their earliest ``seq``.

    A pass visits products in first-seen order and, per product, its rows in
    arrival order; so a pass is ordered by ``[FIRST_SEEN, *seq]``. An
    aggregate, not a window: rows of a hot product combine before the shuffle.
    """
    return _with_keys(tx, ["ProductID"]).groupBy("ProductID").agg(F.min(_position(seq)).alias(FIRST_SEEN))


def ranked_products(seen: DataFrame) -> DataFrame:
    """:func:`products_seen` with one number for ``_first_seen`` that orders products the same way.

    A number travels with every transaction more cheaply than a position of several
    columns. It rises along a distributed sort, with gaps.
    """
    ranked = seen.sort(FIRST_SEEN, "ProductID").select("ProductID", F.monotonically_increasing_id().alias("_rank"))
    return ranked.withColumnRenamed("_rank", FIRST_SEEN)


def pass_lines(
    tx: DataFrame, described: DataFrame, small: bool | None = None, deal: Sequence[str] | None = None,
    weigh: DataFrame | None = None, keep_salt: bool = False,
) -> DataFrame:
    """Transactions of the ``described`` products (:func:`products_seen`, enriched), with price and ``_first_seen``.

    The one join on the transactions themselves: descriptions stay on the small
    product side. ``small`` states whether ``described`` fits a broadcast, if
    that is known; otherwise it is measured. The rest is as in :func:`salted_join`.
    """
    priced = described.select("ProductID", "productPrice", FIRST_SEEN)
    return salted_join(tx, priced, "ProductID", small=small, deal=deal, weigh=weigh, keep_salt=keep_salt)


def unknown_products(seen: DataFrame, described: DataFrame) -> DataFrame:
    """The products of a pass (:func:`products_seen`) that the master data do not list."""
    return seen.select("ProductID").join(described.select("ProductID"), "ProductID", "left_anti")


def known_lines(tx: DataFrame, described: DataFrame, unknown: DataFrame | None = None) -> DataFrame:
    """Transactions of the ``described`` products, as they came: :func:`pass_lines` without what it adds.

    ``unknown`` are the other products if they are few. They are broadcast, and the
    transactions stay where they are.
    """
    if unknown is None:
        return salted_join(tx, described.select("ProductID").distinct(), "ProductID", "left_semi", small=False).select(*tx.columns)
    return _with_keys(tx, ["ProductID"]).join(F.broadcast(unknown), "ProductID", "left_anti").select(*tx.columns)


def listings(described: DataFrame) -> DataFrame:
    """Once per product its ``_listings`` in the master data, and the price that comes last in the order of a pass."""
    last = described.groupBy("ProductID").agg(F.max(F.struct("productPrice")).alias("_last"), F.count("*").alias("_listings"))
    return last.select("ProductID", "_last.productPrice", "_listings")


def unpriced_facts(
    known: DataFrame,
    price: DataType,
    columns: Sequence[str],
    keys: Sequence[str],
    seq: Sequence[str],
    keep_first: Sequence[str],
    rows: str,
    span: tuple[str, str],
) -> DataFrame:
    """The facts of :func:`known_lines` in ``seq`` order, with ``_priced``, the product whose price they take.

    Lines of an order mostly arrive together and combine where they are, which
    they could not after a shuffle by product.
    """
    blank = order_facts(known.withColumn("productPrice", F.lit(None).cast(price)), seq)
    picked = [*[c for c in columns if c != "productPrice"], PRICED]
    return reduce_batch(blank.withColumn(PRICED, F.col("ProductID")), picked, keys, seq, keep_first, rows, span)


def priced_facts(facts: DataFrame, listed: DataFrame, span: tuple[str, str], small: bool) -> DataFrame:
    """:func:`unpriced_facts` with the price of their latest line, in the row and in the place of that line.

    The place of the earliest line has none: its price would only tell two listings
    of one product apart, and the earliest line brings nothing but the product.
    Prices that are not ``small`` are looked up by order numbers alone: those travel to
    the prices and back, and the facts stay where they were reduced.
    """
    priced = listed.select(F.col("ProductID").alias(PRICED), "productPrice")
    asked = facts if small else facts.select("OrderID", PRICED)
    joined = salted_join(asked, priced, PRICED, small=small, deal=["OrderID"]).drop(PRICED)
    if not small:
        joined = facts.drop(PRICED).join(joined.hint("merge"), "OrderID")
    none = F.lit(None).cast(listed.schema["productPrice"].dataType)
    prices = {span[0]: none, span[1]: F.col("productPrice")}
    return joined.withColumns({name: F.struct(f"{name}.*", value.alias("productPrice")) for name, value in prices.items()})


def product_order(described: DataFrame) -> list[str]:
    """Load order of described products; the attributes settle a product listed twice."""
    return [FIRST_SEEN, *[c for c in described.columns if c != FIRST_SEEN]]


def reduce_batch(
    batch: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    keep_first: Sequence[str] = (),
    rows: str | None = None,
    span: tuple[str, str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per key: ``keep_first`` columns of its earliest row, the others of its latest.

    ``order`` must be free of NULLs and of ties between differing rows. NULL
    keys cannot be stored and are left out. ``rows`` names an extra column with
    the number of rows behind each key, or the sum of ``weight`` if that column
    says how many each row stands for, ``span`` two with the order of its
    earliest and latest row. Being an aggregate, it combines rows before the
    shuffle however often one key occurs.
    """
    follow = [c for c in columns if c not in keys and c not in keep_first]
    # The keys say nothing about the order of their own rows; a column that is
    # ordered by and picked travels once.
    place = [c for c in order if c not in keys] or list(order)

    def end(pick, chosen: Sequence[str]) -> Column:
        row = F.struct(*dict.fromkeys([*place, *chosen]))
        return pick(F.when(F.col(place[0]).isNotNull(), row) if len(order) == 1 else row)

    picks = [
        end(pick, chosen).alias(name)
        for pick, chosen, name in ((F.min, keep_first, "_first"), (F.max, follow, "_last"))
        if chosen or span
    ]
    extra = [(F.sum(weight) if weight else F.count("*")).alias(rows)] if rows else []
    ends = [
        F.struct(*[F.col(f"{row}.{c}" if c in place else c).alias(c) for c in order]).alias(name)
        for row, name in zip(("_first", "_last"), span or ())
    ]
    unpacked = {c: F.col(f"_first.{c}") for c in keep_first} | {c: F.col(f"_last.{c}") for c in follow}
    return (
        _with_keys(batch, keys)
        .groupBy(*keys)
        .agg(*picks, *extra)
        .select(*[unpacked.get(c, F.col(c)).alias(c) for c in columns], *([rows] if rows else []), *ends)
    )


def facts_by_product(
    lines: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    keep_first: Sequence[str],
    rows: str,
) -> DataFrame:
    """The facts of :func:`pass_lines` in ``order``, for lines that a join has gathered by product.

    The lines of an order and a product lie in one task and become one row there. As
    ``_first_seen`` tells products apart, nothing else of the order has to travel
    to where an order is gathered.
    """
    salt = [SALT] if SALT in lines.columns else []
    each = [*keys, "ProductID", FIRST_SEEN, *salt]
    picked = [*each, *[c for c in columns if c not in each]]
    # Within an order and a product these are all the same; FIRST_SEEN is one of the keys.
    place = [FIRST_SEEN, *[c for c in order if c not in ("Order_ID", "ProductID", FIRST_SEEN)]]
    lasts = reduce_batch(order_facts(lines, [*order, *salt]), picked, each, place, rows=rows)
    return reduce_batch(lasts, columns, keys, [FIRST_SEEN], keep_first, rows=rows, weight=rows)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """``target`` after ``batch``: new keys added, present keys updated except ``keep_first``.

    Every target row is older than every batch row. Untouched target rows pass
    through an anti join against the batch's keys, so a small batch is
    broadcast and the target is neither shuffled nor sorted, and a filter or
    column choice on the result still reaches the target's scan.
    """
    columns, keys = target.columns, list(keys)
    fresh = reduce_batch(batch, columns, keys, order, keep_first)
    touched = _with_keys(batch, keys).select(*keys).distinct()
    untouched = target.join(touched, keys, "left_anti")
    if keep_first:
        held = target.join(touched, keys, "left_semi").select(
            *keys, F.struct(*keep_first).alias("_held")
        )
        fresh = fresh.join(held, keys, "left").select(
            *[
                (
                    F.when(F.col("_held").isNotNull(), F.col(f"_held.{c}")).otherwise(F.col(c)).alias(c)
                    if c in keep_first
                    else F.col(c)
                )
                for c in columns
            ]
        )
    return untouched.select(*columns).unionByName(fresh.select(*columns))


def repeated_keys(stored: DataFrame, arrived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that several rows of two sources share. Nothing but the keys is shuffled."""
    both = stored.select(*keys).unionByName(arrived.select(*keys))
    return both.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)


def gather_facts(both: DataFrame, keys: Sequence[str], keep_first: Sequence[str], span: tuple[str, str]) -> DataFrame:
    """One fact per key: ``keep_first`` columns of the earliest in ``span``, the others of the latest."""
    columns = both.columns
    follow = [c for c in columns if c not in keys and c not in keep_first and c not in span]
    return (
        both.groupBy(*keys)
        .agg(
            F.min(F.struct(span[0], *keep_first)).alias("_first_row"),
            F.max(F.struct(span[1], *follow)).alias("_last_row"),
        )
        .select(*keys, "_first_row.*", "_last_row.*")
        .select(*columns)
    )


def merge_facts(
    stored: DataFrame,
    arrived: DataFrame,
    keys: Sequence[str],
    keep_first: Sequence[str],
    span: tuple[str, str],
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Facts of two sources as if all rows behind them had been reduced at once.

    Both carry in ``span`` the order of the earliest and latest row behind each
    fact, so it does not matter how rows were dealt to them: ``keep_first``
    columns follow the earlier, the others the later. Stored rows without a
    match pass through an anti join, so that a small ``arrived`` is broadcast
    and filters on the result still reach the stored files. ``repeated`` are the
    :func:`repeated_keys` if they are few: then they are broadcast, and only their
    rows are gathered.
    """
    columns = stored.columns
    if repeated is None:
        touched = arrived.select(*keys).distinct()
        both = stored.join(touched, list(keys), "left_semi").select(*columns).unionByName(arrived.select(*columns))
    else:
        touched, stored = F.broadcast(repeated), stored.unionByName(arrived.select(*columns))
        both = stored.join(touched, list(keys), "left_semi").select(*columns)
    untouched = stored.join(touched, list(keys), "left_anti")
    return untouched.select(*columns).unionByName(gather_facts(both, keys, keep_first, span))


def insert_ignore(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The rows to append to ``target``: the earliest batch row of every key it lacks."""
    columns = target.columns
    earliest = reduce_batch(batch, columns, [key], order, keep_first=[c for c in columns if c != key])
    return earliest.join(target.select(key), key, "left_anti").select(*columns)


def order_facts(enriched: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Enriched transactions in the fact table's columns, ``carry`` columns kept along."""
    columns = {
        "OrderID": F.col("Order_ID"),
        "OrderDate": F.to_date("Order_Date"),
        "ProductID": F.col("ProductID"),
        "CustomerID": F.col("CustomerID"),
        "QuantityOrdered": F.col("Quantity_Ordered"),
        "productPrice": F.col("productPrice"),
    }
    return enriched.select(*[e.alias(n) for n, e in columns.items()], *[c for c in carry if c not in columns])


def load_report(batch: DataFrame, key: str = "Order_ID") -> DataFrame:
    """Joined rows of a pass, and the distinct orders they fall on."""
    return batch.agg(F.count("*").alias("joined_rows"), F.countDistinct(key).alias("distinct_orders"))
