"""Inner equi-joins of the star, and the checks around them.

A dimension under the broadcast threshold is broadcast by Spark; a larger one
is sort-merge joined with the fact side on the left, where adaptive execution
splits hot partitions. :func:`salted_join` covers the joins it cannot split.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.sizing import fits_broadcast

SALT = "_salt"
SALTS = "_salts"
# Keys that can be found hot, and those the sketch keeps count of. A key is hot if
# it has more than so many times the rows of an even share.
HOT_KEYS, TRACKED, HOT = 128, 8192, 2.0

# Fact or product column -> dimension key, for the declared links of the star.
LINKS = {"product": "ProductID", "supplier": "supplierID", "customer": "CustomerID"}


def enrich(tx: DataFrame, master: DataFrame) -> DataFrame:
    """Transactions with the master data of their product.

    Unmatched and NULL products drop out; a product listed twice in the master
    data multiplies its rows, as an SQL join does.
    """
    return tx.join(master.withColumnRenamed("productID", "ProductID"), "ProductID")


def hot_keys(df: DataFrame, key: str, parts: int) -> tuple[DataFrame, int]:
    """Keys that outweigh an even share of ``parts``, with the shares each should be dealt into, and those of NULL.

    One aggregate with a sketch of the most frequent keys: it reads nothing but the
    key, and at most ``HOT_KEYS`` rows come out of it.
    """
    column, schema = F.col(key), f"`{key}` {df.schema[key].dataType.simpleString()}, {SALTS} int"
    top = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED})").alias("top")
    found = df.agg(top, F.count("*").alias("n"), F.count_if(column.isNull()).alias("nulls")).first()
    even = max(found["n"] / parts, 1.0)

    def shares(count: int) -> int:
        return min(parts, ceil(count / even)) if count > HOT * even else 1

    hot = [(item, shares(count)) for item, count in found["top"] or [] if item is not None and shares(count) > 1]
    return df.sparkSession.createDataFrame(hot, schema), shares(found["nulls"])


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", small: bool | None = None, parts: int | None = None,
    deal: Sequence[str] | None = None, weigh: DataFrame | None = None, keep_salt: bool = False,
) -> DataFrame:
    """Join a large ``left`` that may be hot on ``key`` with a ``right`` that is an aggregate or a join.

    A right side that measures small is broadcast; ``small`` may state the
    measure if it is known. Otherwise the frequent keys of ``left`` are found
    (:func:`hot_keys`), the rows of each are dealt out by its weight, NULL keys
    too, and only their rows on the right are copied, once per share; every other
    key is joined as it is. Adaptive execution alone would not do here: it splits
    a hot partition only if both inputs come straight from a shuffle. ``parts`` is
    the number of shares the whole is weighed by, by default that of a shuffle.

    ``how`` is inner, left_semi or left_anti. The salt is a hash of
    the columns in ``deal`` (all but the key, unless given), so a task that is
    run again deals the same way; other columns need not be read for it. Rows
    that agree in them, as those of a ``left`` with the key alone do, stay
    together. The columns come in the order of a plain join, the key first.

    ``weigh`` is a table that holds the rows of ``left`` among others and takes less to
    read: frequent keys are found in it. With ``keep_salt``, rows that were dealt out
    keep their share as ``_salt``; they lie together by key and share.
    """
    if fits_broadcast(right) if small is None else small:
        return left.join(F.broadcast(right), key, how)
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot, nulls = hot_keys(left if weigh is None else weigh, key, parts)
    if hot.isEmpty() and nulls == 1:
        return left.join(right.hint("merge"), key, how)
    # At most HOT_KEYS rows, and so broadcast to both sides.
    hot, one = F.broadcast(hot), F.lit(1)
    rest = list(deal) if deal is not None else [c for c in left.columns if c != key]
    shares = F.when(F.col(key).isNull(), F.lit(nulls)).otherwise(F.coalesce(SALTS, one))
    dealt = left.join(hot, key, "left").withColumn(SALT, F.pmod(F.xxhash64(*(rest or [key])), shares).cast("int")).drop(SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(SALTS, one) - 1)
    copied = right.join(hot, key, "left").withColumn(SALT, F.explode(copies)).drop(SALTS)
    joined = dealt.join(copied.hint("merge"), [key, SALT], how)
    return joined if keep_salt else joined.drop(SALT)


def pending_history(
    tx: DataFrame, keys: DataFrame, small: bool | None = None, deal: Sequence[str] | None = None
) -> DataFrame:
    """Every transaction, old ones too, of the products in ``keys``; ``deal`` as in :func:`salted_join`."""
    return salted_join(tx, keys.select("ProductID").distinct(), "ProductID", "left_semi", small, deal=deal)


def refresh_keys(tx: DataFrame, master: DataFrame, keys: DataFrame, small: bool | None = None) -> DataFrame:
    """:func:`pending_history`, enriched: one set join in place of a query per key."""
    return enrich(pending_history(tx, keys, small), master)


def unmatched(tx: DataFrame, master: DataFrame, deal: Sequence[str] | None = None) -> DataFrame:
    """The transactions :func:`enrich` drops, NULL products included; ``deal`` as in :func:`salted_join`."""
    known = master.select(F.col("productID").alias("ProductID")).distinct()
    return salted_join(tx, known, "ProductID", "left_anti", deal=deal).select(*tx.columns)


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, primary_key: str) -> DataFrame:
    """Child rows whose foreign key is set but names no parent."""
    known = parent.select(F.col(primary_key).alias(foreign_key)).distinct()
    linked = child.filter(F.col(foreign_key).isNotNull())
    return salted_join(linked, known, foreign_key, "left_anti").select(*child.columns)


def star_join(df: DataFrame, dimension: DataFrame, link: str) -> DataFrame:
    """``df`` with the columns of a linked dimension (product, supplier or customer)."""
    return df.join(dimension, LINKS[link])


def having(df: DataFrame, dimension: DataFrame, column: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` finds a dimension row, without its columns.

    Equal to the inner join when ``key`` is unique and no other dimension
    column is used. The result keeps the size estimate of ``df``, so that a
    small table reduced this way can still be broadcast.
    """
    return df.join(dimension.select(F.col(key).alias("_dimension_key")), F.col(column) == F.col("_dimension_key"), "left_semi")


def store_join(df: DataFrame, store: DataFrame, column: str) -> DataFrame:
    """``df`` with its store, found by the explicit predicate ``column = storeID``."""
    return df.join(store, F.col(column) == F.col("storeID"))
