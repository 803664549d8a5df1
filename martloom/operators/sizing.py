"""Measured broadcasts.

Spark broadcasts a plain table scan by itself when its files are small enough.
For a derived table (a join of tables, say) its estimate is the product of the
inputs and says nothing, so such a table is measured before it is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``autoBroadcastJoinThreshold`` in bytes; below zero means never."""
    setting = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip()
    if setting.startswith("-"):
        return -1
    parser = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    return int(parser.byteStringAsBytes(setting))


def _words(kind: DataType) -> int:
    return 1 + sum(_words(f.dataType) for f in kind) if isinstance(kind, StructType) else 1


def measured_bytes(df: DataFrame) -> int:
    """Row bytes of ``df``: 8 per row and per value, and the text itself. One distributed aggregate."""
    size = F.lit(8 + sum(_words(field.dataType) for field in df.schema) * 8).cast("bigint")
    for field in df.schema:
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame) -> bool:
    limit = broadcast_limit(df)
    return limit > 0 and measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it measures under the limit, else as it is."""
    return F.broadcast(df) if fits_broadcast(df) else df
