"""JDBC as a source and a sink.

Connection options (url, user, password, driver) always come from the caller's
configuration; none are stored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partitioned(
    options: dict[str, str], column: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """``options`` for a scan split into ``partitions`` ranges of ``column``.

    Bounds only set the stride: rows outside them are still read, by the first
    and last range.
    """
    return {
        **options,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The table or query in ``options``; Spark pushes filters and columns down."""
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append", batch_size: int = 10_000) -> None:
    """Write ``df`` over parallel connections, in batched inserts.

    ``overwrite`` truncates rather than drops, so declared keys stay in place.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("batchsize", str(batch_size))
        .option("truncate", "true")
        .mode(mode)
        .save()
    )
