"""The two feeds as file streams."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martloom.schemas import MASTER, TRANSACTIONS
from martloom.sources.feeds import CORRUPT, parse_lines, split_corrupt


def stream_files(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files under ``path`` (a folder or a glob) as they arrive, at most ``max_files`` a pass."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_transactions(
    spark: SparkSession, path: str, schema: StructType = TRANSACTIONS, max_files: int | None = None
) -> DataFrame:
    return stream_files(spark, path, schema, max_files)


def stream_master(
    spark: SparkSession, path: str, schema: StructType = MASTER, max_files: int | None = None
) -> DataFrame:
    """Master-data arrivals, for their rate; the load joins the master table as it stands."""
    return stream_files(spark, path, schema, max_files)


def stream_csv(
    spark: SparkSession, path: str, columns: Sequence[str], schema: StructType, max_files: int | None = None
) -> DataFrame:
    """New CSV files under ``path`` as lines of ``schema``; misfits carry their text, see :func:`parse_lines`."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    return parse_lines(reader.text(path), columns, schema)


def land_csv(lines: DataFrame, root: str, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Land the lines of :func:`stream_csv`: the clean ones under ``clean``, the others' text under ``rejected``.

    Each pass writes a folder of its own in both, over what an earlier attempt at
    the same pass left, so every line lands in one of them, once.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            clean, rejected = split_corrupt(batch)
            clean.write.mode("overwrite").parquet(f"{root}/clean/pass={batch_id}")
            rejected.select(F.col(CORRUPT).alias("line")).write.mode("overwrite").parquet(f"{root}/rejected/pass={batch_id}")
        finally:
            batch.unpersist()

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
