"""What several operators need: written intermediate tables and bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.session import work_dir

# Rows and bytes handed to a Python worker at once. Texts have no length limit,
# so a batch is bounded by bytes as well.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small enough for long texts in a small executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the reading of a file, not the
    whole job so far. The folder is left to the storage's own clean-up.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
