"""Batch access to the transaction and master-data feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom.schemas import MASTER, TRANSACTIONS
from martloom.sources.jdbc import read_jdbc

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV feed with a header line, typed by ``schema``; columns are found by the header's names.

    The header is looked up once; a file under ``path`` whose header differs makes
    the read fail, and so does a column of ``schema`` that the header lacks.

    A line that does not fit keeps its readable fields and carries its text in
    ``_corrupt_record``; see :func:`split_corrupt`. Fields are read as text and
    cast here: a reader that casts by itself would miss a bad value in any
    column the query happens not to use.
    """
    named = spark.read.option("header", True).csv(path).columns
    if missing := sorted(set(schema.names) - set(named)):
        raise ValueError(f"{path} has no columns {missing}")
    raw = StructType([StructField(name, StringType()) for name in [*named, CORRUPT]])
    lines = (
        spark.read.schema(raw)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    misfit = reduce(
        Column.__or__, [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema]
    )
    text = F.when(misfit, F.to_csv(F.struct(*named)))
    return lines.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], F.coalesce(CORRUPT, text).alias(CORRUPT)
    )


def parse_lines(lines: DataFrame, columns: Sequence[str], schema: StructType, text: str = "value") -> DataFrame:
    """CSV lines as rows of ``schema``, with the text of those that do not fit in ``_corrupt_record``.

    ``columns`` are the names of the header, in its order; header lines themselves
    drop out. A line has to be one record. Works on a table and on a stream, where no
    reader can tell a misfit from a value that is not there.
    """
    if missing := sorted(set(schema.names) - set(columns)):
        raise ValueError(f"the header has no columns {missing}")
    raw = StructType([StructField(name, StringType()) for name in [*columns, CORRUPT]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.filter(F.col(text) != ",".join(columns)).select(text, F.from_csv(text, raw.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    misfit = reduce(
        Column.__or__,
        [F.col(f"r.{f.name}").isNotNull() & F.col(f"r.{f.name}").try_cast(f.dataType).isNull() for f in schema],
        F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(),
    )
    return parsed.select(
        *[F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema], F.when(misfit, F.col(text)).alias(CORRUPT)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the raw-text column, and the rejected rows with it."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def _scan(spark: SparkSession, source: str | dict[str, str], schema: StructType) -> DataFrame:
    """A Parquet path, or the options of a JDBC source, projected to ``schema``'s columns."""
    df = read_jdbc(spark, source) if isinstance(source, dict) else spark.read.parquet(source)
    return df.select(*schema.names)


def read_transactions(spark: SparkSession, source: str | dict[str, str]) -> DataFrame:
    """The seven transaction columns; column pruning keeps the rest on disk."""
    return _scan(spark, source, TRANSACTIONS)


def read_master(spark: SparkSession, source: str | dict[str, str]) -> DataFrame:
    """All declared master-data columns."""
    return _scan(spark, source, MASTER)


def preview(df: DataFrame, n: int | None = None) -> DataFrame:
    """The whole table, or ``n`` of its rows to look at."""
    return df if n is None else df.limit(n)
