"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns they were given. No stage needs a table other than
its documents, except ``labels`` for the first and ``benchmark`` for the third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontamination, quality, secret_scan, sentencepiece_codec, simhash
from martloom.llm.shared import spare, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be good.

    NULL and empty texts are scored by the model's constant alone. Repeated rows have
    the same score and stay or go together; a score that ties with the threshold
    stays. An empty table gives an empty one; extra columns pass through.
    """
    name = spare(docs, "_quality")
    scored = quality.with_quality(docs, table(spark, sf_dir, "labels"), name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).drop(name)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest number of each near-duplicate group.

    NULL, empty and blank texts have the fingerprint zero and are one group. Of rows
    of a group with the same number one stays, chosen by a total order over what they
    hold; rows without a number stay. An empty table gives an empty one; extra columns
    pass through.
    """
    return simhash.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item.

    NULL and empty texts contain none and stay; repeated rows stay or go together. An
    empty table or benchmark takes nothing out; extra columns pass through.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their text.

    NULL and empty texts stay as they are and repeated rows are masked alike. An
    empty table gives an empty one; extra columns pass through, ``n_chars`` follows the text.
    """
    return secret_scan.redacted(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``token_ids``, ``n_tokens``, the ``decoded`` text and ``parity`` with the original library.

    A NULL text has no ids and no tokens, an empty one an empty list. Repeated rows are
    coded alike and an empty table gives an empty one. Extra columns pass through, but
    one named like a new column is replaced.
    """
    name = spare(docs, "_pieces")
    coded = sentencepiece_codec.with_pieces(docs, name=name)
    return coded.withColumns(
        {
            "token_ids": F.col(f"{name}.ids"),
            "n_tokens": F.coalesce(F.size(f"{name}.ids"), F.lit(0)),
            "decoded": F.col(f"{name}.decoded"),
            "parity": F.col(f"{name}.parity"),
        }
    ).drop(name)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

# The first, second and last stage have no equal in SQL; tests compare every
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
