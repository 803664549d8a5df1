"""The operators as registered queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    alignment,
    centroids,
    decontamination,
    language_id,
    mixing,
    neighbours,
    pii,
    quality,
    secret_scan,
    sentencepiece_codec,
    simhash,
    token_counts,
    warc,
)
from martloom.llm.oracle import ORACLE_SQL  # noqa: F401
from martloom.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of pieces, a digest of their ids, parity, and whether decoding gives the text back."""
    coded = sentencepiece_codec.with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("pieces.ids").cast("long").alias("n_pieces"),
        F.lower(F.lpad(F.hex(F.xxhash64("pieces.ids")), 16, "0")).alias("ids_hash"),
        "pieces.parity",
        (F.col("pieces.decoded") == F.replace("text", F.lit(sentencepiece_codec.SPACE), F.lit(" "))).alias("round_trip"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(documents, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(quality.remainder() == 2, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "tokens.n_words", "tokens.n_tokens", "tokens.n_unknown")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# The session setting that holds the secret of a deployment. Without it the test tables get a
# key that anybody knows, so that reruns agree.
SURROGATE_KEY, TEST_KEY = "spark.martloom.pii.key", "martloom"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(SURROGATE_KEY, TEST_KEY)
    replaced = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return replaced.select("doc_id", F.size("entities").cast("long").alias("n_entities"), "text")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_secrets": op7_secrets,
    "op8_token_counts": op8_token_counts,
    "op9_neighbours": op9_neighbours,
    "op10_pii": op10_pii,
    "op11_centroids": op11_centroids,
    "op12_alignment": op12_alignment,
    "op13_mixing": op13_mixing,
}
