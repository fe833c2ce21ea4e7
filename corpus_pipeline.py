"""A corpus pipeline: toxic documents out, one of each class of copies, one of each group of near copies, sources
mixed to target weights, and the mix encoded.

Every stage takes documents and returns documents with the same columns; the last returns the encoded mix.  Null texts count as
empty throughout, empty and very long texts are taken whole, documents without words leave at the mix, of repeated rows and ties one
row stays, null sources are a source of their own, further columns go through to the mix whatever their names, and an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm import exact_dedup, mixing, sentencepiece_codec, simhash, toxicity
from tariffa.llm.common import fold, table
from tariffa.sources.sinks import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return docs.filter(toxicity.score(model) < 0.5)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints of three-word shingles at three bits or fewer, the document with the smallest identifier."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, document by document and once for each pass over its source."""
    out = mixing.mixed_documents(mixing.mix(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they give the text back and agree with the SentencePiece library."""
    found = sentencepiece_codec.encoded(sentencepiece_codec.read_model(sentencepiece_codec.MODEL))
    return docs.withColumn("found", found).select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.col("found.ids").alias("token_ids"),
        F.size("found.ids").cast("long").alias("n_tokens"),
        (F.col("found.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "found.parity",
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# Fitted scores, XXH64 fingerprints, keyed permutations and subword ids have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
