"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, mixing, byte-level BPE.

Each stage reads all that the one before kept. The first four return the columns of documents. The mixture is the order
of the rows; the last stage reads it from the files and lays the token stream out in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.llm import exact, mixing, parity_join, registry, toxicity
from ledgerspark.staging import stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return toxicity.drop_toxic(docs, registry.category_labels(spark, sf_dir), registry.CATEGORIES)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the longest, on a tie the one with the smallest id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 on five-word shingles connect, the one with the smallest id."""
    return parity_join.drop_near_duplicates(docs, width=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that sources interleave by weight."""
    return mixing.in_mixed_order(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, in the order in which the files hold the documents.

    mix_position is a document's number in that order, first_token the number of tokens before its own: where it starts
    in the token stream of the mixture. The documents are encoded under their positions, since ids may repeat.
    """
    placed = mixing.laid_positions(docs)
    digests = registry.bpe_digests(placed.select(F.col("_position").alias("doc_id"), "text"))
    encoded = stage_table(digests.withColumnRenamed("doc_id", "mix_position"), "encoded")
    ids = placed.select(F.col("_position").alias("mix_position"), F.col("doc_id").cast("bigint").alias("doc_id"))
    stream = mixing.total_before(encoded.join(ids, "mix_position"), "mix_position", "n_tokens", "first_token")
    return (
        stream.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "mix_position", "first_token")
        .repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_texts),
]
#: The classifier and the tokenizer are not SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one stage keeps is written and read again for the next."""
    docs = registry.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage_table(docs, "pipeline")
    return docs
