"""A corpus from raw documents to packed sequences: each stage is one operator of ``cyclerlake.llm``.

A stage gets what its predecessor kept, as a Parquet table, and all but the last return the columns
of ``documents``. The last returns the places of all pieces: doc_id, piece, start, length,
ids_crc32, sequence_id, offset. Document ids may repeat there, because the mix takes documents of
small sources up to three times. SQL can express neither the learned stage nor the fingerprints,
so there is no SQL for the whole; the tests compare it with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclerlake.llm import exact_dedup, mixing, packing, simhash, toxicity
from cyclerlake.llm.common import landed, table
from cyclerlake.llm.queries import shared_folder, tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest id stays."""
    return simhash.near_deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
