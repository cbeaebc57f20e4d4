"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinlink.llm import mixing, near_dedup, packing, secret_scan, toxicity
from kinlink.llm.common import crc_fold, cut, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones outside the held-out fold, doesn't call toxic."""
    net = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(crc_fold() != 2))
    return toxicity.score(docs, net, keep=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies."""
    return near_dedup.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each finding replaced by its kind."""
    return secret_scan.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, with its place in a sequence."""
    return packing.pack(packing.pieces(docs, TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained network, whole-set similarity, checksums and bin packing are not SQL; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
