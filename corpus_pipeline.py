"""A corpus pipeline over ``documents``: each stage reads what the one before kept, written as Parquet.

Rows without text or ``doc_id``, repeated rows, further columns and empty tables go through every stage as its operator
states; the stages before the last return the columns they are given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, decontaminate, personal_data, simhash, toxicity
from tidemark.llm.shared import reachable, stored, table


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    reachable(spark)
    return toxicity.clean(docs, table(sf_dir, "labels", spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, as SimHash links them, stays: that with the smallest ``doc_id``."""
    reachable(spark)
    return simhash.first_of_each_group(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    reachable(spark)
    return decontaminate.clean(docs, table(sf_dir, "benchmark", spark))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    reachable(spark)
    return personal_data.mask(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: the ids of every document, and the text they decode to."""
    reachable(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    made = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks, pattern)
    size = F.floor(F.octet_length("ids") / 4).cast("long")
    return made.select("doc_id", size.alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", non_toxic),
    ("near_copies", near_copies),
    ("decontamination", uncontaminated),
    ("personal_data", masked),
    ("byte_bpe", encoded),
]
#: SQL cannot express the stages; they are held against brute force in ``tests/llm``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(sf_dir, "documents", spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
