"""The cleaning pipeline over ``documents``: (name, function) stages, each written as Parquet and read again.

Each function takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the columns of
``documents``; a stage that changes texts also brings ``n_chars`` up to date.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import line_dedup, ngram_join, packing, secret_scan, toxicity
from starmart.llm.common import table
from starmart.operators.staged import stage


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7, by models learned from the labelled ones."""
    return toxicity.keep_ordinary(docs, toxicity.fit_scorer(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of 20 characters or more that three hold, except in the one of the largest id."""
    return _recounted(line_dedup.dedup_lines(docs).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group whose sets of five-word shingles are linked by a similarity of 0.8 or more."""
    return ngram_join.one_of_each_group(docs, n=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask for each secret found."""
    return _recounted(secret_scan.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.tokenized_pieces(docs, ranks, public_tokenizers.PATTERN, end_id=2, size=1024)
    return packing.pack(pieces, size=1024).withColumnsRenamed({"__sequence": "sequence_id", "__offset": "offset"})


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact),
    ("best_fit_packing", pack),
]

# Language models and a packer are not SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
