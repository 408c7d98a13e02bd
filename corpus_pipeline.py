"""Training-corpus pipeline: documents to token digests in five stages.

Each stage works on all that its predecessor kept and returns the columns of
``documents``; the last returns the encoded documents. ``run`` writes every
stage's result as Parquet to the shared folder and reads it again, so that a
lost executor never costs more than the stage at hand.

Defined cases: null, empty and blank texts have too few words for the quality
rules and go there, as does any text that a later stage leaves without words;
very long texts are taken whole; rows equal in id and text are one document to
line and near dedup and stay together; rows with a null id pass near dedup
unlinked; an empty table gives an empty result; further columns pass unchanged,
whatever their names, up to the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstream.llm import bpe, decontaminate, host_quality, line_chunks, near_dup
from quillstream.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and their host's verdict reject go."""
    return host_quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that occurred before go; so does a document that loses all its words."""
    return line_chunks.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id."""
    return near_dup.first_of_each_group(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document left."""
    return bpe.encoded_digests(docs)


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", benchmark_free), ("bpe", encode)]

#: Merge rounds, registers and rolling hashes have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
