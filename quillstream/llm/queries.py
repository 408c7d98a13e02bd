"""Registered queries of the training-data operators: one ``opN_<name>`` for each,
over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstream.llm import (bpe, cotrain, decontaminate, host_quality, line_chunks, near_dup, resampling, runs, secrets, sharding, substring_dedup,
                             token_files, warc)
from quillstream.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document, with host-level verdicts."""
    return host_quality.quality_rules(table(spark, sf_dir, "documents"))


@_register
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return bpe.encoded_digests(table(spark, sf_dir, "documents"))


@_register
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register
def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@_register
def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeated multi-line chunks take from every document."""
    return line_chunks.line_report(table(spark, sf_dir, "documents"), copies=True)


@_register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record kind and payload of every page, read back from normalised archives."""
    return warc.archive_report(table(spark, sf_dir, "pages"))


@_register
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, count and checksum of every document's ids, read back from seekable files."""
    return token_files.token_files(table(spark, sf_dir, "documents"))


@_register
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans and those that window entropy adds."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@_register
def op10_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document from two co-trained views."""
    return cotrain.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows repeated anywhere take away."""
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


@_register
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document after a uniform shuffle into shards of equal row counts."""
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@_register
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and its text without their repetitions."""
    return runs.run_report(table(spark, sf_dir, "documents"))


@_register
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark's n-grams, and the rank of those drawn."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
