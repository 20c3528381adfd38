"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, compression_quality, digest, filter_audit, language_centroids, line_quality, mixing, neardup, sharding, token_counts, vector_codes, warc, wrapper
from .common import table


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprints(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.uniform_shards(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_texts(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


def op13_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_centroids.languages(table(spark, sf_dir, "documents"))


_ALL = (
    op1_document_fingerprints,
    op2_near_duplicates,
    op3_sharding,
    op4_byte_bpe,
    op5_line_quality,
    op6_source_mixing,
    op7_token_counts,
    op8_compression_quality,
    op9_main_text,
    op10_warc,
    op11_filter_audit,
    op12_vector_codes,
    op13_language_centroids,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

#: Only where SQL can express the result.
ORACLES: dict[str, str] = {"op10_warc": warc.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op12_vector_codes": vector_codes.ORACLE}
