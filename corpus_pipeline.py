"""Corpus pipeline: from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``:

1. quality rules: documents that fail the base rules or hold mostly boilerplate
   lines go;
2. quality classifier: documents that resemble bad ones go;
3. MinHash near-dedup: documents whose sets of five-word shingles are similar by 0.8
   or more form groups; one of each stays, that with the smallest id;
4. mixing: each source gives its target number of words, in whole blocks;
5. byte-level BPE: ids, digests of ids and of the decoded bytes.

The models of 1 and 2 are trained on the labelled rows of ``documents`` in
``sf_dir``, of which the first two stages' input is a part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm import bpe, compression_quality, line_quality, mixing, neardup
from starload.llm.common import table, written


NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.passing(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression_quality.passing(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL cannot express the trained models, the signatures and the seeded blocks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
