"""The pipeline against a plain run of each stage's rule on its own input."""

import os

import __spark_entry__
import corpus_pipeline as cp
from pyspark.sql import functions as F

from starload.llm import bpe, compression_quality, line_quality, mixing, neardup
from starload.llm.common import table, written
from tests.llm import helpers as h
from tests.llm.test_neardup import plain


def test_stages(spark):
    docs = table(spark, h.SF, "documents")
    labels = table(spark, h.SF, "labels")
    columns = docs.columns
    seen = []
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, h.SF), "test-stage")
        ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
        if name == "quality_rules":
            assert ids(out) == ids(line_quality.rules(docs, labels).where("kept"))
        elif name == "quality_classifier":
            model = compression_quality.fit(table(spark, h.SF, "documents"), labels)
            assert ids(out) == ids(compression_quality.scored(docs, model).where("predicted = 1"))
        elif name == "near_dedup":
            parts = plain([(r.doc_id, r.text) for r in docs.collect()], cp.NEAR_PERCENT)
            assert ids(out) == sorted(d for d, (_, c) in parts.items() if d == c)
        elif name == "mix_sources":
            words = out.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n"))
            taken = mixing.mix_report(docs).where("taken > 0")
            assert sorted(map(tuple, words.collect())) == sorted(map(tuple, taken.select("doc_id", "taken").collect()))
        else:
            assert out.columns == [*columns, "n_tokens", "ids_sha256", "decoded_sha256"]
            assert out.where("decoded_sha256 <> sha2(text, 256)").count() == 0 and out.count() == docs.count()
            seen.append(sorted(map(tuple, out.collect())))
        if stage is not cp.STAGES[-1][1]:
            assert out.columns == columns and out.count() > 0
            kept = out.join(docs.select("doc_id").distinct(), "doc_id", "left_anti").count()
            assert kept == 0
        docs = out
    assert sorted(map(tuple, cp.run(spark, h.SF).collect())) == seen[0]


def test_odd_rows_pass_every_stage(spark):
    for docs in (h.odd(spark), h.clashing(spark, "row", "kept", "pieces"), h.empty(spark)):
        for name, stage in cp.STAGES:
            out = written(stage(spark, docs, h.SF), "test-odd")
            assert out.columns[: len(docs.columns)] == docs.columns, name
            out.count()


def test_entry():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert "pipeline" in __spark_entry__.queries() and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "mix_sources", "byte_level_bpe"]
    assert neardup and bpe


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for folder, _, files in os.walk(os.path.join(root, "starload")):
        for f in files:
            if f.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, f)) as src:
                    assert "llm" not in src.read(), f
