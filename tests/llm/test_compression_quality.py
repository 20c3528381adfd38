"""Operator 8: held-out accuracy, and nothing learned from held-out labels."""

import zlib

from pyspark.sql import functions as F

from starload.llm import compression_quality as q
from tests.llm import helpers as h


def test_held_out_rows_by_checksum(spark):
    ids = [0, 1, 2, 17, -5, 12345678901]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long").select("doc_id", q.held_out().alias("out"))
    assert {r.doc_id: r.out for r in df.collect()} == {**{i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}, None: False}


def test_accuracy_on_held_out_documents(spark):
    docs, labels = h.documents(spark, h.SF01), h.labels(spark, h.SF01)
    got = q.quality(docs, labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    assert sum((r.score - r.quality) ** 2 for r in rows) / len(rows) < 0.06


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = h.documents(spark), h.labels(spark)
    plain = sorted(map(tuple, q.quality(docs, labels).collect()))
    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string"), "score": F.lit(3), "difference": F.lit("y")})
    assert sorted(map(tuple, q.quality(other, turned).collect())) == plain


def test_difference():
    good, bad = b"".join(b"the quick brown fox jumps over it. %d " % i for i in range(400)), b"$$$ %%% ### && | || " * 400
    assert q.difference(b"", good, bad) == 0.0
    assert q.difference(b"a quick brown fox jumps over it " * 30, good, bad) > 0 > q.difference(b"$$$ %%% ### && | " * 40, good, bad)
    text = bytes(range(256)) * 9 + b"tail"
    whole = sum(len(q._compressor(bad).compress(text[i : i + q.PIECE])) - len(q._compressor(good).compress(text[i : i + q.PIECE])) for i in range(0, len(text), q.PIECE))
    assert q.difference(text, good, bad) == whole / len(text)


def test_odd_rows(spark):
    docs, labels = h.documents(spark), h.labels(spark)
    model = q.fit(docs, labels)
    got = q.scored(h.clashing(spark, "score", "predicted").select("doc_id", "text", "score"), model).collect()
    assert len(got) == len(h.ODD)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1 and len({r.score for r in got if r.doc_id in (1, 7)}) == 1
    assert q.scored(h.empty(spark), model).collect() == []
    assert q.quality(h.empty(spark), labels).collect() == []
    ones = q.quality(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(ones) == 1 and ones[0].score > 0.99
    assert {r.score for r in q.quality(docs, labels.limit(0)).collect()} == {0.5}
    few = q.quality(docs, labels.where("quality = 0").limit(8).union(labels.where("quality = 1").limit(8)))
    assert few.where("score between 0 and 1").count() == docs.count()
    keep = h.clashing(spark, "row", "difference")
    assert q.passing(keep, docs, labels).columns == keep.columns
