"""Operator 3: exact counts, a uniform law, DataFrame functions only."""

import zlib
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from starload.llm import sharding
from tests.conftest import plan_text
from tests.llm import helpers as h


def check(got, given, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in given
    )
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_documents(spark):
    docs = h.documents(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    df = sharding.uniform_shards(docs)
    check(df.collect(), given, 40)
    assert "Python" not in plan_text(df, "extended") and "Arrow" not in plan_text(df, "extended")
    split = sharding.uniform_shards(docs.repartition(7), shards=6, block_rows=16)
    check(split.collect(), given, 6)
    again = sharding.uniform_shards(docs, shards=6, block_rows=16).collect()
    assert sorted(map(tuple, split.drop("grown_shard").collect())) == sorted(tuple(r[:-1]) for r in again)


def test_hypergeometric_is_exact(spark):
    """Quantiles of an even grid reproduce the mass of every value."""
    total, good, draws, n = 60, 22, 25, 40_000
    lit = [F.lit(x).cast("long") for x in (total, good, draws)]
    df = spark.range(n).select(sharding.hypergeometric(*lit, (F.col("id") + 0.5) / n).alias("k"))
    got = {r.k: r["count"] / n for r in df.groupBy("k").count().collect()}
    for k in range(max(0, draws + good - total), min(good, draws) + 1):
        mass = comb(good, k) * comb(total - good, draws - k) / comb(total, draws)
        assert abs(got.get(k, 0.0) - mass) <= 1.5 / n
    edge = [(0, 0, 0, 0), (10, 0, 4, 0), (10, 10, 4, 4), (10, 3, 10, 3), (10, 3, 0, 0), (1, 1, 1, 1)]
    for t, g, d, want in edge:
        assert spark.range(1).select(sharding.hypergeometric(*[F.lit(x).cast("long") for x in (t, g, d)], F.lit(0.7)).alias("k")).first().k == want


def test_matrix_has_exact_sums(spark):
    sizes = [0, 5, 17, 0, 40, 1, 9, 30]
    counts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "block long, rows long")
    got = {r.block: r.caps for r in sharding.communication_matrix(counts, 3, sum(sizes), 7, 5).collect()}
    assert {b: sum(c) for b, c in got.items()} == {i: n for i, n in enumerate(sizes) if n}
    assert [sum(c[j] for c in got.values()) for j in range(7)] == [15] * 4 + [14] * 3
    assert min(min(c) for c in got.values()) >= 0


def test_every_row_may_land_anywhere(spark):
    """Over many seeds the shard of a row is uniform."""
    docs = spark.createDataFrame([(i, str(i)) for i in range(12)], "doc_id long, text string").coalesce(1).cache()
    seen = Counter()
    for seed in range(5):
        seen.update((r.doc_id, r.shard) for r in sharding.uniform_shards(docs, shards=3, seed=seed, block_rows=6).collect())
    docs.unpersist()
    by_shard = Counter()
    for (_, s), n in seen.items():
        by_shard[s] += n
    assert set(by_shard.values()) == {20}
    assert len(seen) > 24 and max(seen.values()) < 5


def test_copies_are_dealt_like_other_rows(spark):
    """4000 copies of one row among 8000: along the slots copies and others change places as
    often as in a uniform order, and each shard has its share."""
    docs = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.uniform_shards(docs, block_rows=500).select("doc_id", "shard", "slot").orderBy("shard", "slot").collect()
    kind = [r.doc_id == -1 for r in got]
    changes = sum(a != b for x, y in zip(got, got[1:]) if x.shard == y.shard for a, b in [(x.doc_id == -1, y.doc_id == -1)])
    expected = 7960 * 2 * 0.5 * 4000 / 7999
    assert abs(changes - expected) < 5 * (7960 * 0.25) ** 0.5
    for j in range(40):
        own = [k for k, r in zip(kind, got, strict=True) if r.shard == j]
        assert len(own) == 200 and abs(sum(own) - 100) < 6 * (200 * 0.25) ** 0.5


def test_copies_are_numbered_in_parts(spark):
    df = spark.range(100).select(F.when(F.col("id") < 63, F.lit(None).cast("long")).otherwise(F.col("id") % 30).alias("a"), F.lit("t").alias("b"))
    got = sorted((r.a or -1, r.nth) for r in sharding.numbered(df, ("a", "b"), most=10).collect())
    want = Counter(-1 if i < 63 else i % 30 for i in range(100))
    want = sorted((a if a else -1, k) for a, n in want.items() for k in range(n))
    assert sorted(k for a, k in got if a == -1) == sorted(k for a, k in want if a == -1) and got == want


def test_odd_rows(spark):
    got = sharding.uniform_shards(h.clashing(spark, "size", "shard", "block", "key", "r"), shards=4, block_rows=3).collect()
    check(got, [(d, t) for d, t, *_ in h.ODD], 4)
    assert sharding.uniform_shards(h.empty(spark)).collect() == []
