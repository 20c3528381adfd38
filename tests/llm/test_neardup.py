"""Operator 2 against all pairs of a small table."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import neardup
from starload.llm.components import components
from tests.conftest import rows
from tests.llm import helpers as h


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(given, percent=85):
    """{doc_id: (set size, component)} over all pairs."""
    sets = [(d, shingles(t)) for d, t in given]
    root = {d: d for d, _ in given}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                root[hi] = lo
    return {d: (len(s), top(d)) for d, s in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(rng, n, words, changes):
    """A text and edits of it; only the last one is the original that links the others."""
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(changes):
            w[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out + [" ".join(base)]


def test_documents(spark):
    docs = h.documents(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    got = neardup.near_duplicates(docs)
    assert found(got) == plain(given)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


@pytest.mark.parametrize("block", [512, 5])
def test_families_whose_hub_has_the_largest_id(spark, monkeypatch, block):
    """Edits mostly link through the original alone; blocks of few documents give the same result."""
    rng = random.Random(block)
    texts = [t for size, words, changes in ((14, 220, 3), (9, 120, 2), (30, 90, 1), (6, 400, 9)) for t in family(rng, size, words, changes)]
    percent = 85 if block == 512 else 80
    texts += texts[3:8] + [texts[0].upper(), "one two three", "one  two\tthree", "one two", ""]
    given = list(enumerate(texts, start=100))
    monkeypatch.setattr(neardup, "BLOCK_DOCS", block)
    got = found(neardup.near_duplicates(spark.createDataFrame(given, "doc_id long, text string").repartition(4), percent))
    assert got == plain(given, percent)
    assert len({c for _, c in got.values()}) < len(given) / 2


def test_threshold_is_exact(spark):
    """Pairs just below, at and above 85 percent."""
    given = []
    for n, same in ((100, 92), (37, 34), (100, 91), (40, 37), (20, 18), (20, 19)):
        base = [f"{n}-{same}-{i}" for i in range(n + 4)]
        given.append((len(given), " ".join(base)))
        given.append((len(given), " ".join(base[: same + 4] + [f"x{i}" for i in range(n - same)])))
    got = found(neardup.near_duplicates(spark.createDataFrame(given, "doc_id long, text string")))
    assert got == plain(given)


def test_sets_from_arrow_bytes_equal_python_sets():
    import pyarrow as pa

    from starload.llm.common import texts
    from starload.llm.words import chunks, shingle_sets

    given = ["A b C d E f", "a b", "", None, "x" * 3000 + " y", "é È  日 本  z\x0b1\x0c2", " lead and trail \n"] * 3
    for most in (1, 50, 1 << 20):
        data, at = texts(pa.array(given))
        got = [len(s) for c in chunks(data, at, lower=True, most=most) for s in shingle_sets(c, 5)]
        assert got == [len(shingles(t)) for t in given]


def test_pruning_follows_the_posterior():
    """Least matches by direct integration of the Beta posterior."""
    t, grid = 0.85, (np.arange(200_000) + 0.5) / 200_000
    for k, least in enumerate(neardup.least_matches(85)):
        n = neardup.BATCH * (k + 1)
        for m in (least - 1, least):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            tail = p[grid >= t].sum() / p.sum()
            assert (tail >= neardup.MISS) == (m >= least)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    same = (neardup.signature(a) == neardup.signature(b)).mean()
    assert abs(same - 0.5) < 0.08
    x = (a >> np.uint64(32)).astype(np.uint32)
    assert (neardup.signature(a) == np.array([(x * i + j).min() for i, j in zip(neardup._A, neardup._B, strict=True)])).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (21, 21), (5, 5), (21, 20)]
    edges += [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 7, 8, 9), 1), 20: 20, 21: 20, **dict.fromkeys(range(100, 161), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(spark):
    got = rows(neardup.near_duplicates(h.clashing(spark, "bands", "rep", "component_id", "kept")).withColumn("doc_id", F.coalesce("doc_id", F.lit(-99))))
    by = {r[0]: r for r in got}
    assert len(got) == len(h.ODD)
    assert by[2][1:] == (0, 2, True) and by[3][1:] == (0, 3, True) and by[4][1:] == (0, 4, True)
    assert by[1][1:] == (2, 1, True) and by[7][1:] == (2, 1, False) and by[5][1:] == (1, 5, True)
    assert by[-99][2:] == (None, True)
    assert neardup.near_duplicates(h.empty(spark)).collect() == []


def test_one_of_each(spark):
    docs = h.clashing(spark, "row", "nth", "kept")
    got = neardup.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == [-8, 1, 2, 3, 4, 5, 6]
    assert got.where("doc_id is null").count() == 1
