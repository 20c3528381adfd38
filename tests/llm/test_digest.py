"""Operator 1 against a plain count of triplets and the contract's edit."""

import hashlib

import numpy as np
import pytest

from starload.llm import digest
from tests.conftest import rows
from tests.llm import helpers as h


def plain_counts(data: bytes) -> np.ndarray:
    """One triplet at a time: every window's newest byte with two older ones."""
    out = np.zeros(digest.BUCKETS, np.int64)
    for i in range(len(data)):
        for k, (mid, old) in enumerate(digest.TRIPLETS):
            if i >= old:
                x = (data[i] * 0x9E3779B1 + data[i - mid] * 0x85EBCA77 + data[i - old] * 0xC2B2AE3D + (k + 1) * 0x27D4EB2F) % 2**32
                x ^= x >> 15
                out[(x * 0x2C1B3C6D % 2**32) >> (32 - digest.BUCKET_BITS)] += 1
    return out


@pytest.mark.parametrize("data", [b"", b"a", b"ab", b"abc", b"abcd", "Größe 日本".encode() * 9, bytes(range(256)) * 3])
def test_counts(data, monkeypatch):
    assert (digest.bucket_counts(np.frombuffer(data, np.uint8)) == plain_counts(data)).all()
    monkeypatch.setattr(digest, "BLOCK", 7)
    assert (digest.bucket_counts(np.frombuffer(data, np.uint8)) == plain_counts(data)).all()


def test_difference_is_bounded_symmetric_and_zero_for_equal_texts():
    texts = [b"", b"x", b"a few words", b"a few other words here", b"zzzz" * 5000, bytes(range(256)) * 40]
    for a in texts:
        for b in texts:
            d = digest.difference(digest.digest(a), digest.digest(b))
            assert d == digest.difference(digest.digest(b), digest.digest(a)) and 0 <= d <= digest.LIMIT
            assert (d == 0) == (a == b)
            assert 0 <= digest.likeness(digest.digest(a), digest.digest(b)) <= 1


def test_contract_on_documents(spark):
    docs = h.documents(spark)
    got = {r.doc_id: r for r in digest.fingerprints(docs).collect()}
    given = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert sorted(got) == [d for d, _ in given]
    better = 0
    for (d, text), (_, after) in zip(given, given[1:] + given[:1], strict=True):
        k = len(text) // 2
        changed = text[: len(text) - k] + after[:k]
        own, other, nxt = (digest.digest(x.encode()) for x in (text, changed, after))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (digest.encode(own), digest.encode(other))
        assert r.near_edited == digest.likeness(own, other) and r.near_next == digest.likeness(own, nxt)
        better += r.near_edited > r.near_next
    assert better > 0.95 * len(given)


def test_order_does_not_depend_on_partitions(spark):
    docs = h.documents(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 23)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = rows(digest.fingerprints(docs.repartition(5)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert many == rows(digest.fingerprints(docs))


def test_odd_rows(spark):
    got = digest.fingerprints(h.clashing(spark, "kind", "part", "fingerprint")).collect()
    assert len(got) == len(h.ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].n_chars == 0 and by[2][0].fingerprint == by[3][0].fingerprint
    assert by[1][0].fingerprint == by[7][0].fingerprint == by[7][1].fingerprint
    assert by[5][0].n_chars == 150_000 and len(by[None]) == 1
    assert digest.fingerprints(h.empty(spark)).collect() == []
    one = spark.createDataFrame([(9, "abcdef")], "doc_id long, text string")
    assert digest.fingerprints(one).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
