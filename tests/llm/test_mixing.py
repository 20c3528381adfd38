"""Operator 6 against a plain highest-quotient rule."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starload.llm import mixing
from tests.llm import helpers as h

WORD = re.compile(mixing.WORD)


def plain_seats(wanted, seats, most):
    """One seat at a time to the highest quotient."""
    got = [0] * len(wanted)
    for _ in range(seats):
        open_ = [i for i in range(len(wanted)) if got[i] < most[i] and wanted[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (wanted[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_apportionment_equals_the_plain_rule():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 9)
        wanted = [float(rng.choice((0, 1, 2, 7, 50, 300)) + rng.random()) * (rng.random() < 0.9) for _ in range(n)]
        most = [rng.choice((0, 1, 3, 40, 1000)) for _ in range(n)]
        seats = rng.randint(0, 150)
        assert mixing.apportion(wanted, seats, most) == plain_seats(wanted, seats, most)


def test_quotas_of_shards_add_up():
    sizes, wanted = [900, 50, 4000, 0, 64], [500.0, 150.0, 4000.0, 0.0, 100.0]
    quotas = mixing.shard_quotas(sizes, wanted, shards=5, block=16)
    most = [3 * -(-s // 16) for s in sizes]
    assert all(min(q) >= 0 for q in quotas)
    for k in range(1, 6):
        assert [sum(x) for x in zip(*quotas[:k], strict=True)] == plain_seats(wanted, round(sum(wanted) / 16) * k // 5, most)


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50.0, 100.0, 150.0]
    got = mixing.targets([1000, 10, 10], [1, 2, 3])
    assert got == [960.0, 30.0, 30.0] and mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []
    rng = random.Random(9)
    for _ in range(100):
        sizes = [rng.choice((0, 1, 20, 500, 9000)) for _ in range(rng.randint(1, 8))]
        weights = [1 + i % 3 for i in range(len(sizes))]
        got = mixing.targets(sizes, weights)
        assert sum(got) == pytest.approx(sum(sizes)) and all(g <= 3 * s + 1e-6 for g, s in zip(got, sizes, strict=True))
        free = [g / w for g, s, w in zip(got, sizes, weights, strict=True) if s and g < 3 * s - 1e-6]
        assert max(free, default=0) == pytest.approx(min(free, default=0))


def test_shards_take_their_quotas(spark):
    """Words by shard and source are the shard's quota of blocks, but for a source's short last block."""
    rng = random.Random(6)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.choice((0, 3, 40, 700)))), rng.choice("aabc")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block, shards = 16, 5
    done = mixing.mixed(docs, block=block, shards=shards).select("source", "source_size", "taken", "shard_words", "pieces").collect()
    names = sorted({r[2] for r in rows})
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    wanted = mixing.targets(sizes, [1, 2, 3][: len(names)])
    quotas = mixing.shard_quotas(sizes, wanted, shards, block)
    for j in range(shards):
        for i, n in enumerate(names):
            words = sum(r.shard_words[j] for r in done if r.source == n)
            times_last = -(-quotas[j][i] // max(1, -(-sizes[i] // block)))
            assert abs(words - quotas[j][i] * block) < block * max(1, times_last)
    assert all(sum(r.shard_words) == r.taken and all(p.times == len(p.shards) for p in r.pieces) for r in done)
    # a shard takes most documents whole
    parts = [sum(j in p.shards for p in r.pieces) / len(r.pieces) for r in done for j in range(shards) if any(j in p.shards for p in r.pieces)]
    assert sum(x == 1 for x in parts) > 0.8 * len(parts)


def test_very_many_sources(spark):
    docs = spark.range(100_000).select("id", F.lit("one two three").alias("text"), F.concat(F.lit("s"), "id").alias("source")).withColumnRenamed("id", "doc_id")
    got = mixing.mixed(docs, block=1).agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.sum("size").alias("size")).first()
    assert got.n == 100_000 and abs(got.taken - got["size"]) <= 8



def check(rows, source_of):
    per = defaultdict(lambda: [0, 0, None, None])
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        p = per[source_of(r)]
        p[0], p[1], p[2], p[3] = p[0] + r.size, p[1] + r.taken, r.target, r.source_size
    for size, taken, target, named in per.values():
        assert named == size and abs(taken - target) <= 3 * mixing.BLOCK_WORDS
    return per


def test_documents(spark):
    docs = h.documents(spark)
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = mixing.mix_report(docs).collect()
    assert {r.doc_id: r.size for r in rows} == {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    per = check(rows, lambda r: source[r.doc_id])
    names = sorted(per, key=lambda s: s.encode())
    wanted = mixing.targets([per[s][0] for s in names], [1 + i % 3 for i in range(len(names))])
    assert [per[s][2] for s in names] == wanted
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_ranges_change_nothing(spark, monkeypatch):
    docs = h.documents(spark)
    whole = sorted(map(tuple, mixing.mix_report(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 9)
    assert sorted(map(tuple, mixing.mix_report(docs).collect())) == whole


def test_mixed_documents_hold_the_taken_words(spark):
    docs = h.documents(spark)
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    got = defaultdict(list)
    for r in mix.collect():
        got[r.doc_id].append(r)
        assert r.n_chars == len(r.text)
    assert set(got) == {d for d, r in report.items() if r.taken}
    for d, rows in got.items():
        assert sum(len(WORD.findall(r.text)) for r in rows) == report[d].taken
        own = WORD.findall(text[d])
        for r in rows:  # in order, nothing made up
            it = iter(own)
            assert r.text == text[d] or all(w in it for w in WORD.findall(r.text))


def test_documents_are_taken_whole_but_at_the_ends_of_a_run(spark):
    docs = h.documents(spark, h.SF01)
    text = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    cut = defaultdict(list)
    for r in mixing.mixed_documents(docs).collect():
        if r.text != text[r.doc_id][1]:
            cut[r.source].append(r)
    assert cut and all(len(rows) <= 2 for rows in cut.values())
    for rows in cut.values():  # a span of the text with its lines
        assert all(r.text in text[r.doc_id][1] for r in rows)


def test_parts_of_a_text_keep_their_separators(spark):
    long = "".join(f"{' ' * (i % 3)}\n\tw{i}é\x85 \r\n" for i in range(3000))
    rows = [(i, t, "en", s, None) for i, (t, s) in enumerate([(long, "a"), (long, "b"), (long.strip(), "c"), (long.strip(), "d")])]
    docs = spark.createDataFrame(rows, h.SCHEMA)
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    got = defaultdict(list)
    for r in mixing.mixed_documents(docs).collect():
        assert r.text in rows[r.doc_id][1] and r.n_chars == len(r.text)
        got[r.doc_id].append(len(WORD.findall(r.text)))
    assert {d: sum(n) for d, n in got.items()} == {d: r.taken for d, r in report.items() if r.taken}
    assert any(n < report[d].size for d, ns in got.items() for n in ns)


def test_odd_rows(spark):
    docs = h.clashing(spark, "size", "taken", "target", "k", "row", "pieces", "_time")
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(h.ODD)
    by_source = {"a": 13 + 6, "b": 30_000, "": 5, "c": 9, None: 0}
    size = lambda t: len(WORD.findall(t or ""))
    by_source = defaultdict(int)
    for _, t, _, s, _ in h.ODD:
        by_source[s] += size(t)
    assert sorted(r.source_size for r in rows) == sorted(by_source[s] for _, _, _, s, _ in h.ODD)
    assert all(r.taken <= 3 * r.size for r in rows)
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns
    words = mix.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == sum(r.taken for r in rows)
    assert mixing.mix_report(h.empty(spark)).collect() == [] and mixing.mixed_documents(h.empty(spark)).collect() == []
