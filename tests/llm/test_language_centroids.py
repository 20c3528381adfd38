"""Language identification: features, counts, model and choice against plain Python, and
held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from starload.llm import language_centroids as lc
from tests.llm.helpers import SF01, SCHEMA, clashing, documents, empty, odd

MASK = (1 << 64) - 1


def mixed(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
    return h ^ (h >> 31)


def features(text):
    """Bucket counts, one letter after the other."""
    s = [0]
    for c in text.lower():
        if c.isalpha():
            s.append(ord(c))
        elif s[-1]:
            s.append(0)
    if s[-1]:
        s.append(0)
    out = Counter()
    for n in lc.WIDTHS:
        for i in range(len(s) - n + 1):
            g = s[i : i + n]
            gaps = [k for k, c in enumerate(g) if not c]
            if n == 1 and gaps or n == 2 and gaps or n == 3 and gaps not in ([], [0], [2]):
                continue
            h = n
            for c in g:
                h = (h * 0x9FB21C651E98DF25 + c) & MASK
            out[mixed(h) >> (64 - lc.BITS)] += 1
    return out


def weighted(text, idf):
    w = {b: (1 + math.log(n)) * idf[b] for b, n in features(text).items()}
    size = math.sqrt(sum(x * x for x in w.values()))
    return {b: x / size for b, x in w.items()}


TEXTS = ["", None, "   ", "12 34 !?", "a", "A b", "Straße ÉTÉ déjà-vu", "日本語 テキスト", "x" * 300, "ab. " * 70_000, "İstanbul ΟΔΟΣ", "ﬁn ́ é", "𝒳𝒴 \U0001f600z", "\x00a\x00b"]


def test_counts_equal_plain_counting():
    got = {}
    for first, text, bucket, n in lc.counts(TEXTS * 11):
        for t, b, c in zip(text.tolist(), bucket.tolist(), n.tolist(), strict=True):
            got.setdefault(first + t, {})[b] = c
    for i, t in enumerate(TEXTS * 11):
        assert got.get(i, {}) == dict(features(t or "")), t and t[:20]


def test_pieces_of_a_long_text(monkeypatch):
    text = ("Der Fluß, die Straße... und 12 Bäume\n" * 9).replace("B", "  Ü ")
    for piece in (1, 2, 5, 17, 10_000):
        monkeypatch.setattr(lc, "PIECE", piece)
        got = lc._long_counts(text)
        assert dict(features(text)) == {int(b): int(got[b]) for b in np.flatnonzero(got)}


def test_document_frequencies_and_choice(spark):
    docs = documents(spark, SF01)
    model = lc.fit(docs)
    rows = [r for r in docs.select("doc_id", "text", "lang").collect()]
    learn = [r for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    seen, n = Counter(), 0
    for r in learn:
        f = features(r.text)
        seen.update(f.keys())
        n += bool(f)
    idf = [1 + math.log((1 + n) / (1 + seen[b])) for b in range(lc.BUCKETS)]
    assert np.allclose(model.idf, idf)
    assert model.languages == tuple(sorted({r.lang for r in learn}))
    assert all((model.owner == k).sum() > 1 for k in range(len(model.languages)))
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    got = {r.doc_id: r for r in lc.identified(docs, model).collect()}
    for r in rows[:150]:
        w = weighted(r.text or "", idf)
        cos = [sum(x * float(c[b]) for b, x in w.items()) for c in model.centroids]
        best = [max(c for c, o in zip(cos, model.owner, strict=True) if o == k) for k in range(len(model.languages))]
        k = max(range(len(best)), key=lambda i: best[i])
        g = got[r.doc_id]
        assert g.lang_pred == model.languages[k]
        assert abs(g.score - 1 / sum(math.exp(lc.SHARPNESS * (b - best[k])) for b in best)) < 1e-6
        assert abs(g.distance - (1 - best[k])) < 1e-6
        assert g.rejected == (1 - best[k] > model.limits[cos.index(max(cos))])


def test_held_out_accuracy(spark):
    docs = documents(spark, SF01)
    got = lc.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert sum(r.rejected for r in got) < 0.1 * len(got)


def test_far_texts_are_rejected(spark):
    docs = documents(spark, SF01)
    model = lc.fit(docs)
    strange = spark.createDataFrame([(1, "Ωμέγα και άλλα πράγματα που δεν έμαθε ποτέ"), (2, "zzz qqq xxx kkk " * 30)], "doc_id long, text string")
    rows = lc.identified(strange, model).collect()
    assert all(r.rejected and r.lang_pred in model.languages for r in rows)
    assert {r.lang_pred for r in lc.identified(strange, model, reject=True).collect()} == {"und"}


def test_clusters_separate_groups():
    rng = np.random.default_rng(3)
    groups = [rng.normal(0, 0.02, (30, 50)) + np.eye(50)[k] for k in (1, 7, 20)]
    x = np.concatenate(groups)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre, of = lc.clusters(x)
    assert len(centre) == 3 and [len(set(of[i : i + 30])) for i in (0, 30, 60)] == [1, 1, 1]
    same = np.tile(x[:1], (40, 1))
    centre, of = lc.clusters(same)
    assert np.allclose(centre[of], same)
    assert len(lc.clusters(x[:1])[0]) == 1


def test_odd_rows(spark):
    more = [(100 + i, f"the house and the garden number {'abcdefghij'[i % 10]} of them", "en", "s", 1) for i in range(40)]
    more += [(200 + i, f"das Haus und der Garten Nummer {'abcdefghij'[i % 10]} von ihnen", "de", "s", 1) for i in range(40)]
    base = spark.createDataFrame(more, SCHEMA)
    got = lc.languages(odd(spark).unionByName(base)).collect()
    assert len(got) == 91
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3
    assert by_id[2].score == 0 and by_id[2].distance is None and by_id[2].rejected is False
    assert by_id[None].held_out is False
    assert {r.lang_pred for r in got if r.doc_id == 7} == {by_id[1].lang_pred} and sum(r.doc_id == 7 for r in got) == 2
    assert all(r.lang_pred in ("en", "de", "fr") for r in got if r.doc_id not in (2, 3, 4))
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert 0 <= r.score <= 1
    names = ["lang_pred", "score", "distance", "rejected", "at", "held_out", "bucket", "rank", "weights"]
    again = lc.languages(clashing(spark, *names).unionByName(base.withColumns({n: F.lit("own") for n in names})))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))


def test_nothing_to_learn(spark):
    assert lc.languages(empty(spark)).count() == 0
    none = lc.languages(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_a_row_repeated_very_often_counts_once(spark):
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(60).select((F.col("id") + 10).alias("doc_id"), F.concat(F.lit("les mots "), F.col("id").cast("string"), F.lit(" une fois")).alias("text"), F.lit("fr").alias("lang"))
    sample = lc.sampled(hot.unionByName(other)).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in sample} == {"en": 1, "fr": 60}
