"""Language identification by nearest centroid (operator 13).

A text is lower-cased; every run of characters that are no letters is one gap. Its
features are the runs of one to three letters, those at a word's ends also with the gap,
hashed to ``BUCKETS`` numbers. A text's vector holds (1 + ln count) * idf, scaled to
length 1; idf = 1 + ln((1 + texts) / (1 + texts with the feature)) counts all texts that
may be learned from. The vectors of a language's sample are clustered by cosine into up
to ``CLUSTERS`` groups; the scaled means are the language's centroids. A text's language
is that of the centroid with the largest cosine. Its distance is 1 - cosine; beyond
the limit of that centroid (the ``REACH`` quantile of its own members' distances, and
``SLACK`` on top) the text is rejected: ``rejected`` is set, and ``identified`` gives
``und`` on request. The score is the softmax share of the language's best cosine
(times ``SHARPNESS``) among those of all languages.

Languages are learned only from rows with a lang and a doc_id whose
crc32(doc_id as text) mod 4 is not 2. Bounds of the fit: ``SAMPLE`` texts of each of the
``LANGUAGES`` most frequent languages, chosen by hash. The model is BUCKETS * CLUSTERS *
languages floats, 39 MB at the bound. Texts are read whole, long ones in pieces.

Cases: a null text and one without letters have lang ``und``, score 0, no distance and are
not rejected; so has every text when nothing could be learned. A row with a null doc_id
is neither held out nor learned from. Repeated rows get equal results and count once in the
sample; equal cosines go to the language first in code point order. An empty table gives no rows;
only needed columns are read, so further ones do not clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import added, with_columns, workers_import
from .compression_quality import held_out
from .words import mix

BITS = 14
BUCKETS = 1 << BITS
WIDTHS = (1, 2, 3)
CLUSTERS = 3
SAMPLE = 400
SPARE = 2.0
LANGUAGES = 200
ITERATIONS = 12
REACH = 0.995
SLACK = 0.05
SHARPNESS = 12.0
SEED = 41
UNKNOWN = "und"
#: Texts and characters that are counted at once; a longer text is counted in pieces.
TEXTS = 64
PIECE = 1 << 18


@dataclass(frozen=True)
class Model:
    """Languages in code point order; row ``k`` of the centroids belongs to ``languages[owner[k]]``."""

    languages: tuple[str, ...]
    owner: np.ndarray
    centroids: np.ndarray  # (clusters, BUCKETS)
    limits: np.ndarray
    idf: np.ndarray

    @cached_property
    def by_bucket(self) -> np.ndarray:
        return np.ascontiguousarray(self.centroids.T)


@cache
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for first in (range(0xD800), range(0xE000, 0x110000)):
        table[first.start : first.stop] = [chr(c).isalpha() for c in first]
    return table


def _symbols(text: str) -> np.ndarray:
    """Code points in lower case; 0 for each character that is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    points[~_letters()[points]] = 0
    return points


def _features(symbols: np.ndarray, text: np.ndarray, fresh: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature that ends at or behind position ``fresh``."""
    found = []
    for width in WIDTHS:
        n = len(symbols) - width + 1
        if n <= 0:
            continue
        columns = [symbols[k : k + n] for k in range(width)]
        ok = text[:n] == text[width - 1 :]
        if fresh:
            ok[: max(0, fresh - width + 1)] = False
        if width == 1:
            ok &= columns[0] != 0
        else:  # a gap only at one end
            for c in columns[1:-1]:
                ok &= c != 0
            ok &= (columns[0] != 0) | (columns[-1] != 0) if width > 2 else (columns[0] != 0) & (columns[-1] != 0)
        at = np.flatnonzero(ok)
        h = np.full(len(at), width, np.uint64)
        for c in columns:
            h = h * np.uint64(0x9FB21C651E98DF25) + c[at]
        found.append((text[at], (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([t for t, _ in found]), np.concatenate([b for _, b in found])


def _squeezed(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of gaps within a text as one gap."""
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0) | (text[1:] != text[:-1])
    return symbols[keep], text[keep]


def _long_counts(text: str) -> np.ndarray:
    """Feature counts of one text, read piece by piece."""
    total, carry = np.zeros(BUCKETS, np.int64), np.zeros(1, np.uint64)
    for lo in range(0, len(text) + 1, PIECE):
        piece = text[lo : lo + PIECE]
        end = [np.zeros(1, np.uint64)] if lo + PIECE > len(text) else []
        symbols = np.concatenate([carry, _symbols(piece), *end])
        joined, _ = _squeezed(symbols, np.zeros(len(symbols), np.int64))
        _, bucket = _features(joined, np.zeros(len(joined), np.int64), len(carry) if lo else 0)
        total += np.bincount(bucket, minlength=BUCKETS)
        carry = joined[-(max(WIDTHS) - 1) :]
    return total


def counts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of some texts at a time: number of the first, then (text, bucket, count) of
    their features in ascending order; ``text`` counts from that first one."""
    lo = 0
    gap = np.zeros(1, np.uint64)
    while lo < len(texts):
        if len(texts[lo] or "") > PIECE:
            c = _long_counts(texts[lo])
            at = np.flatnonzero(c)
            yield lo, np.zeros(len(at), np.int64), at, c[at]
            lo += 1
            continue
        hi, size = lo, 0
        while hi < len(texts) and hi - lo < TEXTS and (hi == lo or size + len(texts[hi] or "") <= PIECE):
            size += len(texts[hi] or "")
            hi += 1
        parts = [np.concatenate([gap, _symbols(t or ""), gap]) for t in texts[lo:hi]]
        owner = np.repeat(np.arange(hi - lo), [len(p) for p in parts])
        text, bucket = _features(*_squeezed(np.concatenate(parts), owner))
        c = np.bincount((text << BITS) + bucket, minlength=(hi - lo) << BITS)
        at = np.flatnonzero(c)
        yield lo, at >> BITS, at & (BUCKETS - 1), c[at]
        lo = hi


def vectors(texts: list[str | None], idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Like ``counts``, with weights of unit length in place of the counts."""
    for first, text, bucket, n in counts(texts):
        w = (1 + np.log(n)) * idf[bucket]
        norm = np.sqrt(np.bincount(text, w * w))
        yield first, text, bucket, w / norm[text]


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def document_frequencies(learn: DataFrame) -> tuple[int, np.ndarray]:
    """Texts with letters, and of them those with each feature: one aggregate over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for _, text, bucket, _ in counts(_column(b, "text")):
                seen += np.bincount(bucket, minlength=BUCKETS)
                n += len(np.unique(text))
        at = np.flatnonzero(seen)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*seen[at].tolist(), n], pa.int64())], names=["bucket", "n"])

    found = learn.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    total = 0
    for r in found.collect():  # at most BUCKETS + 1 rows
        if r.bucket < 0:
            total = r.n
        else:
            out[r.bucket] = r.n
    return total, out


def sampled(learn: DataFrame) -> DataFrame:
    """``lang, text``: at most ``SAMPLE`` different rows of each of the ``LANGUAGES`` most
    frequent languages. Only hashes are ranked, and of a language with n different rows only
    the ``SPARE`` * SAMPLE / n least of them, about; the texts come by a join with the chosen ones."""
    rows = learn.withColumn("at", F.xxhash64(F.lit(SEED), "doc_id", "text"))
    common = rows.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("at").alias("n")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES)
    least = F.col("at").cast("double") / 2.0**64 + 0.5 < SPARE * SAMPLE / F.col("n")
    different = rows.select("lang", "at").join(F.broadcast(common), "lang").where(least).select("lang", "at").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    chosen = different.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).select("lang", "at")
    # At most SAMPLE * LANGUAGES pairs: small by that limit.
    return rows.join(F.broadcast(chosen), ["lang", "at"], "left_semi").groupBy("lang", "at").agg(F.min("text").alias("text"))


def clusters(x: np.ndarray, most: int = CLUSTERS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit rows grouped by cosine, and each row's centroid.

    Starts from equal shares of the rows along their direction of largest variance.
    """
    k = max(1, min(most, len(x) // 8))
    middle = x - x.mean(0)
    line = middle[0] if np.abs(middle[0]).any() else np.ones(x.shape[1])
    for _ in range(8):
        line = middle.T @ (middle @ line)
        size = np.linalg.norm(line)
        if not size:
            break
        line = line / size
    of = np.zeros(len(x), np.int64)
    of[np.argsort(middle @ line, kind="stable")] = np.arange(len(x)) * k // len(x)
    for _ in range(ITERATIONS):
        centre = np.stack([x[of == j].mean(0) for j in range(k) if (of == j).any()])
        centre /= np.linalg.norm(centre, axis=1, keepdims=True)
        now = (x @ centre.T).argmax(1)
        k = len(centre)
        if (now == of).all():
            break
        of = now
    used = np.unique(now)
    return centre[used], np.searchsorted(used, now)


def _fitted(sample: DataFrame, idf: np.ndarray) -> DataFrame:
    """``lang, cluster, reach, weights``: each language's centroids, one task a language."""

    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, order = _column(b, "lang"), _column(b, "at")
            for first, text, bucket, w in vectors(_column(b, "text"), idf):
                for i in np.unique(text):
                    mine = text == i
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([langs[first + i]]), pa.array([order[first + i]]), pa.array([bucket[mine].tolist()], pa.list_(pa.int32())), pa.array([w[mine].tolist()], pa.list_(pa.float64()))],
                        names=["lang", "at", "buckets", "weights"],
                    )

    def group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        x = np.zeros((rows.num_rows, BUCKETS), np.float32)
        for i, (b, w) in enumerate(zip(rows["buckets"].to_pylist(), rows["weights"].to_pylist(), strict=True)):
            x[i, b] = w
        centre, of = clusters(x)
        apart = 1 - (x * centre[of]).sum(1)
        reach = [float(np.quantile(apart[of == j], REACH)) for j in range(len(centre))]
        return pa.table({
            "lang": pa.array([rows["lang"][0].as_py()] * len(centre)), "cluster": pa.array(range(len(centre)), pa.int32()),
            "reach": reach, "weights": [c.astype("<f4").tobytes() for c in centre],
        })

    found = sample.mapInArrow(vectorised, "lang string, at long, buckets array<int>, weights array<double>")
    return found.groupBy("lang").applyInArrow(group, "lang string, cluster int, reach double, weights binary")


def fit(docs: DataFrame) -> Model:
    workers_import(docs.sparkSession)
    learn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    learn = learn.where("doc_id is not null and text is not null and lang is not null").where(~held_out())
    total, having = document_frequencies(learn)
    idf = 1 + np.log((1 + total) / (1 + having))
    rows = sorted(_fitted(sampled(learn), idf).collect(), key=lambda r: (r.lang, r.cluster))  # CLUSTERS a language
    languages = tuple(sorted({r.lang for r in rows}))
    centroids = np.array([np.frombuffer(r.weights, "<f4") for r in rows], np.float32).reshape(len(rows), BUCKETS)
    return Model(languages, np.array([languages.index(r.lang) for r in rows], int), centroids, np.array([r.reach + SLACK for r in rows]), idf)


def nearest(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, distance (NaN: none) and whether it is beyond the limit, for each text."""
    lang = [UNKNOWN] * len(texts)
    score, distance, far = np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
    if not model.languages:
        return lang, score, distance, far
    weights = model.by_bucket
    starts = np.searchsorted(model.owner, np.arange(len(model.languages)))
    for first, text, bucket, w in vectors(texts, model.idf):
        if not len(text):
            continue
        begin = np.flatnonzero(np.diff(text, prepend=-1))
        which = text[begin] + first
        cosine = np.empty((len(begin), len(weights[0])))
        for lo, hi, row in zip(begin, [*begin[1:], len(text)], range(len(begin)), strict=True):
            cosine[row] = w[lo:hi] @ weights[bucket[lo:hi]]
        best = np.maximum.reduceat(cosine, starts, axis=1)
        near = best.argmax(1)
        share = np.exp(SHARPNESS * (best - best.max(1, keepdims=True)))
        score[which] = share[np.arange(len(near)), near] / share.sum(1)
        own = np.where(model.owner == near[:, None], cosine, -np.inf).argmax(1)
        distance[which] = np.clip(1 - best[np.arange(len(near)), near], 0, 1)
        far[which] = distance[which] > model.limits[own]
        for i, k in zip(which.tolist(), near.tolist(), strict=True):
            lang[i] = model.languages[k]
    return lang, score, distance, far


def identified(docs: DataFrame, model: Model, reject: bool = False) -> DataFrame:
    """Adds ``lang_pred, score, distance, rejected`` to rows with ``text``; with ``reject``
    a rejected text's language is ``und``."""
    workers_import(docs.sparkSession)
    new = {"lang_pred": "string", "score": "double", "distance": "double", "rejected": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, distance, far = nearest(_column(b, "text"), model)
            if reject:
                lang = [UNKNOWN if f else x for x, f in zip(lang, far.tolist(), strict=True)]
            yield with_columns(b, {
                "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score),
                "distance": pa.array(distance, mask=np.isnan(distance)), "rejected": pa.array(far),
            })

    return docs.mapInArrow(run, added(docs, new))


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, distance, rejected`` of each document."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = identified(given, fit(docs))
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "distance", "rejected")
