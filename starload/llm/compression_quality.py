"""Quality classifier by compression (operator 8).

Two zstandard dictionaries are trained, on pieces of good and of bad labelled
texts. A text is cut into pieces of ``PIECE`` bytes and each piece is compressed
with both; the difference of the compressed sizes, divided by the text's size, is
high where the text resembles the good ones. A logistic curve over this difference
and a term for short texts (which cannot differ much), fitted on labelled texts that
the dictionaries have not seen, turns it into a score from 0 to 1.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2, on
at most ``TRAIN_DOCS`` documents of each label, ``PIECES`` pieces each for the
dictionaries; every text is scored whole. Scores depend on the text alone.

Cases: a null text counts as empty; an empty text has difference 0 and the score
of that with full shortness; a null doc_id is not held out; repeated rows and ties get equal scores; an
empty table gives an empty result. With labels of one kind or none every score is
that kind's share (0.5 without labels). Only needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, runs, text_or_empty, texts, with_columns, workers_import

PIECE = 256
PIECES = 6
TRAIN_DOCS = 3000
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
SEED = 23
THRESHOLD = 0.7
HELD_OUT = 2
BATCH_BYTES = 1 << 20
#: Bytes of a text that counts as half short.
SHORT = 100.0


@dataclass(frozen=True)
class Model:
    """Dictionaries of the labels and the calibration: score = 1 / (1 + exp(-curve)) with
    curve = the weights times 1, difference, shortness, difference * shortness."""

    good: bytes
    bad: bytes
    curve: tuple[float, float, float, float]


def fold(c: str = "doc_id"):
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(4))


def held_out():
    return F.coalesce(fold() == HELD_OUT, F.lit(False))


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_dict_id=False)


def difference(data: bytes, good: bytes, bad: bytes) -> float:
    """(size with the bad dictionary - size with the good one) / size, 0 for an empty text."""
    if not data:
        return 0.0
    one, other = _compressor(good).compress, _compressor(bad).compress
    total = 0
    for i in range(0, len(data), PIECE):
        p = data[i : i + PIECE]
        total += len(other(p)) - len(one(p))
    return total / len(data)


def _terms(d, size):
    """What the curve weighs; for numbers, arrays and columns. Shortness falls from 1 (empty) to 0."""
    short = SHORT / (SHORT + size)
    return 1.0 + 0 * d, d, short, d * short


def logistic(X: np.ndarray, y: np.ndarray, steps: int = 60, l2: float = 1e-3) -> np.ndarray:
    """Weights by damped Newton steps."""
    scale = np.maximum(X.std(axis=0), 1e-6)
    scale[0] = 1.0
    X = X / scale
    w = np.zeros(X.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        grad = X.T @ (y - p) - l2 * w
        hess = (X * (p * (1 - p))[:, None]).T @ X + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def _differences(df: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """Adds ``difference`` to rows with ``text``."""
    workers_import(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = texts(b["text"])
            for lo, hi in runs(at, BATCH_BYTES):
                found = [difference(bytes(data[at[i] : at[i + 1]]), good, bad) for i in range(lo, hi)]
                yield with_columns(b.slice(lo, hi - lo), {"difference": pa.array(found, pa.float64())})

    return df.mapInArrow(run, added(df, {"difference": "double"}))


def _pieces(df: DataFrame) -> DataFrame:
    """Some pieces of each text, chosen by a hash over the whole text."""
    workers_import(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = texts(b["text"])
            rows = []
            for i, (d, q) in enumerate(zip(b["doc_id"].to_pylist(), b["quality"].to_pylist(), strict=True)):
                n = -(-(at[i + 1] - at[i]) // PIECE)
                pick = np.random.default_rng([SEED, d & 0xFFFFFFFF]).permutation(n)[:PIECES] if n else []
                rows += [(d, q, bytes(data[at[i] + k * PIECE : min(at[i] + (k + 1) * PIECE, at[i + 1])])) for k in sorted(pick)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["doc_id", "quality", "piece"])

    return df.mapInArrow(run, "doc_id long, quality int, piece binary")


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few for training."""
    raw = b"".join(samples)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, len(raw) // 4)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return raw[-DICTIONARY_BYTES:]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Half of the sampled documents make the dictionaries, the others the curve."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    side = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(2)).alias("side")
    chosen = known.where("quality = 0").orderBy(order, "doc_id").limit(TRAIN_DOCS).unionByName(known.where("quality = 1").orderBy(order, "doc_id").limit(TRAIN_DOCS))
    # At most 2 * TRAIN_DOCS ids: small by that limit.
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen.select("*", side)), "doc_id")
    pieces = sorted(tuple(r) for r in _pieces(held.where("side = 0").select("doc_id", "quality", "text")).collect())
    shares = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    samples = {q: [bytes(p) for _, k, p in pieces if k == q] for q in (0, 1)}
    whole = sum(shares.values())
    if not samples[0] or not samples[1]:
        share = shares.get(1, 0) / whole if whole else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    good, bad = _dictionary(samples[1]), _dictionary(samples[0])
    seen = _differences(held.where("side = 1").select("doc_id", "quality", "text"), good, bad)
    seen = sorted(tuple(r) for r in seen.select("doc_id", "quality", "difference", F.octet_length("text")).collect())
    if len({r[1] for r in seen}) < 2:
        return Model(good, bad, (0.0, 50.0, 0.0, 0.0))
    d, size = np.array([r[2] for r in seen]), np.array([r[3] or 0 for r in seen], float)
    w = logistic(np.column_stack(_terms(d, size)), np.array([r[1] for r in seen], float))
    return Model(good, bad, tuple(float(x) for x in w))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` and ``predicted`` to rows with ``text``."""
    done = _differences(docs, model.good, model.bad)
    terms = _terms(F.col("difference"), F.octet_length(text_or_empty()).cast("double"))
    raw = 1 / (1 + F.exp(-sum(F.lit(w) * t for w, t in zip(model.curve, terms, strict=True))))
    return done.withColumn("score", raw).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).drop("difference")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(given, fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def passing(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are predicted to be good, with their own columns."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    done = scored(own, fit(training, labels)).where("predicted = 1")
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
