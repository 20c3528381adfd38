"""Document fingerprints: quartile bucket digests (operator 1).

Every window of five bytes gives the six byte triplets that contain its last
byte (fewer near the start of a text); each triplet is hashed into one of
``BUCKETS`` counters. The digest holds two bits for each bucket, its quartile
among the buckets, behind a header with the logarithm of the text's length, the
quartiles' ratios and a check byte. The difference of two digests adds the
distances of the bucket codes and of the header and is bounded, so a likeness
from 0 to 1 follows.

Cases: a null text counts as empty; an empty text and one of fewer than three
bytes have only zero counts, so only length and check byte tell them apart;
texts that are equal have equal digests; any length is digested whole, in
blocks. Repeated rows and equal doc_ids stay, ordered by doc_id, then text, and
null doc_ids come first. An empty table gives an empty result. Other columns of
the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, workers_import, written

BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
#: Distances (newest to middle, newest to oldest byte) of a window's triplets.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
BLOCK = 1 << 18
#: Weight of a bucket pair in opposite quartiles, and the difference at which likeness is 0.
FAR = 6
LIMIT = 2 * BUCKETS
HEADER = 4


def bucket_counts(data: np.ndarray) -> np.ndarray:
    """How often a triplet of the bytes falls in each bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(len(data), 1), BLOCK):
        b = data[max(0, lo - 4) : lo + BLOCK].astype(np.uint32)
        new = min(lo, 4)  # bytes before these belong to the last block
        for k, (mid, old) in enumerate(TRIPLETS):
            i = max(new, old)
            if len(b) <= i:
                continue
            n = len(b)
            h = b[i:] * np.uint32(0x9E3779B1) + b[i - mid : n - mid] * np.uint32(0x85EBCA77)
            h += b[i - old : n - old] * np.uint32(0xC2B2AE3D) + np.uint32((k + 1) * 0x27D4EB2F & 0xFFFFFFFF)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            total += np.bincount(h >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return total


def digest(data: bytes) -> bytes:
    counts = bucket_counts(np.frombuffer(data, np.uint8))
    ranked = np.sort(counts)
    q1, q2, q3 = (int(ranked[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    length = min(255, round(8 * np.log2(1 + len(data))))
    ratio = lambda q: 15 if not q3 else 15 * q // q3
    head = bytes([hashlib.blake2b(data, digest_size=1).digest()[0], length, ratio(q1) << 4 | ratio(q2), 0])
    return head + body.astype(np.uint8).tobytes()


def encode(raw: bytes) -> str:
    """A digest as text."""
    return base64.b64encode(raw).decode()


_PAIR = np.arange(256, dtype=np.int16)
_CODES = np.stack([_PAIR >> s & 3 for s in (0, 2, 4, 6)])


def difference(a: bytes, b: bytes) -> int:
    """Bounded difference score of two digests, 0 to ``LIMIT``; 0 for equal ones."""
    if a == b:
        return 0
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    gap = np.abs(_CODES[:, x[HEADER:]] - _CODES[:, y[HEADER:]])
    score = int(gap.sum()) + (FAR - 3) * int((gap == 3).sum())
    score += abs(int(x[1]) - int(y[1])) * BUCKETS // 512
    score += (abs(int(x[2] >> 4) - int(y[2] >> 4)) + abs(int(x[2] & 15) - int(y[2] & 15))) * BUCKETS // 256
    return min(LIMIT, score + (a[0] != b[0]))


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / LIMIT


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


#: What tasks write; texts of digests are made from the bytes at the end.
RAW = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_TYPES = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
_FIELDS = [(n, _TYPES[t]) for n, t in (c.split() for c in RAW.split(", "))]


def _row(doc_id, text: str, raw: bytes, following: str, next_raw: bytes) -> tuple:
    changed = edited(text, following)
    data = changed.encode()
    own = digest(data)
    return (doc_id, len(text), hashlib.sha256(data).digest(), raw, own, likeness(raw, own), likeness(raw, next_raw))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted texts in, result rows out (kind 0). A partition's last text waits for
    the next partition: kinds 1 and 2 carry the first and the last text."""
    empty = [None] * len(_FIELDS)
    part = doc_id = text = raw = None
    rows: list[tuple] = []
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string()), *_FIELDS])
    out = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    for b in batches:
        for p, d, t in zip(b["part"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
            new = digest(t.encode())
            if text is None:
                rows.append((1, p, t, d, *empty[1:]))
            else:
                rows.append((0, p, None, *_row(doc_id, text, raw, t, new)))
            part, doc_id, text, raw = p, d, t, new
            if len(rows) >= 500:
                yield out()
                rows = []
    if text is not None:
        rows.append((2, part, text, doc_id, *empty[1:]))
    if rows:
        yield out()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [_row(d, t, digest(t.encode()), f, digest(f.encode())) for d, t, f in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["following"].to_pylist(), strict=True)]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*made, strict=True), _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest of each text and of the text edited with its successor by id.

    One range shuffle sorts the texts by id; a partition is then read once, in
    order, holding one text at a time. Only the first and last text of each
    partition meet those of its neighbours afterwards.
    """
    spark = docs.sparkSession
    workers_import(spark)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    made = written(ordered.mapInArrow(_slices, "kind int, part int, text string, " + RAW), "fingerprints")
    # One first and one last row for each partition: the successor of a last text
    # is the first of the next partition that has rows, or the first of all.
    order = Window.orderBy("part")
    first = made.where("kind = 1").select("part", F.col("text").alias("following"))
    steps = first.select("part").withColumns({"after": F.lead("part").over(order), "least": F.min("part").over(Window.partitionBy())})
    ends = (
        made.where("kind = 2")
        .select("part", "doc_id", "text")
        .join(steps.select("part", F.coalesce("after", "least").alias("next_part")), "part")
        .join(first.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "following")
    )
    done = made.where("kind = 0").select(*[n for n, _ in _FIELDS]).unionByName(ends.mapInArrow(_ends, RAW))
    base64 = lambda c: F.translate(F.base64(c), "\r\n", "")  # noqa: E731  one line, whatever the session's setting
    as_text = {"edited_sha256": F.lower(F.hex("edited_sha256")), "fingerprint": base64("fingerprint"), "edited_fingerprint": base64("edited_fingerprint")}
    return done.withColumns(as_text)
