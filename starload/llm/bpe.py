"""Byte-level BPE encoding and decoding (operator 4).

The tokenizers library encodes Arrow batches. Its model is made from a rank file:
bytes become characters by the byte-level table, the merges are all pairs of
tokens that make another, in the order of its rank, and a match of the pattern
that is itself a token is taken at once. Ids equal those of the rank file's own
library. Character offsets follow from the tokens' byte lengths: a token that
holds part of a character has that whole character in its span. Decoding reverses
the byte table; bytes of a split character join again with those of the next ids.

Cases: a null text counts as empty and has no ids; a text of any length is encoded
whole; repeated rows and ties get equal results; an empty table gives an empty
result; an input column named like a new one is replaced, all others stay. Ids
that are null or empty decode to no bytes; an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, runs, texts, with_columns, workers_import
from .wordpieces import PartEncoder, byte_characters

RANKS = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 1 << 20


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a rank file."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [found.get(i, b"") for i in range(max(found) + 1)]


@cache
def vocabulary(path: str) -> list[str]:
    """Each id's token, with a character for each byte."""
    chars = byte_characters()
    return ["".join([chars[b] for b in t]) for t in token_bytes(path)]


@cache
def tokenizer(path: str, pattern: str):
    """A tokenizers.Tokenizer with the ranks' vocabulary."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    named = vocabulary(path)
    vocab = {n: i for i, n in enumerate(named) if n}
    merges = [(n[:k], n[k:]) for n in named for k in range(1, len(n)) if n[:k] in vocab and n[k:] in vocab]
    out = Tokenizer(models.BPE(vocab, merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return out


@cache
def _encoder(path: str, pattern: str) -> PartEncoder:
    tokens = token_bytes(path)
    return PartEncoder(tokenizer(path, pattern), lambda i: len(tokens[i]), len(tokens), np.ndarray.tobytes)


@cache
def _lengths(path: str) -> np.ndarray:
    return np.array([len(t) for t in token_bytes(path)], np.int64)


def spans(ids: np.ndarray, data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token's span, in characters of the text."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    char = np.concatenate(([0], np.cumsum(begins)))  # characters that begin before a byte
    return char[starts + 1] - 1 if len(ids) else starts, char[ends]


Batches = Iterator[pa.RecordBatch]


def _encoded(batches: Batches, ranks: str, pattern: str, text_col: str, offsets: bool) -> Batches:
    path = public_tokenizers.path(ranks)
    for b in batches:
        data, at = texts(b[text_col])
        for lo, hi in runs(at, BATCH_BYTES):
            own = [bytes(data[at[i] : at[i + 1]]) for i in range(lo, hi)]
            coded = [np.frombuffer(b"".join(v), np.int32) for v in _encoder(path, pattern)([t.decode() for t in own])]
            cols = {"ids": coded}
            if offsets:
                found = [spans(i, t, _lengths(path)) for i, t in zip(coded, own, strict=True)]
                cols |= {"starts": [f[0] for f in found], "ends": [f[1] for f in found]}
            yield with_columns(b.slice(lo, hi - lo), {k: _lists(v) for k, v in cols.items()})


def _decoded(batches: Batches, ranks: str, ids_col: str) -> Batches:
    # The tokens' characters, turned to bytes by the reversed table.
    back = {c: b for b, c in enumerate(byte_characters())}
    made = [bytes([back[c] for c in token]) for token in vocabulary(public_tokenizers.path(ranks))]
    for b in batches:
        lists = b[ids_col]
        out = []
        for i in range(len(lists)):
            own = lists[i].values.to_numpy(zero_copy_only=False).tolist() if lists[i].is_valid else []
            if own and (min(own) < 0 or max(own) >= len(made)):
                raise ValueError("an id outside the vocabulary")
            out.append(b"".join([made[x] for x in own]))
        yield with_columns(b, {"decoded": pa.array(out, pa.binary())})


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", offsets: bool = False) -> DataFrame:
    """Adds ``ids`` and, if asked for, ``starts`` and ``ends`` (character offsets)."""
    workers_import(docs.sparkSession)
    new = {"ids": "array<int>"} | ({"starts": "array<int>", "ends": "array<int>"} if offsets else {})
    return docs.mapInArrow(lambda batches: _encoded(batches, ranks, pattern, text_col, offsets), added(docs, new))


def decode(coded: DataFrame, ranks: str = RANKS, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes of the ids."""
    workers_import(coded.sparkSession)
    return coded.mapInArrow(lambda batches: _decoded(batches, ranks, ids_col), added(coded, {"decoded": "binary"}))


def encode_and_decode(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, text_col: str = "text") -> DataFrame:
    """Adds ``ids`` and ``decoded`` in one pass of the Python workers."""
    workers_import(docs.sparkSession)
    run = lambda batches: _decoded(_encoded(batches, ranks, pattern, text_col, False), ranks, "ids")
    return docs.mapInArrow(run, added(docs, {"ids": "array<int>", "decoded": "binary"}))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def round_trip(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` from ids and decoded bytes."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return encode_and_decode(given).select("doc_id", *digests())


def digests() -> list:
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def encoded_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` with the digests of their ids and decoded bytes;
    a column named like a new one is replaced."""
    done = encode_and_decode(docs.withColumn("text", F.col("text").cast("string")))
    new = ("n_tokens", "ids_sha256", "decoded_sha256")
    return done.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (*new, "ids", "decoded")], *digests())
