"""Quality rules by line sequence labelling (operator 5).

A linear-chain conditional random field labels each line of a text as content or
boilerplate; Viterbi decoding gives the best sequence and a text is kept if enough
of its words lie in content lines. Plain counts of words, symbols, repeated lines
and repeated word windows stand before it as base rules.

The field is trained here, by maximum likelihood with L2 regularisation, on at
most ``TRAIN_DOCS`` labelled documents of each quality (one text for each id), of each
of which one run of at most ``TRAIN_LINES`` neighbouring lines is taken. The labels of
lines are hidden; a document's quality only makes content or boilerplate likelier in it
(``PRIOR``). So labels and field are learned in turns (hard expectation
maximisation): first from lines alone, each bearing its document's quality; then
``ROUNDS`` times the lines are labelled by the best sequence under field and prior, and
the field is trained on those sequences. Decoding always covers whole texts.

Cases: a null or empty text has no words and fails the base rules; lines without
words take part in the sequence and weigh nothing; a text of any length is decoded
whole; repeated rows and ties get equal results; an empty table gives an empty
result. Without labelled documents of both qualities nothing can be learned: the
field is neutral and every line is content. An input column named like a new one
is replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, texts, with_columns, workers_import
from .words import Chunk, chunks, span_hashes, windows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A text is kept if at least this share of its words lies in content lines.
CONTENT_SHARE = 0.5
TRAIN_DOCS = 1500
TRAIN_LINES = 200
PRIOR = 0.5
ROUNDS = 2
SEED = 11
STEPS = 150
FIRST_STEPS = 50
L2 = 0.1

_KIND = {"symbol": b"#*$%&|<>", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "mark": b"!?", "stop": b".,;:", "web": b"@/\\_=+~^{}[]"}
_IS = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for k, v in _KIND.items()}
_IS["wide"] = np.arange(256) >= 0xC0  # first byte of a character beyond ASCII
_NOT_TAIL = (np.arange(256) & 0xC0) != 0x80
#: Share thresholds at which a line's features switch on.
_STEPS = (0.02, 0.05, 0.1, 0.2, 0.4)
_SHARES = ("symbol", "upper", "digit", "mark", "stop", "web", "repeated", "same")
FEATURES = 1 + len(_SHARES) * len(_STEPS) + 7


@dataclass
class Lines:
    """The lines of a chunk: which text, words, and features."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    repeated: np.ndarray  # equal to an earlier line of the text, with a word
    at: np.ndarray  # number of each text's first line, and the end


def per_span(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends] - total[starts]


def seen_before(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier in the same group."""
    order = np.lexsort((np.arange(len(key)), key, group))
    same = np.zeros(len(key), bool)
    same[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return same


def found_twice(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether a key occurs twice or more in its group."""
    order = np.lexsort((key, group))
    same = (key[order[1:]] == key[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def lines_of(c: Chunk, hashes: np.ndarray, twice: np.ndarray) -> Lines:
    """``twice``: for each word whether it lies in a repeated three-word window."""
    breaks = np.flatnonzero(c.data == 10)
    starts = np.sort(np.concatenate((c.at[:-1], breaks + 1)), kind="stable")
    # A text's end closes its last line; a line break closes the one before it.
    ends = np.sort(np.concatenate((c.at[1:], breaks)), kind="stable")
    doc = np.repeat(np.arange(c.n), np.diff(np.searchsorted(breaks, c.at)) + 1)
    first, last = np.searchsorted(c.starts, starts), np.searchsorted(c.starts, ends)
    n_words = last - first
    chars = np.maximum(per_span(_NOT_TAIL[c.data], starts, ends), 1)
    count = {k: per_span(v[c.data], starts, ends) for k, v in _IS.items()}
    letters = np.maximum(count["upper"] + count["lower"] + count["wide"], 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    share = {
        "symbol": count["symbol"] / chars, "upper": count["upper"] / letters, "digit": count["digit"] / chars, "mark": count["mark"] / chars,
        "stop": count["stop"] / chars, "web": count["web"] / chars, "repeated": per_span(twice, first, last) / np.maximum(n_words, 1), "same": per_span(again, first, last) / np.maximum(n_words, 1),
    }
    line_hash = span_hashes(c.data, starts, ends)
    repeated = np.zeros(len(starts), bool)
    real = n_words > 0
    repeated[real] = seen_before(doc[real], line_hash[real])
    out = np.zeros((len(starts), FEATURES), np.float32)
    out[:, 0] = 1
    for i, k in enumerate(_SHARES):
        for j, t in enumerate(_STEPS):
            out[:, 1 + i * len(_STEPS) + j] = share[k] > t
    mean = chars / np.maximum(n_words, 1)
    final = np.zeros(len(starts), np.uint8)
    full = ends > starts
    final[full] = c.data[ends[full] - 1]
    extra = (repeated, ~real, n_words < 4, n_words < 10, mean > 12, mean < 3.5, np.isin(final, np.frombuffer(b'.!?"', np.uint8)))
    for j, v in enumerate(extra):
        out[:, FEATURES - len(extra) + j] = v
    return Lines(doc, n_words, out, repeated, np.searchsorted(doc, np.arange(c.n + 1)))


@dataclass
class Field:
    """Scores of the labels boilerplate (0) and content (1): ``emit[f, y]`` for each
    feature, ``move[y, z]`` for neighbouring lines."""

    emit: np.ndarray
    move: np.ndarray


NEUTRAL = Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)))


def _by_length(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    return order, n[order]


def viterbi(scores: np.ndarray, at: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label of each line; a tie goes to content. All texts of a chunk advance together."""
    labels = np.ones(len(scores), np.int8)
    order, n = _by_length(at)
    begin = at[:-1][order]
    if not len(n) or not n[0]:
        return labels
    back = np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(n), 2))
    for t in range(int(n[0])):
        live = int(np.searchsorted(-n, -t))  # texts longer than t
        i = begin[:live] + t
        if t:
            come = best[:live, :, None] + move[None]
            back[i] = come[:, 1] >= come[:, 0]
            best[:live] = come.max(axis=1) + scores[i]
        else:
            best[:live] = scores[i]
    now = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for t in range(int(n[0]) - 1, -1, -1):
        live = int(np.searchsorted(-n, -t))
        i = begin[:live] + t
        labels[i] = now[:live]
        now[:live] = np.where(now[:live] == 1, back[i, 1], back[i, 0])
    return labels


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis)
    return m + np.log(np.exp(a - np.expand_dims(m, axis)).sum(axis=axis))


def train(features: np.ndarray, labels: np.ndarray, at: np.ndarray, steps: int = STEPS, l2: float = L2, kinds: np.ndarray | None = None) -> Field:
    """Maximum likelihood by gradient ascent (Adam), forward-backward over all
    sequences at once; the two qualities of sequences (``kinds``; default: that of the
    first line) weigh alike."""
    order, n = _by_length(at)
    order, n = order[n > 0], n[n > 0]
    begin, longest = at[:-1][order], int(n[0])
    kind = labels[begin] if kinds is None else kinds[order]
    weight = np.where(kind == 1, 0.5 / max((kind == 1).sum(), 1), 0.5 / max((kind == 0).sum(), 1)) * len(n)
    w = np.zeros((FEATURES + 2, 2))  # the last two rows are the moves
    m, v = np.zeros_like(w), np.zeros_like(w)
    onehot = np.eye(2)[labels]
    live = [int(np.searchsorted(-n, -t)) for t in range(longest)]
    own = np.zeros(len(features), np.int64)  # number of each line's sequence
    for t in range(longest):
        own[begin[: live[t]] + t] = np.arange(live[t])
    line_weight = weight[own][:, None]
    gold = np.zeros((2, 2))
    for t in range(1, longest):
        i = begin[: live[t]] + t
        np.add.at(gold, (labels[i - 1], labels[i]), weight[: live[t]])
    for step in range(1, steps + 1):
        scores, move = features @ w[:FEATURES], w[FEATURES:]
        ahead, behind = np.zeros((len(scores), 2)), np.zeros((len(scores), 2))
        for t in range(longest):
            i = begin[: live[t]] + t
            ahead[i] = scores[i] + (_log_add(ahead[i - 1][:, :, None] + move[None], 1) if t else 0)
        z = _log_add(ahead[begin + n - 1], 1)
        pair = np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            i = begin[: live[t]] + t
            come = (scores[i] + behind[i])[:, None, :] + move[None]
            behind[i - 1] = _log_add(come, 2)
            p = np.exp(ahead[i - 1][:, :, None] + come - z[: live[t], None, None])
            pair += (p * weight[: live[t], None, None]).sum(axis=0)
        p = np.exp(ahead + behind - z[own][:, None])
        grad = np.zeros_like(w)
        grad[:FEATURES] = features.T @ ((onehot - p) * line_weight)
        grad[FEATURES:] = gold - pair
        grad = (grad - l2 * w) / len(n)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(w[:FEATURES], w[FEATURES:])


def line_labels(features: np.ndarray, at: np.ndarray, field: Field, kinds: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Best label of each training line under the field, where the quality of its document
    adds ``prior`` to the score of its like."""
    scores = features @ field.emit
    for y in (0, 1):
        scores[:, y] += prior * (np.repeat(kinds, np.diff(at)) == y)
    return viterbi(scores, at, field.move)


def learn(features: np.ndarray, at: np.ndarray, kinds: np.ndarray, rounds: int = ROUNDS) -> tuple[Field, np.ndarray]:
    """Field and line labels from sequences whose documents' qualities are known."""
    single = np.arange(len(features) + 1)
    labels = np.repeat(kinds, np.diff(at))
    field = train(features, labels, single, steps=FIRST_STEPS)
    field = Field(field.emit, np.zeros((2, 2)))
    for _ in range(rounds):
        labels = line_labels(features, at, field, kinds)
        if len(set(labels.tolist())) < 2:
            break
        field = train(features, labels, at, kinds=kinds)
    return field, labels


@dataclass
class Counts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    lines: Lines


def counts_of(c: Chunk) -> Counts:
    """Base counts and lines of a chunk's texts."""
    hashes = span_hashes(c.data, c.starts, c.ends)
    n_words = np.diff(c.word_at)
    win, win_at = windows(hashes, c.word_at, 3)
    n_win = np.diff(win_at)
    doc = np.repeat(np.arange(c.n), n_win)
    marked = found_twice(doc, win)
    first = np.arange(len(win)) + np.repeat(c.word_at[:-1] - win_at[:-1], n_win)
    twice = np.zeros(len(hashes), bool)
    for k in range(3):
        twice[first[marked] + k] = True
    lines = lines_of(c, hashes, twice)
    chars = np.concatenate(([0], np.cumsum(_NOT_TAIL[c.data], dtype=np.int64)))
    in_words = np.concatenate(([0], np.cumsum(chars[c.ends] - chars[c.starts])))
    return Counts(
        n_words, np.diff(in_words[c.word_at]), per_span(_IS["symbol"][c.data], c.at[:-1], c.at[1:]),
        np.bincount(lines.doc[lines.repeated], minlength=c.n), per_span(twice, c.word_at[:-1], c.word_at[1:]), lines,
    )


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Train on a sample of labelled documents, the same at each run. The sample's
    line features, at most ``TRAIN_DOCS * TRAIN_LINES`` lines of each quality, reach the driver."""
    workers_import(docs.sparkSession)
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = known.where("quality = 0").orderBy(order, "doc_id").limit(TRAIN_DOCS).unionByName(known.where("quality = 1").orderBy(order, "doc_id").limit(TRAIN_DOCS))
    # At most 2 * TRAIN_DOCS ids: small by that limit.
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    held = held.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = texts(b["text"])
            ids, kinds = b["doc_id"].to_pylist(), b["quality"].to_pylist()
            for c in chunks(data, at):
                lines = counts_of(c).lines
                packed = np.packbits(lines.features.astype(bool), axis=1)
                rows = []
                for i in range(c.n):
                    own = packed[lines.at[i] : lines.at[i + 1]]
                    if (more := len(own) - TRAIN_LINES) > 0:  # one run of neighbours
                        skip = ids[c.first + i] % (more + 1)
                        own = own[skip : skip + TRAIN_LINES]
                    rows.append((ids[c.first + i], kinds[c.first + i], own.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["doc_id", "quality", "lines"])

    rows = sorted(tuple(r) for r in held.mapInArrow(run, "doc_id long, quality int, lines binary").collect())
    if len({r[1] for r in rows}) < 2:
        return NEUTRAL
    width = (FEATURES + 7) // 8
    parts = [np.unpackbits(np.frombuffer(bytes(r[2]), np.uint8).reshape(-1, width), axis=1)[:, :FEATURES] for r in rows]
    at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return learn(np.concatenate(parts).astype(np.float32), at, np.array([r[1] for r in rows]))[0]


NEW = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "content_words": "long", "n_lines": "long", "content_lines": "long"}


def label_lines(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """Adds the base counts and what the field decides of each text's lines."""
    workers_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = texts(b[text_col])
            for c in chunks(data, at):
                k = counts_of(c)
                label = viterbi(k.lines.features @ field.emit, k.lines.at, field.move)
                content = np.bincount(k.lines.doc, weights=k.lines.words * label, minlength=c.n)
                cols = (k.n_words, k.word_chars, k.n_symbols, k.n_dup_lines, k.n_repeat_words, content, np.diff(k.lines.at), np.bincount(k.lines.doc, weights=label, minlength=c.n))
                yield with_columns(b.slice(c.first, c.n), {n: pa.array(v.astype(np.int64)) for n, v in zip(NEW, cols, strict=True)})

    return docs.mapInArrow(run, added(docs, NEW))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def kept():
    return ~base_failed() & (F.col("content_words") >= CONTENT_SHARE * F.col("n_words"))


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = label_lines(given, fit(docs, labels))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), kept().alias("kept"), "content_words", "n_lines", "content_lines")


def passing(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their own columns."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    done = label_lines(own, fit(training, labels)).where(kept())
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
