"""MinHash near-duplicates with sequential Bayesian verification (operator 2).

1. Each text's set of distinct five-word shingles (A-Z lower-cased) gives a
   signature of ``BANDS * ROWS`` minima and a 128-bit name of the set. Texts with
   equal sets form a class; only its smallest doc_id goes on.
2. Classes that share a band of the signature are joined into candidate clusters
   (a superset of the true components).
3. Within a cluster, candidates' signatures are compared batch by batch. A pair
   leaves as soon as the posterior chance that its similarity reaches the
   threshold, given the matches so far, falls below ``MISS``. Survivors are
   verified on their full sets: 100 * intersection >= percent * union.
   A pair whose ends are already joined by verified links needs no verification,
   so what leaves a task is a spanning forest and never all pairs.
4. Components of the verified links, named by the smallest doc_id.

A cluster too large for one task is split into blocks; each pair of blocks is a
task of its own, so no group is ever held whole. The two large joins are merge
joins at every size, so the work grows evenly and hot keys can be split.

The chance that a linked pair shares no band is (1 - s**ROWS)**BANDS for the
similarity s: 1e-9 at 0.85, 3e-6 at 0.8, and far less above.

Cases: null, empty and wordless texts have an empty set and are linked with
nothing; a null doc_id takes part in no link, has a null component and is kept;
repeated rows get equal results, and rows that share a doc_id but not their text are
each named by their own text's component; an empty table gives an empty result; texts of
any length are taken whole. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed_groups, text_or_empty, texts, workers_import, written
from .components import components
from .words import chunks, mix, shingle_sets

WIDTH = 5
PERCENT = 85
BANDS, ROWS = 54, 7
BATCH = 42
#: Chance, for each comparison, to drop a pair that reaches the threshold.
MISS = 1e-9
#: A task compares two blocks of about so many documents or bytes at most.
BLOCK_DOCS = 512
BLOCK_BYTES = 8 << 20

_N = BANDS * ROWS
_A = (mix(np.arange(1, _N + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(10_001, 10_001 + _N, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_ROW = mix(np.arange(20_001, 20_001 + ROWS, dtype=np.uint64)) | np.uint64(1)
_BAND = mix(np.arange(30_001, 30_001 + BANDS, dtype=np.uint64))
_STEP = 1024


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_N, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), _STEP):
        h = _A[:, None] * x[None, lo : lo + _STEP]
        h += _B[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    return mix((sig.reshape(*sig.shape[:-1], BANDS, ROWS).astype(np.uint64) * _ROW).sum(axis=-1, dtype=np.uint64) + _BAND)


@cache
def least_matches(percent: int, miss: float = MISS) -> tuple[int, ...]:
    """For each number of batches the fewest matches with which a pair stays.

    With a uniform prior and m matches among n, the posterior chance of a
    similarity of at least t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, _N + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, at = texts(b["text"])
        ids = b["doc_id"]
        for c in chunks(data, at, lower=True):
            sizes, names, bands = [], [], []
            for s in shingle_sets(c, WIDTH):
                sizes.append(len(s))
                names.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(signature(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(c.first, c.n), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_id", "bands"],
            )


def candidates(sig_i: np.ndarray, sig_j: np.ndarray, key_i: np.ndarray, key_j: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Estimated similarity of one signature with some others, -1 for pairs that
    share no band or were pruned."""
    alive = np.flatnonzero((key_j == key_i).any(axis=1))
    matches = np.zeros(len(alive), np.int64)
    for k, least in enumerate(least_matches(percent)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches += (sig_j[alive, part] == sig_i[part]).sum(axis=1)
        stay = matches >= least
        alive, matches = alive[stay], matches[stay]
        if not len(alive):
            break
    out = np.full(len(sig_j), -1.0)
    out[alive] = matches / _N
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def forest(ids: list[int], sets: list[np.ndarray], left: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Verified links that join the members as all their links would. ``left``
    marks the first of two blocks: pairs within one block are left to others."""
    root = list(range(len(ids)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sig = np.stack([signature(s) for s in sets])
    keys = band_keys(sig)
    links = []
    for i in range(len(ids) - 1):
        others = np.arange(i + 1, len(ids))
        if left is not None:
            others = others[left[others] != left[i]]
        if not len(others):
            continue
        seen = candidates(sig[i], sig[others], keys[i], keys[others], percent)
        for k in np.argsort(-seen, kind="stable"):
            if seen[k] < 0:
                break
            j = int(others[k])
            x, y = top(i), top(j)
            if x != y and linked(sets[i], sets[j], percent):
                root[max(x, y)] = min(x, y)
                links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return links


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for (_, x, y), t in keyed_groups(batches, ["cluster", "x", "y"]):
        data, at = texts(t["text"])
        sets = [s for c in chunks(data, at, lower=True) for s in shingle_sets(c, WIDTH)]
        left = None if x == y else np.array(t["block"].to_pylist()) == x
        if links := forest(t["doc_id"].to_pylist(), sets, left, percent):
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; links reach ``percent``."""
    spark = docs.sparkSession
    workers_import(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    signed = written(given.mapInArrow(_signed, "doc_id long, n_shingles long, set_id binary, bands array<long>"), "signatures")

    known = signed.where("set_id is not null and doc_id is not null")
    classes = written(known.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")), "classes")

    # Candidate clusters: in each band bucket every class hangs on the smallest one.
    banded = classes.select("rep", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    edges = banded.join(buckets.select("key", "least").hint("merge"), "key").where("rep > least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    clusters = components(edges, "candidates")

    # Texts of clustered classes, in blocks.
    sized = given.select("doc_id", "text", F.octet_length("text").alias("bytes")).join(clusters.hint("merge"), F.col("doc_id") == F.col("node"))
    # A doc_id that names several texts brings each of them once.
    members = written(sized.select("component", "doc_id", "text", "bytes").distinct(), "members")
    weights = members.groupBy("component").agg(F.count("*").alias("docs"), F.sum("bytes").alias("all_bytes"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("all_bytes") / BLOCK_BYTES), F.lit(1))
    placed = members.join(weights.select("component", blocks.cast("int").alias("n")), "component").select(
        F.col("component").alias("cluster"), "doc_id", "text", "n", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int").alias("block")
    )
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "doc_id", "text"
    )
    tasks = dealt.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "doc_id")
    reached = components(tasks.mapInArrow(lambda batches: _verified(batches, percent), "a long, b long"), "links")

    named = classes.select("set_id", "rep").join(reached, F.col("rep") == F.col("node"), "left").select("set_id", F.coalesce("component", "rep").alias("component"))
    return (
        signed.select("doc_id", "n_shingles", "set_id")
        .join(named, "set_id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` that stay: one for each component. Of rows with
    the doc_id that names it, that with the smallest text stays (nulls first)."""
    found = near_duplicates(docs, percent).where("kept").select(F.col("doc_id").alias("id")).distinct().withColumn("k", F.xxhash64("id"))
    # One key without nulls, so that the join's shuffle also serves the window.
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"))
    own = own.withColumn("own_k", F.xxhash64("own_id"))
    held = own.join(found, (F.col("own_k") == F.col("k")) & F.col("own_id").eqNullSafe(F.col("id")), "left_semi")
    rest = F.to_json(F.struct(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "text"]))
    order = Window.partitionBy("own_k", "own_id").orderBy(F.col("row").getField("text"), rest)
    held = held.withColumn("nth", F.row_number().over(order)).where("own_id is null or nth = 1")
    return held.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
