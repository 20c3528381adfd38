"""Vector code compression by active-entry Lloyd (operator 12).

Vectors become integers, floor(``SCALE`` * x), and are cut into equal consecutive
parts. Each part position has a codebook that starts with that part of the smallest
vec_ids and is moved by rounds of Lloyd's method; a vector's code names the nearest
entry of each of its parts.

Between rounds the assigned entries and their exact squared distances are kept with the
vectors. When entries have moved, a part whose own entry stayed is compared with the
moved entries alone, against its stored distance: the others were not nearer before and
are where they were. A part whose own entry moved is compared with all entries.
Distances are whole numbers and equal ones go to the lower index, so the result is that
of comparing everything.

Spark holds the vectors: a round is one pass that writes the state to the shared folder
and one that adds up parts by entry, at most parts * entries rows for each task. Only
codebooks (parts * entries * part length integers) and the seeds reach the driver.

Cases: a row with a null vector, or with a null or non-finite component, is dropped.
The length of all vectors is that of the smallest vec_id whose length can be cut; a
vector of another length, or with a component too large for its error to be a long (64
dimensions: about 740,000), stays in the result with a null code and a null error and
moves no entry. Rows that share a vec_id are rows of their own; a null vec_id sorts
last. With fewer vectors than entries the codebook is as small. An error sum beyond a
long is given as the largest long. An empty table gives no rows; only needed columns
are read, so further ones do not clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import workers_import, written

SCALE = 256
PARTS = 16
ENTRIES = 64  # at most 256: an index has two hex digits
ROUNDS = 2
LONGEST = (1 << 63) - 1
EXACT = 1 << 53  # below, sums of whole doubles are exact


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, index, position]`` and which ``(part, index)`` the last round moved."""

    entries: np.ndarray
    moved: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def largest(length: int) -> int:
    """The largest component, by amount, with which any error of a vector is a long."""
    return isqrt(LONGEST // length) // 2 - 1


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (lowest of equals) and squared distance, for each row."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        at = d.argmin(1)
        return at, d[np.arange(len(x)), at].astype(np.int64)
    at, best = np.zeros(len(x), np.int64), np.full(len(x), LONGEST, np.int64)
    for k, e in enumerate(entries):
        d = ((x - e) ** 2).sum(1)
        nearer = (d < best) if k else np.ones(len(x), bool)
        at[nearer], best[nearer] = k, d[nearer]
    return at, best


def reassigned(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One part position after ``moved`` entries moved: see the module's text."""
    code, dist = code.copy(), dist.copy()
    own = moved[code]
    again = np.flatnonzero(own)
    if len(again):
        code[again], dist[again] = nearest(x[again], entries)
    active, still = np.flatnonzero(moved), np.flatnonzero(~own)
    if len(active) and len(still):
        at, d = nearest(x[still], entries[active])
        at = active[at]
        nearer = (d < dist[still]) | ((d == dist[still]) & (at < code[still]))
        code[still[nearer]], dist[still[nearer]] = at[nearer], d[nearer]
    return code, dist


def _lists(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are not null, and their values as a matrix (all rows have one length)."""
    rows = np.flatnonzero(~np.asarray(column.is_null()))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return rows, flat.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), dtype)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _full_lists(rows: np.ndarray, n: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of ``n`` rows with ``values`` in ``rows``, null elsewhere."""
    present = np.zeros(n, bool)
    present[rows] = True
    ends = np.concatenate(([0], np.cumsum(present * (values.shape[1] if len(rows) else 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind), mask=pa.array(~present))


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` (doubles) of the rows whose vector is whole and finite."""
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return given.where(F.col("embedding").isNotNull()).where(~odd)


def _integers(kept: DataFrame, length: int) -> DataFrame:
    """``vec_id, label, x``: the integer vectors; null where a vector cannot be coded."""
    most = largest(length) if length else 0
    label = kept.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = _column(b, "embedding")
            sizes = np.asarray(column.value_lengths())
            fit = np.flatnonzero(sizes == length) if length else np.zeros(0, np.int64)
            with np.errstate(over="ignore"):
                x = np.floor(SCALE * column.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False)).reshape(len(fit), length)
            inside = (np.abs(x) <= most).all(1) if len(fit) else np.zeros(0, bool)
            cells = _full_lists(fit[inside], b.num_rows, x[inside].astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([_column(b, "vec_id"), _column(b, "label"), cells], names=["vec_id", "label", "x"])

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("x", T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(run, schema)


def _state_schema(label: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("x", T.ArrayType(T.IntegerType())),
        T.StructField("code", T.BinaryType()), T.StructField("dist", T.ArrayType(T.LongType())),
    ])


def _assigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The state after every part met the codebooks. Rows with a ``code`` have met the
    codebooks before the last move; those without are compared with all entries."""
    parts, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = _lists(_column(b, "x"), np.int64)
            x = x.reshape(len(at), parts, width)
            code, dist = np.zeros((len(at), parts), np.int64), np.zeros((len(at), parts), np.int64)
            if before := "code" in b.schema.names:
                code = np.frombuffer(b"".join(c for c in _column(b, "code").to_pylist() if c is not None), np.uint8).astype(np.int64).reshape(len(at), parts)
                dist = _lists(_column(b, "dist"), np.int64)[1].reshape(len(at), parts).copy()
                code = code.copy()
            for p in range(parts if len(at) else 0):
                if before:
                    code[:, p], dist[:, p] = reassigned(x[:, p], books.entries[p], books.moved[p], code[:, p], dist[:, p])
                else:
                    code[:, p], dist[:, p] = nearest(x[:, p], books.entries[p])
            codes: list[bytes | None] = [None] * b.num_rows
            for i, c in zip(at.tolist(), code.astype(np.uint8), strict=True):
                codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [_column(b, "vec_id"), _column(b, "label"), _column(b, "x"), pa.array(codes, pa.binary()), _full_lists(at, b.num_rows, dist, pa.int64())],
                names=["vec_id", "label", "x", "code", "dist"],
            )

    return rows.mapInArrow(run, _state_schema(rows.schema["label"].dataType))


def _moved(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry to the floored mean of its parts; an unused one stays."""
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            at, x = _lists(_column(b, "x"), np.int64)
            if not len(at):
                continue
            code = np.frombuffer(b"".join(c for c in _column(b, "code").to_pylist() if c is not None), np.uint8).reshape(len(at), parts)
            cell = (code + np.arange(parts) * entries).ravel()
            counts += np.bincount(cell, minlength=parts * entries)
            x = x.reshape(len(at) * parts, width)
            order = np.argsort(cell, kind="stable")
            first = np.flatnonzero(np.diff(cell[order], prepend=-1))
            sums[cell[order][first]] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(counts[used]), _full_lists(np.arange(len(used)), len(used), sums[used], pa.int64())],
                names=["cell", "n", "sums"],
            )

    found = state.select("x", "code").mapInArrow(run, "cell int, n long, sums array<long>")
    # Sums of many tasks may leave the long range where a component is near its bound.
    totals = found.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)])
    now = books.entries.copy().reshape(parts * entries, width)
    for r in totals.collect():  # at most parts * entries rows
        now[r["cell"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    now = now.reshape(books.entries.shape)
    return Codebooks(now, (now != books.entries).any(2))


def seeds(kept: DataFrame, parts: int, entries: int) -> tuple[int, np.ndarray]:
    """Length of the vectors and the first codebooks; length 0 where no vector can be cut."""
    sized = kept.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    least = sized.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("n")).limit(1).collect()
    if not least:
        return 0, np.zeros((parts, 0, 1), np.int64)
    length = least[0].n
    rows = _integers(sized, length).where("x is not null").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    x = np.array([r.x for r in rows], np.int64).reshape(len(rows), parts, length // parts)
    return length, np.ascontiguousarray(x.transpose(1, 0, 2))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of each kept vector and the codebooks it is coded with."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit two hex digits")
    workers_import(vectors.sparkSession)
    kept = kept_vectors(vectors)
    length, first = seeds(kept, parts, entries)
    books = Codebooks(first, np.zeros(first.shape[:2], bool))
    state = _integers(kept, length)
    if not first.shape[1]:
        return state.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), books
    state = written(_assigned(state, books), "vector-codes")
    for k in range(rounds):
        books = _moved(state, books)
        state = _assigned(state, books)
        if k + 1 < rounds:
            state = written(state, "vector-codes")
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d)
    return written(state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), error.alias("error")), "vector-codes"), books


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each kept vector."""
    done, books = compressed(vectors, parts, entries, rounds)
    total = F.sum(F.col("error").cast("decimal(20,0)"))
    total = F.when(total > LONGEST, LONGEST).otherwise(total).cast("long")
    # Written, so that the planner joins by its true size: broadcast only below Spark's threshold.
    sums = written(done.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "vector-labels")
    return done.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _oracle(rounds: int = ROUNDS) -> str:
    """Lloyd's rounds with every part compared to every entry."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x
  FROM kept, range({PARTS}) r(p)
)""", f"""book0 AS MATERIALIZED (
  SELECT p, e, x FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) WHERE e < {ENTRIES}
)"""]  # fmt: skip
    for k in range(rounds + 1):
        ctes.append(f"""near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(c.x) AS x,
         min({{'d': list_sum(list_transform(list_zip(c.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.e}}) AS best
  FROM cut c JOIN book{k} b USING (p) GROUP BY vec_id, p
)""")
        if k < rounds:
            ctes.append(f"""mean{k} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT p, best.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, best.e, i) GROUP BY p, e
)""")
            ctes.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (p, e)
)""")
    return f"""WITH {', '.join(ctes)},
codes AS (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(best.e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)"""


ORACLE = _oracle()
