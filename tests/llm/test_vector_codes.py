"""Vector codes against Lloyd's method in plain Python, every part compared with all entries."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from starload.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = next((len(v) for _, v, _ in kept if v and len(v) % parts == 0), 0)
    fit = [r for r in kept if d and len(r[1]) == d and max(map(abs, r[1])) <= vc.largest(d)]
    w = d // parts if d else 0

    def cut(v, p):
        return v[p * w : (p + 1) * w]

    books = [[cut(r[1], p) for r in fit[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in fit]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(r[1], p) for r, n in zip(fit, near, strict=True) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    done = [(r[0], "".join(f"{k:02x}" for _, k in n), sum(x for x, _ in n), r[2]) for r, n in zip(fit, assign(), strict=True)]
    done += [(r[0], None, None, r[2]) for r in kept if not any(r is f for f in fit)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {}
    for *_, e, lab in done:
        if e is not None:
            sums[lab] = sums.get(lab, 0) + e
    return sorted(((i, c, e, sums.get(lab), sha) for i, c, e, lab in done), key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def vectors(n, d, seed, spread=1.0, ids=None):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(d)] for _ in range(7)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        v = [float(np.float32(x + rng.gauss(0, 0.05) * (i % 4))) for x in c]
        out.append(((ids or (lambda k: k))(i), v, rng.choice([0, 1, 2, None])))
    return out


def test_against_brute_force(spark):
    rows = vectors(300, 32, 3)
    assert told(vc.coded(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_more_rounds_and_other_sizes(spark):
    rows = vectors(200, 12, 4, ids=lambda k: 1000 - 3 * k)
    df = spark.createDataFrame(rows, SCHEMA)
    assert told(vc.coded(df, parts=3, entries=9, rounds=5)) == brute(rows, 3, 9, 5)


def test_odd_rows(spark):
    rows = vectors(90, 16, 5)
    rows += [
        (500, None, 1), (501, [1.0, None] + [0.0] * 14, 1), (502, [float("nan")] * 16, 0), (503, [float("-inf")] + [0.0] * 15, 0),
        (-5, [], 1), (-4, [1.0] * 7, None), (504, [1.0] * 32, 9), (505, [3e38] * 16, 9), (506, [-0.001] * 16, 1),
        rows[3], rows[3], (7, rows[9][1], 2), (None, rows[8][1], 1), (507, [1e6] * 16, 2), (508, [-1e6] * 15 + [0.0], 2),
    ]
    rows += [(600 + i, rows[0][1], 0) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert told(vc.coded(df)) == want
    assert told(vc.coded(df.withColumns({n: F.lit(n) for n in ("x", "code", "dist", "error", "of", "cell")}).repartition(7))) == want


def test_few_and_no_vectors(spark):
    rows = vectors(5, 16, 6)
    assert told(vc.coded(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert told(vc.coded(spark.createDataFrame([(1, [0.5] * 5, 1)], SCHEMA))) == [(1, None, None, None, hashlib.sha256(b"").hexdigest())]
    assert vc.coded(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert vc.coded(nothing).count() == 0


def test_only_moved_entries_are_compared():
    rng = np.random.default_rng(8)
    for big in (1, 1 << 26):
        x = rng.integers(-40, 40, (500, 3)) * big
        old = rng.integers(-40, 40, (20, 3)) * big
        code, dist = vc.nearest(x, old)
        new = old.copy()
        new[[2, 5, 11]] += rng.integers(-9, 9, (3, 3)) * big
        new[7] = new[3]
        moved = (new != old).any(1)
        seen = []
        whole = vc.nearest

        def counting(rows, entries):
            seen.append(len(rows) * len(entries))
            return whole(rows, entries)

        vc.nearest = counting
        try:
            got = vc.reassigned(x, new, moved, code, dist)
        finally:
            vc.nearest = whole
        want = vc.nearest(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
        own = int(moved[code].sum())
        assert sum(seen) == own * 20 + (500 - own) * int(moved.sum())


def test_distances_beyond_doubles():
    m = vc.largest(64)
    x = np.array([[m, -m, m, 5], [m, -m, m, 4]])
    entries = np.array([[-m, m, -m, 4], [m, -m, m, 3], [m, -m, m, 5], [m, -m, m, 5]])
    at, d = vc.nearest(x, entries)
    assert at.tolist() == [2, 1] and d.tolist() == [0, 1]
    assert 16 * 3 * (2 * m) ** 2 < 1 << 63
