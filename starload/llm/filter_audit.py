"""Filter interaction audit (operator 11).

Each filter is a failure condition. A document's failures are a set of filters, so
all that any order of the filters can do follows from one table: for each part and
each of the 2**n coalitions of filters, how many documents the coalition removes
(those that fail one of its members). The table is tabulated from counts of failure
sets. From it come

* the figures of a step: what the filters up to the step remove less what those
  before it remove; the same differences over good and over toxic documents;
* each filter's Shapley value: the additive game nearest to the removals by least
  squares, coalitions weighted by the Shapley kernel, under the constraint that the
  values add up to what all filters remove. The normal equations with the
  constraint's multiplier are solved exactly, in rationals, once for each coalition
  as a unit game; the solution of a part is that solution times its removals, and
  times n! a whole number.

Documents are read once; texts are not shuffled, only their SHA-256 and their
failures. Groups of equal texts, of a part or of a document number are partial
aggregates; a window sees one row for each (text, part, label pair).

Cases: a null text is empty (0 words, 0 characters), equal to other empty ones; a
null lang is the part of the empty string; a row with a null doc_id has no labels and
no place in the order of ids, so it neither is a later copy nor makes others one;
rows that share doc_id and text are no copies of each other; of several label
rows for a doc_id any that says 1 counts; an empty table gives no rows. Only needed
columns are read, so further ones do not clash.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from functools import cache
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

# --- fixed values: the five conditions of the audit ---------------------------
GAPS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_FILTERS = 6  # the report has a row for each order: n! * n


def text_conditions() -> dict[str, Column]:
    """Failure conditions that a text alone decides, over ``text`` (no nulls) and its ``words``."""
    capitals = F.length("text") - F.length(F.translate("text", CAPITALS, ""))
    return {
        "A": F.size("words") < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
        "C": 100 * capitals.cast("long") > 3 * F.length("text").cast("long"),
        "D": F.col("text").rlike(MARKS),
    }


COPY = "E"


@cache
def solution(n: int) -> tuple[tuple[Fraction, ...], ...]:
    """``[i][S]``: the value of player ``i`` in the unit game of coalition ``S`` (bit set).

    Least squares over the proper coalitions with kernel weights, with the values'
    sum held to the grand coalition's worth. Rows are the ``n`` normal equations and the
    constraint; they are reduced together with a right side for each coalition.
    """
    full = (1 << n) - 1
    weight = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, full) for k in [s.bit_count()]}
    system = []
    for i in range(n):
        left = [sum((w for s, w in weight.items() if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)]
        right = [weight.get(s, Fraction(0)) if s >> i & 1 else Fraction(0) for s in range(full + 1)]
        system.append([*left, Fraction(1), *right])
    system.append([Fraction(1)] * n + [Fraction(0)] * (full + 1) + [Fraction(1)])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if system[r][c])
        system[c], system[pivot] = system[pivot], system[c]
        system[c] = [x / system[c][c] for x in system[c]]
        for r in range(n + 1):
            if r != c and system[r][c]:
                f = system[r][c]
                system[r] = [x - f * y for x, y in zip(system[r], system[c], strict=True)]
    return tuple(tuple(row[n + 1 :]) for row in system[:n])


def _mask(names: list[str], conditions: Mapping[str, Column]) -> Column:
    return sum((F.when(conditions[f], 1 << i).otherwise(0) for i, f in enumerate(names) if f in conditions), F.lit(0))


def labelled(labels: DataFrame) -> DataFrame:
    """``doc_id, good, toxic``: one row for each labelled document."""
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )


def failure_sets(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, copies: str | None = COPY) -> DataFrame:
    """``part, failed, good, toxic, n``: how many documents of a part and label pair
    fail exactly the filters of the bit set ``failed``.

    Bits are the filters in ascending order of their names: ``conditions`` over ``text``
    and ``words``, and ``copies``, the name of the filter that fails texts that a smaller doc_id has.
    """
    conditions = text_conditions() if conditions is None else dict(conditions)
    names = sorted([*conditions, *([copies] if copies else [])])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", GAPS), ""))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _mask(names, conditions).cast("int").alias("failed"))
    # Rows without an id match no label: kept out of the join, where they would be one task's work.
    known = rows.where("doc_id is not null").join(labelled(labels), "doc_id", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    known = known.unionByName(rows.where("doc_id is null").withColumns({c: F.lit(False) for c in ("good", "toxic")}))
    key = ["digest", "part", "failed", "good", "toxic"]
    known = known.groupBy("doc_id", *key).agg(F.count("*").alias("n"))
    # min over structs skips none of the null ids, which sort first: they are set aside.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    without = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without")
    groups = known.groupBy(*key).agg(F.sum("n").alias("n"), first, without)
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    original = F.col("without") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    bit = 1 << names.index(copies) if copies else 0
    split = groups.withColumn("original", original if copies else F.col("n"))
    split = split.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("failed"), F.col("original").alias("n")),
        F.struct((F.col("failed") + bit).alias("failed"), (F.col("n") - F.col("original")).alias("n")),
    )))
    return split.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def coalition_removals(sets: DataFrame, n: int) -> DataFrame:
    """``part, total, removed, good, toxic``: the last three are arrays with, for each of
    the 2**n coalitions (bit set, from 0), the documents that it removes."""
    hits = {s: F.col("failed").bitwiseAND(s) != 0 for s in range(1 << n)}

    def counts(also: Column | None) -> Column:
        of = [hits[s] if also is None else hits[s] & also for s in range(1 << n)]
        return F.array(*[F.sum(F.when(c, F.col("n")).otherwise(F.lit(0).cast("long"))) for c in of])

    return sets.groupBy("part").agg(
        F.sum("n").alias("total"), counts(None).alias("removed"), counts(F.col("good")).alias("good"), counts(F.col("toxic")).alias("toxic")
    )


def steps(removals: DataFrame, names: list[str]) -> DataFrame:
    """One row for each part, order and step; see the module's text."""
    n = len(names)
    full = (1 << n) - 1
    orders = factorial(n)
    rows = []
    for order in permutations(names):
        before = 0
        for k, f in enumerate(order, start=1):
            own = 1 << names.index(f)
            rows.append((("".join(order)), k, own, before, before | own))
            before |= own
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(own).alias("own"), F.lit(b).alias("before"), F.lit(a).alias("after")) for o, k, own, b, a in rows])
    shares = []
    for i in range(n):
        terms = [(s, orders * w) for s, w in enumerate(solution(n)[i])]
        if any(w.denominator != 1 for _, w in terms):
            raise ArithmeticError("kernel equations have no whole solution")
        shares.append(sum((F.element_at("removed", s + 1) * int(w) for s, w in terms if w), F.lit(0).cast("long")))
    by_own = F.create_map(*[x for i, share in enumerate(shares) for x in (F.lit(1 << i), share)])
    # The shares are worked out once for each part, before its rows are spread out.
    told = removals.select("*", by_own.alias("shares")).select("*", F.explode(plan).alias("at"))

    def at(counts: str, coalition: Column) -> Column:
        return F.element_at(counts, coalition + 1)

    own, before, after = (F.col(f"at.{c}") for c in ("own", "before", "after"))
    removed = at("removed", after) - at("removed", before)
    return told.select(
        "part",
        F.col("at.filter_order").alias("filter_order"),
        F.col("at.step").alias("step"),
        (F.col("total") - at("removed", after)).alias("kept"),
        removed.alias("removed"),
        (at("removed", own) - removed).alias("redundant"),
        (at("removed", F.lit(full)) - at("removed", F.lit(full) - own)).alias("unique_fails"),
        (at("good", after) - at("good", before)).alias("good_lost"),
        (at("toxic", after) - at("toxic", before)).alias("toxic_lost"),
        F.element_at("shares", own).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, copies: str | None = COPY) -> DataFrame:
    """The report over all orders of the filters (at most ``MOST_FILTERS``), by part.

    ``filter_order`` joins the filters' names, so names of one letter read best.
    """
    names = sorted([*(text_conditions() if conditions is None else conditions), *([copies] if copies else [])])
    if not 2 <= len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"2 to {MOST_FILTERS} filters with names of their own, not {names}")
    return steps(coalition_removals(failure_sets(docs, labels, conditions, copies), len(names)), names)


#: Each document's failures counted in turn for each order; the Shapley value as the sum
#: of what the filter removes over all orders.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), flagged AS (
  SELECT doc_id, part,
         [len(w) < 200,
          100 * len(list_distinct(w)) < 50 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)] AS f
  FROM words
), marked AS (
  SELECT part, f, coalesce(q.good, false) AS good, coalesce(q.toxic, false) AS toxic, count(*) AS n
  FROM flagged LEFT JOIN (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id) q USING (doc_id)
  GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS at
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), taken AS (
  SELECT m.part, o.filter_order, s.step, o.at[s.step] AS own, m.n, m.good, m.toxic,
         m.f[o.at[s.step]] AS fails,
         len(list_filter(o.at[1:s.step - 1], lambda x: m.f[x])) > 0 AS gone,
         len(list_filter([1, 2, 3, 4, 5], lambda x: m.f[x])) AS n_fails
  FROM marked m, orders o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
), counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM taken GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
