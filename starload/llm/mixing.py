"""Mixing sources to target weights by Sainte-Lague apportionment (operator 6).

Each source's documents, in a seeded order, form one stream of words that is cut
into blocks of ``BLOCK_WORDS`` equal words. The blocks of the whole mix are
allotted to the sources by highest quotients target / (2 * blocks + 1), so a
source's quota is an integer; as this rule never takes back a block when more are
dealt, the quotas of the first k shards nest and their differences are each
shard's integer quotas. Each shard takes its quota of a source as the next blocks of
one round through the source's stream that starts at a seeded block. So a shard's
blocks are neighbours in a seeded order of documents, a random choice of mostly whole
documents; in all shards together a source with quota q of b blocks gives every block
q // b times and one run of q % b blocks once more.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating, and
share all words; a target stops at ``REPEATS`` times its source's words and the
excess is shared again by weight until none is above.

Cases: a null text has no words and takes nothing; an empty source name is a
source of its own; rows with equal ids stay rows of their own; a text of any
length is counted whole and may span many blocks; an empty table gives an empty
result. One row for each source reaches the driver, documents never do.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR, SEPARATORS = r"[\x20\x09-\x0D]", " \t\n\v\f\r"
#: Between a separator and the word behind it.
PARTS = rf"(?<={SEPARATOR})(?!{SEPARATOR})(?!\z)"
WEIGHTS = (1, 2, 3)
REPEATS = 3
BLOCK_WORDS = 64
SHARDS = 8
SEED = 77
#: Documents of a range of a source's order that one task sums, about.
RANGE_ROWS = 20_000


def targets(sizes: list[int], weights: list[int], repeats: int = REPEATS) -> list[float]:
    """Words that each source should give."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s]
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * share > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * share
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def apportion(wanted: list[float], seats: int, most: list[int], have: list[int] | None = None) -> list[int]:
    """Seats by highest quotients wanted / (2 * seats + 1), at most ``most`` each,
    ties to the first; goes on from ``have``. Starts from the rounded quotas of a
    divisor that deals no seat too many, so few seats are dealt one by one."""
    got = list(have or [0] * len(wanted))
    seats = min(seats, sum(m for m, w in zip(most, wanted, strict=True) if w))
    total = sum(wanted)
    if not total:
        return got
    divisor = total / max(seats, 1)
    while True:
        start = [max(g, min(m, int(w / divisor + 0.5))) for g, m, w in zip(got, most, wanted, strict=True)]
        if sum(start) <= seats:
            break
        divisor *= 1.0 + max(1e-9, (sum(start) - seats) / max(seats, 1))
    got = start
    heap = [(-w / (2 * g + 1), i) for i, (w, g, m) in enumerate(zip(wanted, got, most, strict=True)) if w and g < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-wanted[i] / (2 * got[i] + 1), i))
    return got


def shard_quotas(sizes: list[int], wanted: list[float], shards: int = SHARDS, block: int = BLOCK_WORDS) -> list[list[int]]:
    """For each shard the blocks of each source; a prefix of shards is itself apportioned."""
    most = [REPEATS * -(-s // block) for s in sizes]
    total, before, out = round(sum(wanted) / block), [0] * len(sizes), []
    for k in range(1, shards + 1):
        now = apportion(wanted, total * k // shards, most, before)
        out.append([a - b for a, b in zip(now, before, strict=True)])
        before = now
    return out


def source_plan(sized: DataFrame, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row for each source: words, target, quotas, where each shard's part of the
    round through its blocks ends, and the block at which the round starts."""
    spark = sized.sparkSession
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    rows = sorted(rows, key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.n for r in rows]
    wanted = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
    quotas = shard_quotas(sizes, wanted, shards, block)
    out = []
    for i, r in enumerate(rows):
        blocks = max(1, -(-sizes[i] // block))
        of_shards = [q[i] for q in quotas]
        # What is taken once more ends before the last block does: no gap within a document.
        start = (seed + i) % (blocks - sum(of_shards) % blocks + 1)
        out.append((r.source, sizes[i], wanted[i], blocks, sum(of_shards), list(accumulate(of_shards)), start))
    schema = "source string, source_size long, target double, blocks long, quota long, shard_ends array<long>, start long"
    return spark.createDataFrame(out, schema)


def _shards_of(block: Column) -> Column:
    """The shards that take a block of a source, once for each time; columns of its plan are at hand."""
    turn = F.pmod(block - F.col("start"), F.col("blocks"))
    times = F.expr("quota div blocks") + (turn < F.pmod("quota", "blocks")).cast("long")
    nth = F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1)).otherwise(F.array().cast("array<long>"))
    return F.transform(nth, lambda m: F.size(F.filter("shard_ends", lambda e: e <= turn + m * F.col("blocks"))))


def mixed(docs: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Each row with ``doc_id, source, size, source_size, target, taken`` and
    ``pieces``: the blocks' parts of its text as (from word, words, times, shards), and
    ``shard_words``: the words that each shard takes of it."""
    sized = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text_or_empty(text_col)).alias("tie"),
        ),
        "mix-sizes",
    )
    plan = written(source_plan(sized, shards, block, seed), "mix-plan")
    bits = max(0, (sized.count() - 1) // RANGE_ROWS).bit_length()
    key = F.xxhash64(F.lit(seed), "doc_id", "tie")
    ranged = sized.withColumn("key", key).withColumn("part", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long"))
    # Where each document begins in its source's stream: by ranges of the order (that
    # of the key without sign), then within a range.
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source", "part", F.coalesce(F.sum("n").over(before(Window.partitionBy("source").orderBy("part"))), F.lit(0)).alias("first"))
    within = before(Window.partitionBy("source", "part").orderBy(F.col("key") < 0, "key", "doc_id", "tie", "size"))
    begun = ranged.withColumn("begin", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    begun = begun.join(parts, same(begun, parts, ["source", "part"])).select(begun["source"], "doc_id", "tie", "size", (F.col("begin") + F.col("first")).alias("begin"))
    held = begun.join(plan, same(begun, plan, ["source"])).drop(plan["source"])
    end = F.col("begin") + F.col("size")
    spans = F.when(F.col("size") == 0, F.array().cast("array<long>")).otherwise(F.sequence((F.col("begin") / block).cast("long"), ((end - 1) / block).cast("long")))
    piece = lambda k: F.struct(
        (F.greatest(k * block, "begin") - F.col("begin")).alias("first"),
        (F.least((k + 1) * block, end) - F.greatest(k * block, "begin")).alias("words"),
        _shards_of(k).alias("shards"),
    )
    held = held.withColumn("pieces", F.transform(spans, piece))
    held = held.withColumn("pieces", F.transform("pieces", lambda p: p.withField("times", F.size(p["shards"]).cast("long"))))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["words"] * p["times"])
    of = lambda j: F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["words"] * F.size(F.filter(p["shards"], lambda x: x == j)))
    by_shard = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), of)
    return held.select("doc_id", "source", "tie", "size", "source_size", "target", taken.alias("taken"), "pieces", by_shard.alias("shard_words"))


def mix_report(docs: DataFrame) -> DataFrame:
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "shard_words")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``documents``. For each time t = 1..``REPEATS`` a document
    gives one row with its blocks that are taken at least t times: the whole text,
    unchanged, if that is all of it, else the span of the text from the first to the
    last of their words. ``n_chars`` is set anew. A document of which nothing is taken goes."""
    plan = mixed(docs).select(F.xxhash64("doc_id", "source", "tie").alias("plan_k"), "doc_id", "source", "tie", "pieces")
    plan = plan.withColumn("nth", F.row_number().over(Window.partitionBy("plan_k").orderBy("doc_id", "source", "tie", F.to_json("pieces")))).select("plan_k", "nth", "pieces")
    # Equal rows may lie in different blocks: they are told apart by their number.
    # Both sides number them in the same order, so the join needs only one key and
    # the texts move once.
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("src"),
        F.xxhash64(text_or_empty()).alias("own_tie"),
    )
    own = own.withColumn("k", F.xxhash64("id", "src", "own_tie"))
    own = own.withColumn("own_nth", F.row_number().over(Window.partitionBy("k").orderBy("id", "src", "own_tie")))
    held = own.join(plan, (F.col("k") == F.col("plan_k")) & (F.col("own_nth") - F.col("nth") == 0))
    held = held.select("row", "pieces", F.explode(F.array(*[F.lit(t) for t in range(1, REPEATS + 1)])).alias("time"))
    held = held.withColumn("mine", F.filter("pieces", lambda p: p["times"] >= F.col("time"))).where(F.size("mine") > 0)
    text = F.col("row").getField("text").cast("string")
    whole = F.size("mine") == F.size("pieces")
    # Parts begin at words; separators before the first word are a part of their own.
    held = held.withColumn("parts", F.when(~whole, F.split(text, PARTS)))
    lead = text.rlike(f"^{SEPARATOR}").cast("int")
    first, n = F.col("mine")[0]["first"].cast("int"), F.aggregate("mine", F.lit(0), lambda a, p: a + p["words"].cast("int"))
    span = F.when(first == 0, F.slice("parts", F.lit(1), n + lead)).otherwise(F.slice("parts", first + lead + 1, n))
    cut = F.array_join(span, "")
    to_end = F.element_at("mine", -1) == F.element_at("pieces", -1)
    some = F.when(to_end, cut).otherwise(F.rtrim(cut, F.lit(SEPARATORS)))
    held = held.withColumn("new_text", F.when(whole, text).otherwise(some))
    new = {"text": F.col("new_text"), "n_chars": F.char_length("new_text").cast("long")}
    return held.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
