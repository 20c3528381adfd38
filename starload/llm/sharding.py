"""Uniform shuffle into shards of exact sizes (operator 3), DataFrame functions only.

Law ``rows``: shard row counts differ by at most one. Every row has the same
chance to land in any slot of any shard:

1. Equal rows are counted and numbered. Rows fall in source blocks by a hash of their
   identity and number, so copies of one row are dealt like any other rows.
2. The communication matrix, how many rows of each block go to each shard, is
   drawn exactly: from the root, which holds all rows and the shards' exact
   capacities, each node of a binary tree over the blocks splits its capacities
   between its halves by a multivariate hypergeometric draw, one shard after the
   other. Row sums are the block sizes and column sums the shard sizes. A draw
   inverts the distribution function, summed outward from the mode over ``SPREAD``
   deviations to either side; the mass beyond them is below the 2**-53 steps of the
   uniform number that is inverted, so it takes no draw.
3. Each block is permuted locally and dealt to the shards by its matrix row.
4. Each shard is permuted again; the position is the slot. Large shards are cut
   into ranges of the random key, so no task sorts a whole shard.

All draws come from hashes of the seed, node and shard, so a lost task is
repeated with the same outcome, and reruns agree however the input is cut.

Cases: a null text has no bytes (size 16, checksum 0); null doc_ids, repeated
rows and ties are dealt as rows of their own (equal rows may swap slots); an
empty table gives an empty result; very long texts only enter by length and
checksum. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 40
SEED = 20_240
#: Rows of a source block, and of a range of a shard that one task sorts, about.
BLOCK_ROWS = 20_000
#: Copies of one row that one task numbers.
COPIES = 10_000
#: Standard deviations around the mode that a draw sums; beyond lie less than 1e-20 of the mass.
SPREAD = 10


def _span(lo: Column, hi: Column, down: bool = False) -> Column:
    """The integers lo..hi, none if hi < lo; from hi to lo if ``down``."""
    step = F.lit(-1 if down else 1).cast("long")
    return F.when(hi >= lo, F.sequence(hi, lo, step) if down else F.sequence(lo, hi, step)).otherwise(F.array().cast("array<long>"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among ``draws`` from ``total`` of which ``good`` are
    good, as the quantile of ``u`` in [0, 1) with values taken outward from the mode."""
    long = lambda x: F.lit(x).cast("long")
    given = F.struct((total - good).alias("bad"), good.alias("good"), draws.alias("draws"), u.alias("u"))

    def limits(p: Column) -> Column:
        n, share = p["good"] + p["bad"], p["good"] / F.greatest(p["good"] + p["bad"], long(1))
        lo, hi = F.greatest(long(0), p["draws"] - p["bad"]), F.least(p["draws"], p["good"])
        mode = F.least(hi, F.greatest(lo, F.floor((p["draws"] + 1) * ((p["good"] + 1) / (n + 2)))))
        wide = F.ceil(SPREAD * F.sqrt(p["draws"] * share * (1 - share) * (n - p["draws"]) / F.greatest(n - 1, long(1)))) + 20
        return F.struct(mode.alias("mode"), F.greatest(lo, mode - wide).alias("first"), F.least(hi, mode + wide).alias("last"))

    def walk(p: Column, q: Column, t: Column | None) -> Column:
        """Sum of the weights outward from the mode, and where it passes t."""
        more = lambda k: (p["good"] - k).cast("double") * (p["draws"] - k) / ((k + 1).cast("double") * (p["bad"] - p["draws"] + k + 1))
        less = lambda k: k.cast("double") * (p["bad"] - p["draws"] + k) / ((p["good"] - k + 1).cast("double") * (p["draws"] - k + 1))

        def step(ratio):
            def f(a: Column, k: Column) -> Column:
                c = a["sum"] + a["w"]
                at = F.lit(None).cast("long") if t is None else F.coalesce(a["at"], F.when(c > t, k))
                return F.struct((a["w"] * ratio(k)).alias("w"), c.alias("sum"), at.alias("at"))

            return f

        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("at"))
        up = F.aggregate(_span(q["mode"], q["last"]), start, step(more))
        turn = lambda a: F.struct(less(q["mode"]).alias("w"), a["sum"].alias("sum"), a["at"].alias("at"))
        return _let(up, lambda a: F.aggregate(_span(q["first"], q["mode"] - 1, down=True), turn(a), step(less)))

    found = lambda p, q: _let(p["u"] * walk(p, q, None)["sum"], lambda t: F.coalesce(walk(p, q, t)["at"], q["mode"]))
    return _let(given, lambda p: _let(limits(p), lambda q: found(p, q)))


def uniform(*parts) -> Column:
    """A number in [0, 1) from the hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _split(caps: Column, rows: Column, draws: Column, node: Column, seed: int) -> Column:
    """Capacities for the left half of a node: a multivariate hypergeometric draw."""

    def step(a: Column, j: Column) -> Column:
        good = F.get(caps, j)
        k = hypergeometric(a["rows"], good, a["draws"], uniform(F.lit(seed), node, j))
        return _let(k, lambda x: F.struct((a["rows"] - good).alias("rows"), (a["draws"] - x).alias("draws"), F.array_append(a["out"], x).alias("out")))

    start = F.struct(rows.alias("rows"), draws.alias("draws"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(caps) - 1), start, step)["out"]


def communication_matrix(counts: DataFrame, levels: int, total: int, shards: int, seed: int) -> DataFrame:
    """``block, caps``: rows of each of ``2**levels`` blocks that go to each shard.
    ``counts`` has ``block, rows`` for blocks with rows."""
    spark = counts.sparkSession
    caps = [total // shards + (j < total % shards) for j in range(shards)]
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.lit(total).cast("long").alias("rows"), F.array(*[F.lit(c).cast("long") for c in caps]).alias("caps"))
    if not levels:
        return nodes.select(F.col("node").alias("block"), "caps")
    below = counts.select(F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level"), "block", "rows")
    below = below.groupBy("level", F.expr(f"shiftright(block, {levels} - level)").alias("node")).agg(F.sum("rows").alias("rows"))
    below = written(below, "matrix-counts")
    for level in range(1, levels + 1):
        left = below.where(F.col("level") == level).where("node % 2 = 0").select((F.col("node") / 2).cast("long").alias("node"), F.col("rows").alias("left_rows"))
        held = nodes.join(left, "node", "left").withColumn("left_rows", F.coalesce("left_rows", F.lit(0).cast("long")))
        drawn = held.withColumn("left_caps", _split(F.col("caps"), F.col("rows"), F.col("left_rows"), F.col("node") + (1 << level), seed))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left_rows").alias("rows"), F.col("left_caps").alias("caps")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("rows") - F.col("left_rows")).alias("rows"), F.zip_with("caps", "left_caps", lambda a, b: a - b).alias("caps")),
        )
        nodes = drawn.select(F.inline(halves)).where("rows > 0")
    return nodes.select(F.col("node").alias("block"), "caps")


def numbered(rows: DataFrame, columns: tuple[str, ...], most: int = COPIES) -> DataFrame:
    """The rows, equal ones numbered ``nth`` = 0, 1, ... They are counted before they move;
    what is more than ``most`` copies is numbered in parts by several tasks."""
    counted = rows.groupBy(*columns).agg(F.count("*").alias("n"))
    few = counted.where(F.col("n") <= most).select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
    many = counted.where(F.col("n") > most).select(*columns, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {most}"))).alias("part"))
    last = F.least(F.col("n"), (F.col("part") + 1) * most) - 1
    many = many.repartition(*columns, "part").select(*columns, F.explode(F.sequence(F.col("part") * most, last)).alias("nth"))
    return few.unionByName(many)


def uniform_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = ("doc_id", "text_crc32", "size")
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    sized = written(numbered(sized, columns), "sized")
    total = sized.count()
    levels = max(0, (total - 1) // block_rows).bit_length()
    identity = (*columns, "nth")
    top = lambda key, bits: F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")
    blocked = sized.withColumn("block", top(F.xxhash64(F.lit(seed), F.lit("block"), *identity), levels))
    counts = blocked.groupBy("block").agg(F.count("*").alias("rows"))
    matrix = communication_matrix(counts, levels, total, shards, seed)
    bounds = F.aggregate("caps", F.array(F.lit(0).cast("long")), lambda a, c: F.array_append(a, F.element_at(a, -1) + c))
    matrix = written(matrix.select("block", F.slice(bounds, 2, shards).alias("bounds")), "matrix")

    permuted = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), *identity), *identity)
    ranked = blocked.withColumn("r", F.row_number().over(permuted))
    dealt = ranked.join(matrix, "block").withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("r"))).cast("int"))
    key = F.xxhash64(F.lit(seed), F.lit("slot"), *identity)
    bits = max(0, (total // shards - 1) // block_rows).bit_length()
    dealt = written(dealt.select(*columns, "shard", key.alias("key")).withColumn("part", top(F.col("key"), bits)), "dealt")

    parts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("key", *columns)
    placed = dealt.withColumn("nth", F.row_number().over(within)).join(parts, ["shard", "part"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
