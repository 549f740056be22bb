"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in blocks. The matrix says how many rows of each block go to each shard; it has the law
that a uniform shuffle would give, with the block sizes as row sums and the shard sizes as
column sums. Then each block permutes its rows and deals them out by its row of the
matrix, the rows move to their shards, and each shard permutes what it got.

The matrix is drawn down a tree: a node splits its column sums among its children, one after
the other, and all nodes of a level are drawn side by side. All steps are Spark functions.
Randomness comes from hashes of the seed, so a run can be repeated.
"""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import without

#: Children of a node at each level of the tree; their product is the number of blocks.
FANS = (32, 32)
#: Half-width, in standard deviations, of the values that a draw looks at: beyond lies less than 1e-30.
REACH = 12.0
LAW = "rows"


def uniform(*parts: Column | int) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    bits = F.shiftrightunsigned(F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts]), 11)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows out of ``total`` are among the ``marked``: inverse of the law at ``u``.

    Weights start at 1 at the lower end and follow the ratio of neighbours; one pass sums
    them, the next stops where the sum reaches its share ``u``.
    """
    n, k, d = (x.cast("double") for x in (total, marked, drawn))
    share = k / F.greatest(n, F.lit(1.0))
    mean = d * share
    spread = F.sqrt(mean * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1.0))) * REACH + REACH
    low = F.greatest(F.lit(0), drawn - (total - marked), F.floor(mean - spread).cast("long"))
    high = F.least(drawn, marked, F.ceil(mean + spread).cast("long"))
    values = F.sequence(low, F.greatest(low, high))

    def ratio(x: Column) -> Column:
        """Weight of x + 1 over the weight of x."""
        return (k - x) * (d - x) / ((x + 1) * (n - k - d + x + 1))

    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    whole = F.aggregate(
        values, start,
        lambda s, x: F.struct((s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum")), lambda s: s["sum"])
    at = F.struct(low.alias("x"), F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), (u * whole).alias("goal"))
    found = F.aggregate(
        values, at,
        lambda s, x: F.struct(
            F.when(s["sum"] < s["goal"], x).otherwise(s["x"]).alias("x"), (s["w"] * ratio(x)).alias("w"),
            (s["sum"] + s["w"]).alias("sum"), s["goal"].alias("goal")),
        lambda s: s["x"])
    return F.when(low >= high, low).otherwise(found)


def split_row(sums: Column, size: Column, child: Column, seed: int, level: int, shards: int) -> Column:
    """How many of a child's ``size`` rows go to each shard, given the column sums still open."""
    empty = F.array().cast("array<bigint>")
    start = F.struct(
        F.aggregate(sums, F.lit(0).cast("long"), lambda a, x: a + x).alias("open"), size.cast("long").alias("left"),
        empty.alias("out"))

    def step(s: Column, shard: Column) -> Column:
        marked = F.element_at(sums, shard + 1)
        x = hypergeometric(s["open"], marked, s["left"], uniform(seed, level, child, shard))
        # what a draw gives is used three times; a one-element array computes it once
        return F.element_at(F.transform(F.array(x), lambda v: F.struct(
            (s["open"] - marked).alias("open"), (s["left"] - v).alias("left"),
            F.concat(s["out"], F.array(v)).alias("out"))), 1)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step, lambda s: s["out"])


def split_node(sums: Column, children: Column, seed: int, level: int, shards: int) -> Column:
    """The rows of the matrix for all children of a node: array of (child, sums)."""
    start = F.struct(
        sums.alias("open"), F.array().cast("array<struct<child:bigint,sums:array<bigint>>>").alias("out"))

    def step(s: Column, c: Column) -> Column:
        row = split_row(s["open"], c["size"], c["child"], seed, level, shards)
        return F.element_at(F.transform(F.array(row), lambda r: F.struct(
            F.zip_with(s["open"], r, lambda a, b: a - b).alias("open"),
            F.concat(s["out"], F.array(F.struct(c["child"].alias("child"), r.alias("sums")))).alias("out"))), 1)

    return F.aggregate(children, start, step, lambda s: s["out"])


def communication_matrix(blocks: DataFrame, shards: int, seed: int, fans: tuple[int, ...] = FANS) -> DataFrame:
    """(block, size) to (child = block, sums = rows for each shard): exact row and column sums."""
    below = prod(fans)
    sums = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: (F.floor(F.col("total") / shards) + (s < F.col("total") % shards).cast("long")).cast("long"))
    nodes = blocks.agg(F.sum("size").alias("total")).select(F.lit(0).cast("long").alias("node"), sums.alias("sums"))
    for level, fan in enumerate(fans):
        width = below // fan
        children = blocks.groupBy(F.floor(F.col("block") / width).alias("child")).agg(F.sum("size").alias("size"))
        grouped = children.groupBy(F.floor(F.col("child") / fan).cast("long").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("child", "size"))).alias("children"))  # at most `fan` entries
        drawn = nodes.join(grouped, "node").select(
            F.explode(split_node(F.col("sums"), F.col("children"), seed, level, shards)).alias("c"))
        nodes = drawn.select(F.col("c.child").alias("node"), F.col("c.sums").alias("sums"))
        below = width
    return nodes


def shard_rows(
    rows: DataFrame, shards: int = 16, seed: int = 20_011, fans: tuple[int, ...] = FANS, buckets: int | None = None
) -> DataFrame:
    """Every row with law (``rows``), shard, slot and grown_shard (NULL under this law).

    Shard sizes differ by one at most; slots count from 0 without gaps. The values of the row play
    no part, so NULLs, repeated rows and hot keys are dealt like any row. An empty frame
    gives an empty frame. Columns of these names in the input are replaced. Pass only the
    columns that must move: the rows are written once, to fix their positions, and cross the
    network twice. ``buckets`` parts the second permutation of a shard among tasks.
    """
    spark = rows.sparkSession
    buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["law", "shard", "slot", "grown_shard"]
    placed = without(rows, names).withColumn("__at", F.monotonically_increasing_id())
    placed = materialize(placed, "shards").withColumn(
        "__block", F.pmod(F.xxhash64(F.lit(seed), "__at"), F.lit(prod(fans))))
    blocks = placed.groupBy(F.col("__block").alias("block")).agg(F.count(F.lit(1)).alias("size"))
    running = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda n: F.aggregate(F.slice("sums", 1, n), F.lit(0).cast("long"), lambda a, x: a + x))
    matrix = materialize(
        communication_matrix(blocks, shards, seed, fans).select(F.col("node").alias("__block"), running.alias("__upto")),
        "matrix")
    # first permutation, within the block; the matrix deals out the ranks
    first = W.partitionBy("__block").orderBy(F.xxhash64(F.lit(seed + 1), "__at"), "__at")
    dealt = (
        placed.withColumn("__rank", F.row_number().over(first)).join(matrix, "__block")
        .withColumn("shard", F.size(F.filter("__upto", lambda c: c < F.col("__rank"))))
        .withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed + 2), "__at"), F.lit(buckets)))
    )
    # second permutation, within the shard: buckets in order, ranks within buckets
    counts = dealt.groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy("shard").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1))
    bases = counts.select("shard", "__bucket", F.coalesce(before, F.lit(0)).alias("__base"))
    second = W.partitionBy("shard", "__bucket").orderBy(F.xxhash64(F.lit(seed + 3), "__at"), "__at")
    return dealt.withColumn("__rank", F.row_number().over(second)).join(bases, ["shard", "__bucket"]).select(
        *[F.col(f"`{c}`") for c in without(rows, names).columns], F.lit(LAW).alias("law"), "shard",
        (F.col("__base") + F.col("__rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
