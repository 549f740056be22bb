"""The trie of conversation prefixes, one row per node.

Each conversation is one path of turn digests. Paths are range-partitioned by splitters drawn from the paths
themselves, and each shard sorts its paths; then a node's members stand together, and a stack along the current
path finishes nodes one after the other. Only the prefixes of the splitters, the skeleton, can have members in several
shards. The trie of the splitters is broadcast, shards give partial aggregates of its nodes, and these are
reduced: over the shards by Spark, along the skeleton from the leaves to the root.

Splitters are pairs of path and conversation, so equal paths of very many conversations part as well.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..session import materialize
from .common import map_batches

#: Bytes of a turn's digest in a path.
STEP = 16
#: Shards at most, turns of a splitter at most: their product bounds the skeleton's nodes.
SHARDS, SPLITTER_TURNS = 1024, 256
#: Paths drawn for each splitter.
DRAWN = 8
#: Conversation ids in one row of a skeleton node's ends.
ENDS = 4096
_NODE, _PART, _ENDS = 0, 1, 2
_NUMBERS = ["node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODES = StructType([*(StructField(c, LongType()) for c in _NUMBERS), StructField("ends_sha256", StringType())])
_SHARD = StructType([
    StructField("kind", IntegerType()), *_NODES.fields, StructField("n_bytes", LongType()), StructField("ends", StringType())])
RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digest and text bytes of every turn, by turn number, NULL first, then by digest."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "n_bytes"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % 5 in place of its own first h; h = crc32(c) % 9."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    heads = turns.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    both = turns.withColumn("base", F.expr("conv_id - conv_id % 5")).join(heads, "base", "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    return both.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def turn_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the digests one after the other, and the bytes of each turn's text."""
    return rebuilt(ordered_turns(conversations)).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["n_bytes"]).alias("sizes"))


class Skeleton:
    """The trie of the splitters. Node 0 is the root; a node comes before the nodes below it."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.below: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            at = 0
            for k in range(0, len(path), STEP):
                step = (at, path[k: k + STEP])
                if step not in self.below:
                    self.below[step] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(k // STEP + 1)
                at = self.below[step]


def skeleton_of(paths: DataFrame, shards: int, seed: int = 13) -> Skeleton:
    """Splitters that part a hash sample of the (path, conversation) pairs evenly; long paths give their first turns."""
    most = SPLITTER_TURNS * STEP
    cut = F.octet_length("path") > most
    drawn = (
        paths.orderBy(F.xxhash64(F.lit(seed), "conv_id"), "conv_id").limit(DRAWN * shards)
        .select(F.substring("path", 1, most), F.when(cut, F.lit(-(1 << 63))).otherwise(F.col("conv_id"))).collect()
    )
    keys = sorted((bytes(p), c) for p, c in drawn)
    return Skeleton(sorted({keys[len(keys) * k // shards] for k in range(1, shards)}) if keys else [])


def to_shards(paths: DataFrame, skeleton) -> DataFrame:
    """The paths with their shard: the number of splitters that do not come after them."""
    schema = StructType([*paths.schema.fields, StructField("shard", IntegerType())])

    def run(batches):
        splitters = skeleton.value.splitters
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*batch.schema.names, "shard"])

    return map_batches(paths, run, schema)


class _Shard:
    """The stack of open nodes along the current path, and the rows of those that are done."""

    def __init__(self, skeleton: Skeleton, first: int):
        self.skeleton, self.number = skeleton, first
        self.rows: list[tuple] = []
        self.path, self.open = b"", [self._node(0, 0)]

    def _node(self, skeleton: int, size: int) -> dict:
        if skeleton < 0:
            self.number += 1
        return {
            "no": self.number if skeleton < 0 else -1 - skeleton, "skeleton": skeleton, "size": size, "least": None, "n": 0,
            "kids": 0, "leaves": 0, "saved": 0, "sha": None, "ends": []}

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        """The next member: paths ascend, and conversations of equal paths do."""
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same: same + STEP] == self.path[same: same + STEP]:
            same += STEP
        self.close(same // STEP)
        for k in range(same, len(path), STEP):
            above = self.open[-1]["skeleton"]
            here = self.skeleton.below.get((above, path[k: k + STEP]), -1) if above >= 0 else -1
            self.open.append(self._node(here, sizes[k // STEP]))
        self.path = path
        top = self.open[-1]
        top["n"] += 1
        top["least"] = conv if top["least"] is None else min(top["least"], conv)
        if top["skeleton"] >= 0:
            top["ends"].append(conv)
            if len(top["ends"]) == ENDS:
                self._tell_ends(top)
        elif top["sha"] is None:
            top["sha"] = hashlib.sha256(b"%d" % conv)
        else:
            top["sha"].update(b",%d" % conv)

    def close(self, depth: int) -> None:
        """Finish the open nodes below a depth; -1 finishes the root too."""
        while len(self.open) > depth + 1:
            x = self.open.pop()
            up = self.open[-1] if self.open else None
            if x["skeleton"] >= 0:
                self._tell_ends(x)
                self.rows.append((
                    _PART, x["no"], None, x["least"], len(self.open), x["n"], x["kids"], x["leaves"], x["saved"], None, x["size"], None))
                continue
            leaves, saved = x["leaves"] or 1, x["saved"] + (x["n"] - 1) * x["size"]
            sha = (x["sha"] or hashlib.sha256()).hexdigest()
            self.rows.append((
                _NODE, x["no"], up["no"], x["least"], len(self.open), x["n"], x["kids"], leaves, saved, sha, None, None))
            up["n"] += x["n"]
            up["least"] = x["least"] if up["least"] is None else min(up["least"], x["least"])
            up["kids"] += 1
            up["leaves"] += leaves
            up["saved"] += saved

    def _tell_ends(self, x: dict) -> None:
        if x["ends"]:
            self.rows.append((_ENDS, x["no"], None, x["ends"][0], *[None] * 7, ",".join(map(str, x["ends"]))))
            x["ends"] = []

    def told(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_SHARD)
        self.rows = []
        kinds = to_arrow_schema(_SHARD)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


def shard_nodes(paths: DataFrame, skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of skeleton nodes, and the ends of skeleton nodes, from sorted shards."""
    sorted_shards = to_shards(paths, skeleton).repartition("shard").sortWithinPartitions("path", "conv_id").select("conv_id", "path", "sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            if shard is None:
                shard = _Shard(skeleton.value, TaskContext.get().partitionId() << 40)
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                shard.add(*row)
                if len(shard.rows) >= 20_000:
                    yield shard.told()
        if shard is not None:
            shard.close(-1)
            yield shard.told()

    return map_batches(sorted_shards, run, _SHARD)


def digest_ends(ends: DataFrame) -> DataFrame:
    """(node, sha) of ids that lie in several rows: the rows of a node pass one task in order, one at a time."""
    schema = StructType([StructField("node", LongType()), StructField("sha", StringType())])

    def run(batches):
        node, sha, done = None, None, []
        for batch in batches:
            for at, part in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if at == node:
                    sha.update(b"," + part.encode())
                else:
                    done += [(node, sha.hexdigest())] if sha else []
                    node, sha = at, hashlib.sha256(part.encode())
        done += [(node, sha.hexdigest())] if sha else []
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["node", "sha"])

    return map_batches(ends.repartition("node").sortWithinPartitions("node", "conv_id").select("node", "ends"), run, schema)


def reduce_skeleton(skeleton: Skeleton, parts: list, shas: dict[int, str]) -> list[tuple]:
    """Rows of the skeleton's nodes: what the shards know of each, summed from the leaves to the root."""
    n = len(skeleton.parent)
    least: list = [None] * n
    convs, kids, leaves, saved, size = ([0] * n for _ in range(5))
    for r in parts:
        k = -1 - r["node"]
        least[k], convs[k], kids[k], leaves[k], saved[k], size[k] = (
            r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["n_bytes"])
    none = hashlib.sha256().hexdigest()
    out = []
    for k in range(n - 1, -1, -1):
        leaves[k] = leaves[k] or 1
        saved[k] += (convs[k] - 1) * size[k]
        up = skeleton.parent[k]
        out.append((
            -1 - k, None if up < 0 else -1 - up, least[k], skeleton.depth[k], convs[k], kids[k], leaves[k], saved[k],
            shas.get(-1 - k, none)))
        if up >= 0:
            least[up] = least[k] if least[up] is None else min(least[up], least[k])
            convs[up] += convs[k]
            kids[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    return out


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, with the columns RESULT.

    The input has conv_id, turn, role and text; other columns are not read. NULL roles and texts are empty, turns without
    a number come first, equal numbers are ordered by a digest of the turn, repeated rows are repeated turns. Rows
    without a conv_id belong to no conversation. A conversation may be left without a turn and is then a member of
    the root alone. An empty frame has no node. Texts of any length count by their digest and bytes only. Turns are equal when the
    128-bit digests of role and text are.

    A conversation's path (24 bytes a turn) is one row. The driver holds the drawn paths and the skeleton: at most SHARDS times
    SPLITTER_TURNS nodes, whatever the input. A task holds one Arrow batch and the stack of one path. Equal paths of
    up to SPLITTER_TURNS turns are spread over shards by conversation.
    """
    spark = conversations.sparkSession
    shards = shards or min(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths = materialize(turn_paths(conversations), "paths")
    skeleton = skeleton_of(paths, shards)
    told = materialize(shard_nodes(paths, spark.sparkContext.broadcast(skeleton)), "trie")
    parts = told.where(F.col("kind") == _PART).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).collect()
    shas = {r["node"]: r["sha"] for r in digest_ends(told.where(F.col("kind") == _ENDS)).collect()} if parts else {}
    rows = reduce_skeleton(skeleton, parts, shas) if parts else []
    nodes = told.where(F.col("kind") == _NODE).select(*_NODES.fieldNames()).unionByName(spark.createDataFrame(rows, _NODES))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent", "left").select(*RESULT)
