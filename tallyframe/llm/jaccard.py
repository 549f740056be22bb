"""Similarity join of documents on word n-grams, with Bayesian pruning of candidates.

1. A document is its set of hashed five-word shingles. Documents with equal sets are one node.
2. 128 MinHash values a node; nodes that agree on a band of four meet in a bucket (a pair
   of similarity 0.8 misses all 32 bands with probability 5e-8).
3. In a bucket, MinHash values are compared 16 at a time; a pair goes on only while the posterior
   probability that its similarity reaches the threshold is at least ``tolerance`` (uniform
   prior, so the posterior is a beta law). What is left ties nodes into candidate clusters.
4. Within a cluster all pairs are verified exactly on the whole shingle sets. The verified links give each
   node its number of links, and their components are the classes.

Buckets and clusters of any size are cut into blocks of about ``BLOCK`` nodes, and each pair of
blocks is a row of work: no group is ever in one place, and no pair leaves a block pair: only
counts and spanning edges do. Where the sets of a block pair would be more than ``ROW_BYTES``, they are cut by
ranges of the shingles' hashes; each range gives a matrix of partial intersections, and their sum is verified. So a row
is bounded in nodes and in bytes, however long the texts are. The work in a group of different near copies grows with the square of
their number, as the number of links does; copies with equal sets count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from ..session import drop_work, materialize, work_dir
from .common import as_long, map_batches, map_text, mix64, splittable, text_key, text_slices, words_of
from .graph import components

WIDTH = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 32, 4
STEP = 16
#: Nodes in a block: bounds what a task holds.
BLOCK = 256
#: Bytes of shingles in a row of work: two blocks' sets, or one range of them.
ROW_BYTES = 64 << 20
#: Shingles whose columns are multiplied at once when pairs are verified.
COLUMNS = 8192

_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 % (1 << 63)))
_TIMES = (_SEEDS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_SEEDS[BANDS * ROWS:] >> np.uint64(32)).astype(np.uint32)


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values among ``n`` for which P(similarity >= threshold) reaches the tolerance.

    With a uniform prior the posterior is Beta(k + 1, n - k + 1), whose upper tail at t is the
    chance that a binomial of n + 1 trials with probability t is at most k.
    """
    below = 0.0
    for k in range(n + 1):
        below += comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
        if below >= tolerance:
            return k
    return n + 1


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of all texts: bounds (one more than texts) and, between them, sorted 64-bit hashes.

    Words lie between ASCII white space. A text with one to ``width`` - 1 words is one shingle of
    all its words; a text without a word has the empty set.
    """
    n = len(texts)
    words, row = words_of(texts)
    coded = words.dictionary_encode()
    listed = np.asarray(coded.dictionary.to_numpy(zero_copy_only=False), dtype=object)
    hashed = pd.util.hash_array(listed, categorize=False).astype(np.uint64) if len(listed) else np.zeros(0, np.uint64)
    word = hashed[coded.indices.to_numpy(zero_copy_only=False)]
    base = np.uint64(0xD6E8FEB86659FD93)
    count = np.bincount(row, minlength=n)
    m = max(len(word) - width + 1, 0)
    code = np.zeros(m, np.uint64)
    for k in range(width):
        code = code * base + word[k: k + m]
    inside = row[:m] == row[width - 1:] if m else np.zeros(0, bool)
    code, of = mix64(code[inside]), row[:m][inside]
    short = np.flatnonzero((count > 0) & (count < width))
    starts = np.cumsum(count) - count
    extra = np.zeros(len(short), np.uint64)
    for i, r in enumerate(short):
        value = np.uint64(count[r])
        for w in word[starts[r]: starts[r] + count[r]]:
            value = np.uint64((int(value) * int(base) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        extra[i] = value
    code, of = np.concatenate([code, mix64(extra)]), np.concatenate([of, short])
    order = np.lexsort((code, of))
    code, of = code[order], of[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    code, of = code[new], of[new]
    return np.searchsorted(of, np.arange(n + 1)), code


def signatures(bounds: np.ndarray, code: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits), one row per text; texts with an empty set have all ones."""
    n = len(bounds) - 1
    out = np.full((n, BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    low = (code >> np.uint64(32)).astype(np.uint32)
    for k in range(BANDS * ROWS):
        value = low * _TIMES[k] + _PLUS[k]
        value ^= value >> np.uint32(15)
        out[full, k] = np.minimum.reduceat(value * np.uint32(0x85EBCA6B), bounds[full])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C55) + parts[:, :, k])
    return key


SIGNED = [
    StructField("s1", LongType()), StructField("s2", LongType()), StructField("size", LongType()),
    StructField("signature", BinaryType()), StructField("bands", ArrayType(LongType())),
]


def _sign(width: int):
    def run(texts: pa.Array) -> list:
        bounds, code = shingles(texts, width)
        size = np.diff(bounds)
        sums = []
        for salt in (np.uint64(0), np.uint64(0xC2B2AE3D27D4EB4F)):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(code ^ salt), dtype=np.uint64)])
            sums.append(as_long(total[bounds[1:]] - total[bounds[:-1]]))
        signature = signatures(bounds, code)
        keys = as_long(band_keys(signature)).ravel()
        low = signature.astype("<u2")  # the lower half of each value: never less alike than the whole
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * BANDS), pa.array(keys))
        return [pa.array(sums[0]), pa.array(sums[1]), pa.array(size), pa.array([x.tobytes() for x in low], pa.binary()), lists]

    return run


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member that each of ``n`` members reaches over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label


def alike(signature: np.ndarray, side: np.ndarray, floors: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that survive the incremental comparison; with two sides, only pairs across."""
    if side.any():
        a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1), indexing="ij"))
    else:
        a, b = np.triu_indices(len(signature), 1)
    same = np.zeros(len(a), np.int32)
    for k, floor in enumerate(floors):
        part = signature[:, k * STEP: (k + 1) * STEP]
        same = same + (part[a] == part[b]).sum(axis=1, dtype=np.int32)
        alive = same >= floor
        a, b, same = a[alive], b[alive], same[alive]
        if not len(a):
            break
    return a, b


def blocked(members: DataFrame, group: str, size: str, node: str, carry: list[str], also: tuple[str, ...] = ()) -> DataFrame:
    """Members of groups to pairs of blocks: group, lo, hi, ``also`` and the list of (side, node, carried columns).

    A group of m members has m / BLOCK blocks by a hash of the node. Every member goes to the block
    pairs that its block is part of; a list holds two blocks at most.
    """
    number = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(node, F.lit("block")), number).cast("int")
    sent = members.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), number - 1)))
    return (
        sent.select(
            group, *also, F.least("__own", "__other").alias("lo"), F.greatest("__own", "__other").alias("hi"),
            F.struct((F.col("__own") > F.col("__other")).cast("byte").alias("side"), node, *carry).alias("m"))
        .groupBy(group, *also, "lo", "hi").agg(F.collect_list("m").alias("m"))
        .where(F.size("m") > 1)
    )


def _members(row: pa.Array) -> dict[str, pa.Array]:
    """The fields of one list of structs."""
    return {f.name: row.field(k) for k, f in enumerate(row.type)}


EDGES = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _candidate_edges(groups: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    floors = [least_matches(n, threshold, tolerance) for n in range(STEP, BANDS * ROWS + 1, STEP)]

    def run(batches):
        for batch in batches:
            lists = batch.column("m")
            ends = lists.offsets.to_numpy()
            fields = _members(lists.values)
            side = fields["side"].to_numpy(zero_copy_only=False)
            node = fields["sid"].to_numpy(zero_copy_only=False)
            signature = np.frombuffer(b"".join(fields["signature"].to_pylist()), "<u2").reshape(-1, BANDS * ROWS)
            lo_out, hi_out = [], []
            for lo, hi in zip(ends, ends[1:]):
                a, b = alike(signature[lo:hi], side[lo:hi], floors)
                label = spanning(hi - lo, a, b)
                tied = np.flatnonzero(label != np.arange(hi - lo))
                lo_out.append(node[lo:hi][tied])
                hi_out.append(node[lo:hi][label[tied]])
            if lo_out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lo_out), pa.int64()), pa.array(np.concatenate(hi_out), pa.int64())], ["a", "b"])

    return map_batches(groups.select("m"), run, EDGES)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slices of the shingles."""
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = int(column.max(initial=-1)) + 1
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for lo in range(0, width, COLUMNS):
        i, j = np.searchsorted(column, (lo, lo + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, width - lo)), np.float32)
        part[row[i:j], column[i:j] - lo] = 1
        total += part @ part.T
    return total.astype(np.int64)


VERIFIED = StructType([
    StructField("sid", LongType()), StructField("links", LongType()), StructField("linked_docs", LongType()),
    StructField("tied", LongType()),
])


def _linked(side: np.ndarray, node: np.ndarray, copies: np.ndarray, size: np.ndarray, shared: np.ndarray, t: Fraction) -> pa.RecordBatch:
    """Per node of a block pair: verified links, documents behind them, and a node it is tied to."""
    union = size[:, None] + size[None, :] - shared
    linked = shared * t.denominator >= t.numerator * union
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(linked))
    label = spanning(len(node), a, b)
    return pa.RecordBatch.from_arrays([
        pa.array(node, pa.int64()), pa.array(linked.sum(axis=1), pa.int64()),
        pa.array(linked @ copies, pa.int64()), pa.array(node[label], pa.int64())], schema=to_arrow_schema(VERIFIED))


_FACTS = ("side", "sid", "copies", "size")


def _intersections(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Each row's members in order, as (side, sid, copies, size), and the sizes of the intersections of their shingles."""
    for k in range(batch.num_rows):
        fields = _members(batch.column("m").slice(k, 1).flatten())
        facts = [fields[c].to_numpy(zero_copy_only=False) for c in _FACTS]
        order = np.lexsort((facts[1], facts[0]))
        grams = fields["grams"]
        yield k, [x[order] for x in facts], common_counts([np.frombuffer(grams[i].as_buffer(), "<u8") for i in order.tolist()])


def _verify(groups: DataFrame, threshold: float) -> DataFrame:
    """Verified links of block pairs whose whole sets are in one row."""
    t = Fraction(threshold).limit_denominator(10_000)

    def run(batches):
        for batch in batches:
            for _, facts, shared in _intersections(batch):
                yield _linked(*facts, shared, t)

    return map_batches(groups.select("m"), run, VERIFIED)


def _verify_ranges(groups: DataFrame, threshold: float) -> DataFrame:
    """Verified links of block pairs whose sets lie in ranges: partial intersections, then their sum, matrix by matrix."""
    t = Fraction(threshold).limit_denominator(10_000)
    keys = [StructField(c, LongType()) for c in ("root", "lo", "hi", "part")]
    schema = StructType([*keys, *(StructField(c, ArrayType(LongType())) for c in _FACTS), StructField("shared", BinaryType())])
    arrow = to_arrow_schema(schema)

    def parts(batches):
        for batch in batches:
            for k, facts, shared in _intersections(batch):
                values = [*(batch.column(c)[k].as_py() for c in ("root", "lo", "hi", "part")), *(x.tolist() for x in facts)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([v], f.type) for v, f in zip(values, arrow)), pa.array([shared.astype("<i4").tobytes()], pa.binary())], schema=arrow)

    def total(batches):
        now, facts, shared = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                own = row["root"], row["lo"], row["hi"]
                part = np.frombuffer(row["shared"], "<i4").reshape(len(row["sid"]), -1)
                if own == now:
                    shared += part
                    continue
                if now is not None:
                    yield _linked(*facts, shared, t)
                now, facts, shared = own, [np.array(row[c], np.int64) for c in _FACTS], part.astype(np.int64)
        if now is not None:
            yield _linked(*facts, shared, t)

    found = map_batches(groups.select(*[F.col(f.name).cast("long").alias(f.name) for f in keys], "m"), parts, schema)
    order = ["root", "lo", "hi", "part"]
    return map_batches(found.repartition(*order[:3]).sortWithinPartitions(*order), total, VERIFIED)


def _gram_sets(texts: DataFrame, width: int) -> DataFrame:
    """The shingle set of each text in ``parts`` ranges of hashes: a row per range, empty ones too, with the whole set's size."""
    kept = [c for c in texts.columns if c != "text"]
    schema = StructType([*(texts.schema[c] for c in kept), StructField("size", LongType()), StructField("part", LongType()),
                         StructField("grams", BinaryType())])

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text"):
                bounds, code = shingles(pc.fill_null(piece.column("text"), ""), width)
                row, size, part, grams = [], [], [], []
                for k, n in enumerate(piece.column("parts").to_pylist()):
                    own = code[bounds[k]: bounds[k + 1]]
                    edges = np.searchsorted(own, np.array([(r << 64) // n for r in range(1, n)], np.uint64)).tolist() if n > 1 else []
                    for r, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(own)])):
                        row.append(k)
                        size.append(len(own))
                        part.append(r)
                        grams.append(own[lo:hi].astype("<u8").tobytes())
                some = piece.select(kept).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(size, pa.int64()), pa.array(part, pa.int64()), pa.array(grams, pa.binary())], schema.fieldNames())

    return map_batches(texts, run, schema)


def similar_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, width: int = WIDTH,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per (key, text): key, t1, t2, class_id, class_size, n_links, n_text_links, n_copies.

    class_id is the least key of the documents that links connect, class_t1 and class_t2 the text hashes
    of that document. n_links counts the other documents of similarity ``threshold`` or more, copies
    included; n_text_links counts different shingle sets; n_copies documents with the same set.
    """
    spark = docs.sparkSession
    t1, t2 = text_key(text)
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), t1.alias("t1"), t2.alias("t2"))
    paths = {name: work_dir(spark, name) for name in ("signed", "nodes", "verified")}
    signed = materialize(map_text(keyed, "text", SIGNED, lambda: _sign(width), ["key", "t1", "t2"]), "signed", paths["signed"])
    nodes = signed.groupBy("s1", "s2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "t1", "t2")).alias("one"), F.max("size").alias("size"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    nodes = materialize(nodes.withColumn("sid", F.monotonically_increasing_id()), "nodes", paths["nodes"])
    # buckets with two nodes or more; of buckets with the same nodes, the one of the first band
    each = nodes.where("size > 0").select("sid", F.posexplode("bands").alias("band", "bucket"))
    mark = F.xxhash64("sid", F.lit("member"))
    buckets = each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("band").alias("band"), F.bit_xor("sid").alias("x1"), F.bit_xor(mark).alias("x2"))
    kept = buckets.where("n > 1").groupBy("n", "x1", "x2").agg(F.min(F.struct("band", "bucket")).alias("b"))
    members = each.join(kept.select("n", F.col("b.bucket").alias("bucket")), "bucket").select("bucket", "n", "sid")
    members = members.join(nodes.select("sid", "signature"), "sid")
    edges = _candidate_edges(blocked(members, "bucket", "n", "sid", ["signature"]), threshold, tolerance)
    clusters = components(edges)
    # the shingle sets of clustered nodes, each from one of its texts; long sets in as many ranges as keep rows in bounds
    sized = clusters.join(nodes.select(F.col("sid").alias("node"), "size"), "node").groupBy("root").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("longest"))
    sized = sized.select("root", "n", F.ceil(F.least("n", F.lit(2 * BLOCK)) * F.col("longest") * 8 / F.lit(ROW_BYTES)).cast("int").alias("parts"))
    facts = nodes.select("sid", "copies", F.col("one.key").alias("o"), F.col("one.t1").alias("o1"), F.col("one.t2").alias("o2"))
    wanted = clusters.join(splittable(sized, "root"), "root").join(facts, clusters["node"] == facts["sid"]).select("root", "n", "parts", "sid", "copies", "o", "o1", "o2")
    same = (keyed["t1"] == wanted["o1"]) & (keyed["t2"] == wanted["o2"]) & keyed["key"].eqNullSafe(wanted["o"])
    texts = keyed.join(wanted, same).select("root", "n", "parts", "sid", "copies", "text").dropDuplicates(["sid"])
    sets, carried = _gram_sets(texts, width), ["copies", "size", "grams"]
    groups = blocked(sets, "root", "n", "sid", carried, ("parts", "part"))
    # where no cluster's sets are long, one branch does: two would make the shingle sets twice, side by side
    # (without clusters first: no set may be long at all)
    longest = nodes.agg(F.max("size")).first()[0] or 0
    if longest * 8 * 2 * BLOCK <= ROW_BYTES or (sized.agg(F.max("parts")).first()[0] or 1) == 1:
        checked = _verify(groups, threshold)
    else:
        checked = _verify(groups.where("parts = 1"), threshold).unionByName(_verify_ranges(groups.where("parts > 1"), threshold))
    verified = materialize(checked, "verified", paths["verified"])
    classes = components(verified.where("sid <> tied").select(F.col("sid").alias("a"), F.col("tied").alias("b")))
    links = verified.groupBy("sid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    placed = (
        nodes.select("sid", "s1", "s2", "copies", "one")
        .join(classes.withColumnRenamed("node", "sid"), "sid", "left").join(links, "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
    )
    heads = placed.groupBy("root").agg(F.min("one").alias("head"), F.sum("copies").alias("class_size"))
    result = placed.join(splittable(heads, "root"), "root").select(
        "s1", "s2", F.col("head.key").alias("class_id"), F.col("head.t1").alias("class_t1"), F.col("head.t2").alias("class_t2"),
        "class_size", (F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_text_links"), F.col("copies").alias("n_copies"))
    found = materialize(signed.select("key", "t1", "t2", "s1", "s2").join(result, ["s1", "s2"]).drop("s1", "s2"), "classes")
    for path in paths.values():
        drop_work(spark, path)
    return found


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: key, class_id, class_size, n_links, n_text_links, n_copies (see ``similar_texts``).

    NULL and empty texts have the empty set: they are copies of each other and link to nothing
    else. Repeated rows are copies. NULL keys are greater than none: a class of NULL keys only has a NULL
    class_id. Other columns of the input, of any names, are not returned. An empty frame gives an empty frame. Very long
    texts are compared whole, their sets in ranges of hashes.
    """
    found = similar_texts(docs, key, text, **options)
    return found.select(F.col("key").alias(key), "class_id", "class_size", "n_links", "n_text_links", "n_copies")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the least key of each class; of rows repeated as a whole, one. All columns stay.

    NULL, empty and very long texts count as in ``join_similar``; columns that start with two underscores must not occur.
    """
    found = similar_texts(docs, key, text, **options)
    others = found.where("class_size > 1").select("t1", "t2", "class_id", "class_t1", "class_t2").distinct()
    t1, t2 = text_key(text)
    rows = docs.withColumns({"__t1": t1, "__t2": t2})
    others = splittable(others.dropDuplicates(["t1", "t2"]), "t1", "t2")
    joined = rows.join(others, (rows["__t1"] == others["t1"]) & (rows["__t2"] == others["t2"]), "left")
    single = joined.where("class_t1 IS NULL")
    head = joined.where(
        (F.col("__t1") == F.col("class_t1")) & (F.col("__t2") == F.col("class_t2")) & F.col(f"`{key}`").eqNullSafe(F.col("class_id")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*names).unionByName(head.dropDuplicates(["__t1", "__t2"]).select(*names))
