"""Document fingerprints: a quartile digest of hashed byte triplets, and a bounded difference.

A digest has 64 bytes for 256 buckets (two bits each: how many of the three quartile
thresholds the bucket's count exceeds), one byte for the logarithm of the length and one byte
for the quartile ratios, as lowercase hex. Equal texts have equal digests. ``likeness`` of two
digests is 1 minus their difference over the largest possible difference.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..session import materialize
from .common import map_batches, map_text, mix64

BUCKETS = 256
#: Three triplets of each five-byte window: neighbours and two with gaps.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 4))
CHUNK = 1 << 20
_BYTES = np.arange(256, dtype=np.uint64)
_TABLES = [(mix64(_BYTES + np.uint64(1000 * k + 1)) & np.uint64(255)).astype(np.uint8) for k in range(4)]


def bucket_counts(data: bytes) -> np.ndarray:
    """How often each bucket is hit; taken in chunks, so a long text needs no more memory."""
    total = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(len(data) - 2, 0), CHUNK):
        part = np.frombuffer(data, np.uint8, min(CHUNK + 4, len(data) - lo), lo)
        for k, (a, b, c) in enumerate(TRIPLETS):
            n = min(len(part) - c, CHUNK)
            if n <= 0:
                continue
            # each position passes through a table, so that the order of the bytes counts
            h = _TABLES[0][part[a: a + n] ^ np.uint8(17 * k)]
            h = _TABLES[1][h ^ part[b: b + n]]
            h = _TABLES[2][h ^ part[c: c + n]]
            total += np.bincount(h, minlength=BUCKETS)
    return total


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[63, 127, 191]]
    level = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    level = level.reshape(-1, 4)
    body = level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6
    size = min(255, round(8 * float(np.log2(1 + len(data)))))
    ratios = 0 if not q3 else int(15 * q1 // q3) << 4 | int(15 * q2 // q3)
    return bytes([size, ratios, *body.astype(np.uint8).tolist()]).hex()


# difference of two bytes of levels: 0, 1, 2 and, for opposite quartiles, 6
_STEP = np.array([0, 1, 2, 6])
_PAIR = np.arange(256)
_LEVELS = np.stack([_PAIR >> (2 * k) & 3 for k in range(4)])
_BODY = sum(_STEP[np.abs(x[:, None] - x[None, :])] for x in _LEVELS).astype(np.int64)
LENGTH_MOST, RATIO_MOST = 200, 60
MOST = 6 * BUCKETS + LENGTH_MOST + RATIO_MOST


def difference(a: str, b: str) -> int:
    """Between 0 and MOST; 0 for equal digests."""
    x, y = (np.frombuffer(bytes.fromhex(v), np.uint8).astype(np.int64) for v in (a, b))
    length = min(LENGTH_MOST, 4 * abs(int(x[0] - y[0])))
    ratios = 2 * (abs(int((x[1] >> 4) - (y[1] >> 4))) + abs(int((x[1] & 15) - (y[1] & 15))))
    return length + min(RATIO_MOST, ratios) + int(_BODY[x[2:], y[2:]].sum())


def likeness(a: str, b: str) -> float:
    return 1 - difference(a, b) / MOST


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Every row with the digest of its whole text, NULL as empty. A column of that name is replaced."""
    def make():
        return lambda texts: [pa.array([fingerprint(t) for t in texts.to_pylist()], pa.string())]

    return map_text(docs, text, [StructField(name, StringType())], make)


def edited(text: str, following: str) -> str:
    """The last half of the text gives way to as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = [
    StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
    StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
    StructField("near_edited", DoubleType()), StructField("near_next", DoubleType()),
]


def _compare(text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following)
    mark = fingerprint(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), sha, own, mark, likeness(own, mark), likeness(own, other)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document against its own edited text and against the next document in key order.

    Returns the key and n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The document after the last is the first. NULL keys come first and NULL texts
    count as empty; rows with equal keys are ordered by a hash of their text, so repeated rows
    follow each other. A single document follows itself. An empty frame gives an empty frame.

    Spark range-partitions the documents by (key, hash), which also splits a key that many rows
    share. A task keeps two texts at a time. Only the last row of each partition waits
    for the first row of the next: those rows, one per partition, meet in a small join.
    """
    kind = docs.schema[key].dataType
    source = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = source.withColumn("tie", tie).withColumn("spread", F.monotonically_increasing_id())
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = ordered.repartitionByRange(n, "key", "tie", "spread").sortWithinPartitions("key", "tie", "spread")
    schema = StructType([
        StructField("part", LongType()), StructField("edge", StringType()), StructField("key", kind),
        StructField("text", StringType()), *_RESULT,
    ])
    names = schema.fieldNames()

    def run(batches):
        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            out = []
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                now = (k, t, fingerprint(t))
                if before is None:
                    out.append((part, "first", k, t, None, None, now[2], None, None, None))
                else:
                    out.append((part, None, before[0], None, *_compare(before[1], before[2], t, now[2])))
                before = now
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], _arrow(schema))
        if before is not None:
            last = (part, "last", before[0], before[1], None, None, before[2], None, None, None)
            yield pa.RecordBatch.from_pylist([dict(zip(names, last))], _arrow(schema))

    done = materialize(map_batches(ordered.select("key", "text"), run, schema), "digest")
    # one row per partition: its order, and the first text of the next one
    firsts = done.where("edge = 'first'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    order = W.orderBy("part")
    ranked = done.where("edge = 'first'").select(
        "part", F.coalesce(F.lead("part").over(order), F.min("part").over(W.partitionBy(F.lit(1)))).alias("next_part"))
    edges = (
        done.where("edge = 'last'").select("part", "key", "text", "fingerprint")
        .join(ranked, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    )
    closing = StructType([StructField("key", kind), *_RESULT])

    def close(batches):
        for batch in batches:
            rows = [
                (r["key"], *_compare(r["text"], r["fingerprint"], r["next_text"], r["next_mark"]))
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(closing.fieldNames(), x)) for x in rows], _arrow(closing))

    inner = done.where("edge IS NULL").select("key", *[f.name for f in _RESULT])
    outer = map_batches(edges.select("key", "text", "fingerprint", "next_text", "next_mark"), close, closing)
    return inner.unionByName(outer).select(F.col("key").alias(key), *[f.name for f in _RESULT])


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
