"""Importance resampling towards a target collection.

Word runs of all texts are hashed into buckets and counted on both sides. A bucket's gain is the logarithm
of its smoothed share in the target over its share in the corpus; the gains are one small array that
every task holds, and a document's weight is the mean gain of its runs. Gumbel noise from a hash of the key turns the
highest scores into a draw without replacement.

The draw is a quickselect over the written table: random rows give pivot keys, one pass counts the rows
below, at and above each of them, and the open range narrows until a pivot is the k-th key. Nothing
but the winners is ever sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .common import map_batches, map_text, text_slices, without

#: Words above this many bytes are hashed one by one, all others side by side.
LONG_WORD = 64
#: Pivot keys per round: a round leaves about an eighth of the open range.
PIVOTS = 16
ADDED = ["n_features", "weight", "score", "rank"]
OWN = ["__words", "__tie", "__at", "__least", "__none", "__key", "__part", "__nth", "__base"]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@lru_cache(maxsize=1)
def _crc_steps() -> np.ndarray:
    """What a byte does to a crc32 register."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1)
    return x


def crc_further(crc: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 values continued over one byte range each."""
    steps, out = _crc_steps(), crc.copy()
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = zlib.crc32(data[start[k]: start[k] + size[k]].tobytes(), int(crc[k]))
    rows = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    rows = rows[np.argsort(-size[rows], kind="stable")]
    at, left, state = start[rows], size[rows], ~crc[rows]
    for k in range(int(left[0]) if len(rows) else 0):
        n = int(np.searchsorted(-left, -k))  # longer words come first: those still open are a prefix
        state[:n] = steps[(state[:n] ^ data[at[:n] + k]) & 255] ^ (state[:n] >> np.uint32(8))
    out[rows] = ~state
    return out


def word_runs(texts: pa.Array, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 and text of every run of 1 to ``longest`` words, joined by one space, and the words of each text."""
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = _LOWER[np.frombuffer(held, np.uint8)[bounds[0]: bounds[-1]]] if held else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    word = _IN_WORD[data]
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    before[bounds[:-1][bounds[:-1] < len(word)]] = False  # no word crosses from one text into the next
    start = np.flatnonzero(word & ~before)
    stop = np.flatnonzero(np.concatenate([(~word | ~before)[1:] & word[:-1], word[-1:]])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    size = stop - start
    crc = crc_further(np.zeros(len(start), np.uint32), data, start, size)
    crcs, rows = [crc], [row]
    space, one = np.array([32], np.uint8), np.ones(len(start), np.int64)
    for n in range(1, longest):
        fits = np.flatnonzero(row[n:] == row[: len(row) - n]) if n < len(row) else np.zeros(0, np.int64)
        grown = crc_further(crc[fits], space, np.zeros(len(fits), np.int64), one[: len(fits)])
        grown = crc_further(grown, data, start[fits + n], size[fits + n])
        crc = np.zeros(len(start), np.uint32)  # runs that would leave their text stay out of the next step too
        crc[fits] = grown
        crcs.append(grown)
        rows.append(row[fits])
    return np.concatenate(crcs), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many word runs of all texts fall into each bucket; the driver gets one row per bucket."""
    schema = StructType([StructField("bucket", LongType()), StructField("n", LongType())])

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in text_slices(batch, "text"):
                crc, _, _ = word_runs(piece.column("text").fill_null(""), longest)
                counts += np.bincount(crc % buckets, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    parts = map_batches(docs.select(F.col(f"`{text}`").alias("text")), run, schema)
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    n, s, t = len(corpus), corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def add_weights(docs: DataFrame, gain: np.ndarray, text: str, longest: int, keep: Sequence[str]) -> DataFrame:
    """Rows with ``__words``, ``n_features`` and ``weight``: the mean gain of the runs, rounded down (0 without a run)."""
    def make():
        def kernel(texts: pa.Array) -> list:
            crc, row, words = word_runs(texts, longest)
            order = np.argsort(row, kind="stable")
            sums = np.concatenate([[0], np.cumsum(gain[crc[order] % len(gain)])])
            n = np.bincount(row, minlength=len(texts))
            ends = np.cumsum(n)
            return [pa.array(words), pa.array(n), pa.array((sums[ends] - sums[ends - n]) // np.maximum(n, 1))]

        return kernel

    return map_text(docs, text, [StructField(c, LongType()) for c in ("__words", "n_features", "weight")], make, keep)


def noisy_score(weight: Column, key: Column, seed: int) -> Column:
    """The weight and Gumbel noise, in thousandths, from the first 32 bits of a hash of seed and key."""
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    share = (bits.cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def _point(values: Row, rows: DataFrame, names: Sequence[str]) -> Column:
    return F.struct(*[F.lit(values[c]).cast(rows.schema[c].dataType).alias(c) for c in names])


def kth_key(rows: DataFrame, names: Sequence[str], k: int, seed: int = 1, pivots: int = PIVOTS) -> Row:
    """The k-th row (from 1) in the ascending order of columns that tell all rows apart, NULL first.

    ``rows`` should be a written table: every round reads it twice, once for the open rows with the least hashes,
    which become pivots, once for exact counts below, at and above each of them. The driver gets ``pivots`` keys
    and their counts; the rounds grow with the logarithm of the rows.
    """
    key, low, high, turn = F.struct(*names), None, None, 0
    while True:
        left = rows
        if low is not None:  # the first column alone can be compared in the scan
            left = left.where(F.col(names[0]) >= low[names[0]]).where(key > _point(low, rows, names))
        if high is not None:
            left = left.where(F.col(names[0]) <= high[names[0]]).where(key < _point(high, rows, names))
        drawn = left.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), *names), *names).select(*names).limit(pivots).collect()
        drawn.sort(key=lambda r: [(r[c] is not None, r[c]) for c in names])
        points = F.array(*[_point(r, rows, names) for r in drawn])
        # how many pivots lie below a row, and whether it is the next one
        place = F.size(F.filter(points, lambda p: p < key)).alias("place"), F.exists(points, lambda p: p == key).alias("at")
        counts = {(r["place"], r["at"]): r["count"] for r in left.groupBy(*place).count().collect()}
        gone = 0
        for i, r in enumerate(drawn):
            below, here = gone + counts.get((i, False), 0), counts[i, True]
            if below >= k:
                high = r
                break
            if below + here >= k:
                return r
            low, gone = r, below + here
        k, turn = k - gone, turn + 1


def ranked(rows: DataFrame, names: Sequence[str], name: str = "rank") -> DataFrame:
    """Rows numbered from 1 in the order of ``names``: ranges are sorted apart, their sizes give the first numbers."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(n, *names).sortWithinPartitions(*names)
    placed = materialize(ordered.withColumns({
        "__part": F.spark_partition_id(), "__nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ranked")
    before = F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))  # a row per range
    bases = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", F.coalesce(before, F.lit(0)).alias("__base"))
    numbered = placed.join(bases, "__part").withColumn(name, (F.col("__base") + F.col("__nth") + 1).cast("long"))
    return numbered.drop("__part", "__nth", "__base")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1,
    buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024, keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with n_features, weight, score and rank: 1, 2, 3 ... for the drawn rows, NULL for the others.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) with the highest scores are drawn. Words are
    runs of ASCII digits, letters (lower-cased) and of characters beyond ASCII; features are runs of
    1 to ``longest`` words. NULL texts have none; texts without a feature weigh 0. NULL keys are hashed as an empty one
    and come after others of the same score. Rows of equal score and key are told apart by a hash of the text, equal rows by
    where they were read. Columns of the input that are named like a new one (ADDED, OWN) are left out. Empty frames give empty frames or, as a target, counts of 0.

    Only whole texts are read, in slices of a few MB; a very long text is a slice of its own. The driver holds two
    counts per bucket and the pivots of a round. The table of scores is written once; no row is sorted but the winners.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    shown = without(docs, [*ADDED, *OWN]).columns
    shown = shown if keep is None else [c for c in shown if c in keep]
    read = list(dict.fromkeys([*shown, key, text]))
    source = docs.select(*[F.col(f"`{c}`") for c in read])
    weighed = add_weights(
        source.withColumn("__tie", F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))), gain, text, longest, [*shown, "__tie"])
    weighed = weighed.withColumns({
        "score": noisy_score(F.col("weight"), F.col(f"`{key}`"), seed), "__at": F.monotonically_increasing_id()})
    scored = materialize(weighed.withColumns({
        "__least": -F.col("score"), "__none": F.col(f"`{key}`").isNull(), "__key": F.col(f"`{key}`")}), "scored")
    names = ["__least", "__none", "__key", "__tie", "__at"]
    entitled = scored.where(F.col("__words") >= min_words)
    k = entitled.count() * percent // 100
    result = [*[F.col(f"`{c}`") for c in shown], *ADDED]
    if not k:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*result)
    last = _point(kth_key(entitled.select(*names), names, k, seed), scored, names)
    won = (F.col("__words") >= min_words) & (F.struct(*names) <= last)
    winners = ranked(scored.where(won), names)
    others = scored.where(~won).withColumn("rank", F.lit(None).cast("long"))
    return winners.select(*result).unionByName(others.select(*result))
