"""Best-fit packing planned on a histogram of lengths.

Documents longer than the capacity are cut into pieces of the capacity; every other document
is one piece. Pieces are counted by length (at most ``capacity`` rows), best-fit decreasing runs
over these counts on the driver, and every piece takes its planned place by its rank within
its length. The plan does not depend on the number of documents but on the lengths only: a
run places many equal pieces into many equally filled sequences.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ..session import materialize
from .common import map_batches, text_slices, without
from .word_tokens import END_ID, crc_of, encoder

CAPACITY = 4096
PIECE = [
    StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()),
    StructField("ids_crc32", LongType()),
]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", keep: Sequence[str] | None = None,
    end_id: int | None = END_ID, with_ids: bool = False, special_as_text: bool = True,
) -> DataFrame:
    """One row per piece of each document: the kept columns, piece, start, length, ids_crc32 (and ids).

    ``ids`` holds little-endian unsigned 32-bit ids. A NULL text is an empty one: one piece with
    the end id, or none without an end id. ``special_as_text`` takes the strings of special tokens in a
    text as ordinary text, else they become these tokens' ids. Columns of these names in the input are replaced.
    """
    fields = [*PIECE, *([StructField("ids", BinaryType())] if with_ids else [])]
    new = {f.name for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    types = {f.name: f for f in docs.schema.fields}
    schema = StructType([*(types[c] for c in kept), *fields])
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))

    def run(batches):
        codec = encoder(tokenizer, end_id, special_as_text)
        for batch in batches:
            for part in text_slices(batch, "__text"):
                ids, starts = codec.encode(part.column("__text").cast(pa.string()))
                size = np.diff(starts)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = number * capacity
                length = np.minimum(capacity, size[row] - first)
                at = starts[row] + first
                cut = [ids[lo: lo + n] for lo, n in zip(at, length)]
                columns = [c.take(pa.array(row)) for c in part.columns[:-1]]
                columns += [
                    pa.array(number.astype(np.int32)), pa.array(first), pa.array(length),
                    pa.array([crc_of(x) for x in cut], pa.int64())]
                if with_ids:
                    columns.append(pa.array([x.astype("<u4").tobytes() for x in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *(f.name for f in fields)])

    return map_batches(source, run, schema)


def best_fit(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over counts of lengths.

    Returns runs (length, first rank, first sequence, offset, pieces per sequence), sorted by
    length and rank: the piece of rank r in a run goes to sequence ``first + r // per`` at
    ``offset + r % per * length``. Sequences with equal room are one range of numbers, since an
    offset is the capacity less the room; a length splits at most one range and opens at most
    two, so there are at most three times as many ranges as lengths.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    filled = 0  # bit r: some sequence has room r
    opened, runs = 0, []

    def add(space: int, first: int, number: int) -> None:
        nonlocal filled
        if number and space:
            room.setdefault(space, []).append((first, number))
            filled |= 1 << space

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no sequence of {capacity} takes a piece of {length}")
        left, rank = counts[length], 0
        while left:
            fitting = filled >> length
            if fitting:
                space = length + (fitting & -fitting).bit_length() - 1
                first, number = room[space].pop()
                if not room[space]:
                    filled &= ~(1 << space)
            else:
                space, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            per = space // length
            full = min(number, left // per)
            if full:
                runs.append((length, rank, first, capacity - space, per))
                add(space - per * length, first, full)
                left, rank, first, number = left - full * per, rank + full * per, first + full, number - full
            if left and number and left < per:
                runs.append((length, rank, first, capacity - space, per))
                add(space - left * length, first, 1)
                left, first, number = 0, first + 1, number - 1
            add(space, first, number)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Every piece with sequence_id and offset; columns of these names in the input are replaced.

    Lengths must lie between 1 and the capacity; rows with other or NULL lengths fail the plan. An empty
    frame gives an empty frame. Repeated rows are pieces of their own. Equal lengths may
    belong to a large share of all rows: ranks are taken per (length, bucket of rows) and
    shifted by the counts of the earlier buckets.
    """
    spark = pieces.sparkSession
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = without(pieces, ["sequence_id", "offset"]).withColumn("__spread", F.monotonically_increasing_id())
    numbered = materialize(numbered, "pieces").withColumn("__bucket", F.pmod(F.xxhash64("__spread"), F.lit(buckets)))
    size = F.col(f"`{length}`")
    counts = numbered.groupBy(size.alias("__size"), "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    histogram = counts.groupBy("__size").agg(F.sum("__n").alias("n")).collect()  # at most one row per length
    runs = best_fit({r["__size"]: r["n"] for r in histogram}, capacity)
    earlier = F.sum("__n").over(W.partitionBy("__size").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1))
    bases = counts.select("__size", "__bucket", F.coalesce(earlier, F.lit(0)).alias("__base"))
    local = F.row_number().over(W.partitionBy(size, "__bucket").orderBy("__spread")) - 1
    ranked = (
        numbered.withColumn("__local", local)
        .join(bases, (size == F.col("__size")) & (numbered["__bucket"] == bases["__bucket"]))
        .select(*[numbered[f"`{c}`"] for c in numbered.columns if not c.startswith("__")],
                size.cast("long").alias("__length"), (F.col("__base") + F.col("__local")).cast("long").alias("__rank"))
    )
    kept = ranked.columns[:-2]
    schema = StructType([
        *(ranked.schema[c] for c in kept), StructField("sequence_id", LongType()), StructField("offset", LongType())])
    order = runs[:, 0] << 44 | runs[:, 1]

    def run(batches):
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__length", "__rank"))
            of = runs[np.searchsorted(order, size << 44 | rank, "right") - 1]
            inside = rank - of[:, 1]
            sequence, offset = of[:, 2] + inside // of[:, 4], of[:, 3] + inside % of[:, 4] * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(sequence), pa.array(offset)], schema=to_arrow_schema(schema))

    return map_batches(ranked, run, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", keep: Sequence[str] | None = None,
    with_ids: bool = False, special_as_text: bool = True,
) -> DataFrame:
    """Whole documents to packed pieces: ``token_pieces`` and then ``pack``; texts are encoded once."""
    return pack(token_pieces(docs, tokenizer, capacity, text, keep, with_ids=with_ids, special_as_text=special_as_text), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The packed ids themselves: one row per sequence with its ids and the pieces' lengths.

    Needs pieces ``with_ids``. A sequence has at most ``capacity`` pieces, so a row is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("_hex"),
        F.transform("parts", lambda p: p["length"]).alias("lengths"),
    ).select("sequence_id", F.unhex("_hex").alias("ids"), "lengths")
