"""Helpers shared by the operators: column handling, Arrow slices, words and short hashes."""

from __future__ import annotations

import ctypes
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from io import BytesIO
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import work_dir, write_bytes

#: Bytes of text that an Arrow kernel takes at once: bounds a Python worker's memory.
SLICE_BYTES = 1 << 20


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without the columns that an operator is about to add (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE_BYTES of text; one long text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def trim() -> None:
    """Give back what the C library keeps of freed arrays, where it can."""
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the tasks of this application the package: a zip of its sources in the shared folder, once."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    packed = BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    path = f"{work_dir(spark, 'package')}/{package.name}.zip"
    write_bytes(spark, path, packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package, which the executors need not have installed."""
    ship_package(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on; the next task may need another kind of memory
        trim()

    return df.mapInArrow(task, schema)


def map_text(
    df: DataFrame, text: str, fields: Sequence[StructField], make: Callable[[], Callable[[pa.Array], list]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from Arrow slices of a text column (NULL as empty text).

    ``make`` runs once per task and returns the kernel: a string array in, one array per field
    out. ``keep`` names the input columns to carry along (default: all); a column named like
    a new field is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    types = {f.name: f for f in df.schema.fields}
    schema = StructType([*(types[c] for c in kept), *fields])
    names = [*kept, *(f.name for f in fields)]
    source = df.select(*[F.col(f"`{c}`") for c in (kept if text in kept else [*kept, text])])

    def run(batches):
        kernel = make()
        for batch in batches:
            for piece in text_slices(batch, text):
                column = pc.fill_null(piece.column(text), "")
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *kernel(column)], names)

    return map_batches(source, run, schema)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, and the row of each."""
    split = pc.ascii_split_whitespace(texts)
    flat, row = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.not_equal(flat, "")
    return flat.filter(full), row.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)


def codes_of(words: pa.Array) -> np.ndarray:
    """Equal words have equal small numbers, within this array only."""
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def text_key(text: str) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text, together its identity (NULL as empty)."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def splittable(df: DataFrame, *keys: str) -> DataFrame:
    """An aggregate's rows, ready for a join on long keys in which the other side repeats a key very often.

    Spark splits a hot partition of a join only where both sides come straight out of the join's own
    exchange. An aggregate by the same keys would be joined in place; keys made anew are exchanged again.
    """
    return df.withColumns({k: F.col(k).bitwiseXOR(F.lit(0).cast("long")) for k in keys})


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return x.view(np.int64)
