"""Token ids as flat files: unsigned integers, 64-bit document offsets, memory-mapped.

A folder holds, per part, ``*.ids`` (little-endian unsigned 16- or 32-bit ids, one document
after the other), ``*.offsets`` (n + 1 unsigned 64-bit positions within the part) and
``*.keys`` (an Arrow file of the document keys), and one ``manifest.json`` that lists the parts
in key order with their bases: prefix sums of the parts' ids and documents. A document's
absolute position is its part's base plus its offset.

Every task attempt writes files of its own name; the manifest lists those of the attempts that
succeeded, so a lost executor or a second attempt leaves the result right.
"""

from __future__ import annotations

import json
import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import map_batches, text_slices
from .word_tokens import END_ID, crc_of, encoder

MANIFEST = "manifest.json"
#: Ids read at once when a file is not on a mapped disk or a checksum is taken.
WINDOW = 1 << 22


def open_store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it (plain paths, file:, hdfs:, s3a: ...)."""
    if folder.startswith("/"):
        return pafs.LocalFileSystem(), folder
    folder = re.sub(r"^file:/+", "file:///", folder)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
    end_id: int | None = END_ID, parts: int | None = None, special_as_text: bool = True,
) -> dict:
    """Encode every whole text and write it in ascending key order; returns the manifest.

    NULL texts count as empty and hold the end id only. NULL keys come first; rows with equal
    keys follow each other in the order in which they were read. An empty frame writes a manifest without parts.
    ``special_as_text`` takes the strings of special tokens in a text as ordinary text, else they become these tokens' ids.
    Other columns are not written. The driver receives one row per part.

    Spark range-partitions by (key, reading position), so neither a hot key nor repeated rows
    meet in one part. A task holds one Arrow batch and the part's offsets and keys.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = StructType([StructField("key", docs.schema[key].dataType)])
    ordered = (
        docs.select(
            F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("spread"))
        .repartitionByRange(n, "key", "spread").sortWithinPartitions("key", "spread").select("key", "text")
    )
    run_id = uuid.uuid4().hex[:12]

    def run(batches):
        task = TaskContext.get()
        name = f"{run_id}-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, root = open_store(folder)
        codec = encoder(tokenizer, end_id, special_as_text)
        offsets, keys, total = [np.zeros(1, np.int64)], [], 0
        ids_file = None
        for batch in batches:
            for piece in text_slices(batch, "text"):
                if ids_file is None:
                    store.create_dir(root, recursive=True)
                    ids_file = store.open_output_stream(f"{root}/{name}.ids")
                ids, starts = codec.encode(_strings(piece.column("text")))
                ids_file.write(ids.tobytes())
                offsets.append(starts[1:] + total)
                keys.append(piece.column("key"))
                total += len(ids)
        if ids_file is None:
            return
        ids_file.close()
        with store.open_output_stream(f"{root}/{name}.offsets") as out:
            out.write(np.concatenate(offsets).astype("<u8").tobytes())
        schema = to_arrow_schema(kind)
        table = pa.Table.from_arrays([pa.chunked_array(keys).cast(schema.field(0).type)], schema=schema)
        with store.open_output_stream(f"{root}/{name}.keys") as out, pa.ipc.new_file(out, schema) as writer:
            writer.write_table(table)
        yield pa.RecordBatch.from_pydict({
            "part": [task.partitionId()], "name": [name], "n_docs": [len(table)], "n_ids": [total],
            "dtype": [codec.dtype.str]})

    result = StructType([
        StructField("part", LongType()), StructField("name", StringType()), StructField("n_docs", LongType()),
        StructField("n_ids", LongType()), StructField("dtype", StringType()),
    ])
    written = sorted((r.asDict() for r in map_batches(ordered, run, result).collect()), key=lambda r: r["part"])
    base, first = 0, 0
    for r in written:
        r |= {"id_base": base, "doc_base": first}
        base, first = base + r["n_ids"], first + r["n_docs"]
    manifest = {"key": key, "key_type": kind[0].dataType.json(), "n_ids": base, "n_docs": first, "parts": written}
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _strings(column: pa.Array) -> pa.Array:
    return column if column.type == pa.string() else column.cast(pa.string())


def mapped(store: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped on a local or mounted disk, else read into memory."""
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: key, start (ids of all documents before it), n_tokens, ids_crc32.

    The parts are read by separate tasks; files are mapped, so a task holds one document's ids.
    """
    store, root = open_store(folder)
    with store.open_input_file(f"{root}/{MANIFEST}") as file:
        manifest = json.loads(file.read())
    from pyspark.sql.types import _parse_datatype_json_string

    key = manifest["key"]
    kind = _parse_datatype_json_string(manifest["key_type"])
    result = StructType([
        StructField(key, kind), StructField("start", LongType()), StructField("n_tokens", LongType()),
        StructField("ids_crc32", LongType()),
    ])
    parts = [(p["name"], p["id_base"], p["dtype"]) for p in manifest["parts"]]
    listed = spark.createDataFrame(parts, "name string, base long, dtype string")
    if parts:
        listed = listed.repartition(len(parts))

    def run(batches):
        store, root = open_store(folder)
        for batch in batches:
            for part in batch.to_pylist():
                path = f"{root}/{part['name']}"
                at = mapped(store, f"{path}.offsets", "<u8").astype(np.int64)
                ids = mapped(store, f"{path}.ids", part["dtype"])
                with store.open_input_file(f"{path}.keys") as file:
                    keys = pa.ipc.open_file(file).read_all().column(0).combine_chunks()
                crc = [crc_of(np.asarray(ids[lo:hi])) for lo, hi in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(at[:-1] + part["base"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    schema=to_arrow_schema(result))

    return map_batches(listed, run, result)
