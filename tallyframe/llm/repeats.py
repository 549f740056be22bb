"""Removal of every byte string of ``window`` bytes that also starts elsewhere, by anchors and hash groups.

This stands in for a depth-limited radix sort of suffixes by digit passes: no suffix is put in order and no digit is read.
A pass groups what earlier passes left by the hash of more bytes and drops what is alone; groups
that are equal over the whole window are the repeated windows. So that not every suffix has
to travel, windows go together in ranges that share an anchor, the least gram of each window (equal
windows have it at the same place):

1. the anchors themselves, one for about 160 windows; those that occur once are dropped;
2. whole ranges of windows; equal ranges are repeated as a whole;
3. blocks of 32, then 4, then single windows of the ranges that are left. A block goes on
   only while the bytes shared by all its windows occur elsewhere, and is done when all
   bytes that it covers do.

One member of every finished group stays in the search, for others that share only part of it.
Every test is a count by hash that is combined before the shuffle, so a passage in a
third of all documents is no hot group. Nothing is collected but lists within one text.
Anchors are compared by 64 bits (a filter only), finished ranges by a 64-bit hash and a second one of two polynomials
modulo primes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import drop_work, materialize, work_dir
from .common import as_long, map_batches, map_text, mix64, splittable, text_key, text_slices, without, words_of
from .repeats_kernel import range_hashes, text_anchors

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = 400
GRAM = 81
#: Blocks of the last passes; each divides the one before, the last must be 1.
WIDTHS = (32, 4, 1)
KEY = ("t1", "t2")
SPAN = "array<struct<at:int,near:int,far:int>>"
RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans")


def repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """The keys that two or more different rows (by ``id``) have, with the least id."""
    least = rows.groupBy(*by).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    return least.where("least <> most").drop("most")


class _Work:
    """Written tables of one call; all but the last needed are dropped as soon as they are read."""

    def __init__(self, spark):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = work_dir(self.spark, f"repeats-{name}")
        return materialize(df, name, self.paths[name])

    def drop(self, *names: str) -> None:
        for name in list(names):
            drop_work(self.spark, self.paths.pop(name))


def _gram_lists(docs: DataFrame, window: int, gram: int) -> DataFrame:
    fields = [StructField("grams", ArrayType(LongType()))]

    def make():
        def run(texts: pa.Array) -> list:
            found = [text_anchors(t.encode(), window, gram)[3] for t in texts.to_pylist()]
            return [pa.array([as_long(x) for x in found], pa.list_(pa.int64()))]

        return run

    return map_text(docs, "text", fields, make, list(KEY)).where(F.size("grams") > 0)


def _candidates(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Text key, text and the ranges (anchor, nearest and farthest window start) of its repeated grams."""
    schema = StructType([
        StructField("t1", LongType()), StructField("t2", LongType()), StructField("text", StringType()),
        StructField("at", ArrayType(IntegerType())), StructField("near", ArrayType(IntegerType())),
        StructField("far", ArrayType(IntegerType())),
    ])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at, first, last, grams = text_anchors(row["text"].encode(), window, gram)
                some = np.isin(as_long(grams), np.array(row["grams"], np.int64))
                lists = [x[some].astype(np.int32) for x in (at, at - last, at - first)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]], t.type) for c, t in zip(("t1", "t2", "text"), to_arrow_schema(schema))]
                    + [pa.array([x], pa.list_(pa.int32())) for x in lists], schema=to_arrow_schema(schema))

    return map_batches(docs, run, schema)


def _hashed(texts: DataFrame, window: int, width: int) -> DataFrame:
    """Ranges of each text, split into blocks of ``width`` (0: as they are), with their hashes."""
    schema = StructType([
        StructField("t1", LongType()), StructField("t2", LongType()), StructField("at", IntegerType()),
        StructField("near", IntegerType()), StructField("far", IntegerType()), StructField("core", LongType()),
        StructField("h1", LongType()), StructField("h2", LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                at, near, far = (
                    row.column(c).values.to_numpy(zero_copy_only=False)[
                        row.column(c).offsets[0].as_py(): row.column(c).offsets[1].as_py()].astype(np.int64)
                    for c in ("at", "near", "far"))
                if width:
                    blocks = far // width - near // width + 1
                    which = np.repeat(np.arange(len(at)), blocks)
                    step = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    low = (near[which] // width + step) * width
                    at, near, far = at[which], np.maximum(low, near[which]), np.minimum(low + width - 1, far[which])
                if not len(at):
                    continue
                core, known, h1, h2 = range_hashes(
                    row.column("text")[0].as_py().encode(), at, near, far, window, width if width > 1 else 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), row.column("t1")[0].as_py(), np.int64)),
                    pa.array(np.full(len(at), row.column("t2")[0].as_py(), np.int64)),
                    *(pa.array(x.astype(np.int32)) for x in (at, near, far)),
                    pa.array(as_long(core), mask=~known), pa.array(as_long(h1)), pa.array(as_long(h2)),
                ], schema=arrow)

    return map_batches(texts, run, schema)


def _judge(hashed: DataFrame, shared: bool) -> DataFrame:
    """Ranges still of interest: ``done`` (repeated as a whole) and ``live`` (to be searched further)."""
    rows = hashed.withColumn("id", F.xxhash64("t1", "t2", "at", "near"))
    if shared:
        known = rows.where("core IS NOT NULL").join(splittable(repeated(rows.where("core IS NOT NULL"), ["core"]), "core").select("core"), "core", "left_semi")
        rows = known.unionByName(rows.where("core IS NULL"))
    equal = splittable(repeated(rows, ["h1", "h2"]), "h1", "h2")
    return rows.join(equal, ["h1", "h2"], "left").select(
        *KEY, "at", "near", "far", F.col("least").isNotNull().alias("done"),
        (F.col("least").isNull() | (F.col("least") == F.col("id"))).alias("live"))


def _by_text(ranges: DataFrame) -> DataFrame:
    """One row per text with the lists of its ranges (no more than the text has windows)."""
    listed = ranges.groupBy(*KEY).agg(F.collect_list(F.struct("at", "near", "far")).alias("r"))
    return listed.select(*KEY, *[F.col(f"r.{c}").alias(c) for c in ("at", "near", "far")])


def repeated_spans(
    docs: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM, widths: tuple[int, ...] = WIDTHS
) -> DataFrame:
    """Texts that lose bytes to windows that start elsewhere too: t1, t2, n_removed, n_spans, kept_sha256, kept_text.

    Equal texts count once here: what they share as copies is for the caller to see.
    """
    work = _Work(docs.sparkSession)
    t1, t2 = text_key(text)
    keyed = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), t1.alias("t1"), t2.alias("t2"))
    # copies of a text give one list
    grams = work.write(_gram_lists(keyed, window, gram).dropDuplicates(list(KEY)), "grams")
    each = grams.select(*KEY, F.posexplode("grams").alias("place", "gram"))
    common = repeated(each.select("gram", F.xxhash64("t1", "t2", "place").alias("id")), ["gram"]).select("gram")
    # a text that repeats a gram asks for it once
    asked = grams.select(*KEY, F.explode(F.array_distinct("grams")).alias("gram"))
    found = asked.join(splittable(common, "gram"), "gram", "left_semi")
    listed = found.groupBy(*KEY).agg(F.collect_list("gram").alias("grams"))
    # one row of each text: the one with the least key
    one = keyed.groupBy(*KEY).agg(F.min("key").alias("one"))
    wanted = work.write(listed.join(one, list(KEY)).select(*KEY, "one", "grams"), "wanted")
    work.drop("grams")
    same = (keyed["t1"] == wanted["t1"]) & (keyed["t2"] == wanted["t2"]) & keyed["key"].eqNullSafe(wanted["one"])
    chosen = keyed.join(wanted, same).select(keyed["t1"], keyed["t2"], "text", "grams").dropDuplicates(list(KEY))
    texts = work.write(_candidates(chosen, window, gram), "texts")
    work.drop("wanted")
    judged = work.write(_judge(_hashed(texts, window, 0), False), "judged-0")
    levels = [judged]
    for k, width in enumerate(widths, 1):
        live = _by_text(levels[-1].where("live"))
        hashed = work.write(_hashed(texts.select(*KEY, "text").join(live, list(KEY)), window, width), "hashed")
        levels.append(work.write(_judge(hashed, width > 1), f"judged-{k}"))
        work.drop("hashed")
    done = levels[0].where("done")
    for level in levels[1:]:
        done = done.unionByName(level.where("done"))
    spans = materialize(_cut(texts.select(*KEY, "text").join(_by_text(done), list(KEY)), window), "spans")
    work.drop(*work.paths)
    return spans


def _cut(texts: DataFrame, window: int) -> DataFrame:
    schema = StructType([
        StructField("t1", LongType()), StructField("t2", LongType()), StructField("n_removed", LongType()),
        StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept_text", StringType()),
        StructField("spans", ArrayType(LongType())),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = row["text"].encode()
                at, near, far = (np.array(row[c], np.int64) for c in ("at", "near", "far"))
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, at - far, 1)
                np.add.at(edge, at - near + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                sha = hashlib.sha256(kept).hexdigest()
                values = (row["t1"], row["t2"], int(gone.sum()), len(spans) // 2, sha, kept.decode("utf-8", "ignore"), spans)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

    return map_batches(texts, run, schema)


def _copies(docs: DataFrame, text: str) -> DataFrame:
    """The hashes of the texts that two or more rows have."""
    t1, t2 = text_key(text)
    return docs.select(t1.alias("__t1"), t2.alias("__t2")).groupBy("__t1", "__t2").count().where("count > 1")


def _with_facts(rows: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows with __t1 and __t2 beside what is known of their texts."""
    found = spans.withColumnRenamed("t1", "__t1").withColumnRenamed("t2", "__t2")
    facts = splittable(found.join(copies, ["__t1", "__t2"], "full"), "__t1", "__t2")
    return rows.join(facts, ["__t1", "__t2"], "left")


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
    widths: tuple[int, ...] = WIDTHS, with_text: bool = True, with_spans: bool = False,
) -> DataFrame:
    """Every document with n_bytes, n_removed, n_spans, kept_sha256, (``with_text``) kept_text and (``with_spans``) spans:
    where removed runs begin and end, in bytes, by turns.

    A byte goes when a string of ``window`` bytes that covers it also starts anywhere else, in the
    same or another document; overlaps count, and strings are judged on the input. Texts
    are UTF-8, NULL is empty; matches never cross documents. Documents with equal texts, also repeated rows, lose all
    when they have ``window`` bytes. Very long texts are hashed chunk by chunk, whole. kept_text leaves out bytes of characters that were cut in
    two; kept_sha256 is taken of the bytes. Columns of these names in the input are
    replaced; an empty frame gives an empty frame.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    t1, t2 = text_key(text)
    spans = repeated_spans(docs, key, text, window, gram, widths)
    names = [c for c in RESULT if (with_text or c != "kept_text") and (with_spans or c != "spans")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in without(docs, names).columns], t1.alias("__t1"), t2.alias("__t2"),
        F.octet_length(value).cast("long").alias("__n"), F.sha2(value, 256).alias("__sha"),
        *([value.alias("__whole")] if with_text else []))
    joined = _with_facts(rows, spans, _copies(docs, text))
    gone = F.col("count").isNotNull() & (F.col("__n") >= window)

    def pick(all_gone: Column, changed: str, same: Column) -> Column:
        return F.when(gone, all_gone).when(F.col("n_removed").isNotNull(), F.col(changed)).otherwise(same)

    columns = [
        F.col("__n").alias("n_bytes"), pick(F.col("__n"), "n_removed", F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), "n_spans", F.lit(0)).cast("long").alias("n_spans"),
        pick(F.sha2(F.lit(""), 256), "kept_sha256", F.col("__sha")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(pick(F.lit(""), "kept_text", F.col("__whole")).alias("kept_text"))
    if with_spans:
        columns.append(pick(F.array(F.lit(0), F.col("__n")).cast("array<bigint>"), "spans", F.array().cast("array<bigint>")).alias("spans"))
    return joined.select(*[F.col(f"`{c}`") for c in without(docs, names).columns], *columns)


#: Letters by which a word stands in a coded text: 36 bits of its hash.
CODE = 6
_LETTERS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", np.uint8)


def word_codes(texts: pa.Array) -> pa.Array:
    """Texts in which every word (between ASCII white space) is CODE letters and nothing stands between words."""
    words, row = words_of(texts)
    coded = words.dictionary_encode()
    listed = np.asarray(coded.dictionary.to_numpy(zero_copy_only=False), dtype=object)
    hashed = mix64(pd.util.hash_array(listed, categorize=False).astype(np.uint64)) if len(listed) else np.zeros(0, np.uint64)
    letters = _LETTERS[(hashed[:, None] >> (np.uint64(6) * np.arange(CODE, dtype=np.uint64)) & np.uint64(63)).astype(np.int64)]
    data = letters[coded.indices.to_numpy(zero_copy_only=False)].tobytes()
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]) * CODE
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def without_words(text: str, spans: list[int]) -> str:
    """The text without the words from spans[0] up to spans[1], spans[2] up to spans[3] ..., and what stands between those."""
    if not spans:
        return text
    words = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for lo, hi in zip(spans[::2], spans[1::2]):
        out.append(text[done: words[lo][0]])
        done = words[hi - 1][1]
    return "".join([*out, text[done:]])


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 51) -> DataFrame:
    """Every document with n_words_removed and kept_text: without each word that a passage of ``words`` words covers which also
    starts anywhere else, in the same or another document.

    The same search as ``remove_repeats`` on texts in which every word is CODE letters: the window is ``words`` words long,
    however short they are, and white space does not matter. NULL counts as empty; repeated rows lose all when they have
    so many words. Columns of these names in the input are replaced; an empty frame gives an empty frame.
    """
    kept = without(docs, ["n_words_removed", "kept_text"])
    # the row as one column: names of the byte search may occur in it
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("__row"), F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text"))

    def coded(keep: str) -> DataFrame:
        return map_text(source, "__text", [StructField("__coded", StringType())], lambda: lambda t: [word_codes(t)], [keep])

    window = words * CODE
    work = _Work(docs.sparkSession)
    # written, so that no task holds the Python worker that codes and the one that searches; and coded once for the search
    searched = work.write(coded("__id"), "coded")
    spans = repeated_spans(searched, "__id", "__coded", window, min(GRAM, max(CODE, window // 4))).select(*KEY, "spans")
    copies = materialize(_copies(searched, "__coded"), "copies")
    work.drop("coded")
    t1, t2 = text_key("__coded")
    rows = coded("__row").select("__row", t1.alias("__t1"), t2.alias("__t2"), F.octet_length("__coded").cast("long").alias("__n"))
    gone = F.col("count").isNotNull() & (F.col("__n") >= window)
    removed = F.when(gone, F.array(F.lit(0).cast("long"), F.col("__n"))).otherwise(F.coalesce("spans", F.array().cast("array<bigint>")))
    whole = F.coalesce(F.col(f"__row.`{text}`"), F.lit("")).alias("text")
    rows = _with_facts(rows, spans, copies).select("__row", whole, F.transform(removed, lambda x: (x / CODE).cast("int")).alias("spans"))
    schema = StructType([rows.schema["__row"], StructField("n_words_removed", LongType()), StructField("kept_text", StringType())])

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text"):
                spans = piece.column("spans").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    piece.column("__row"), pa.array([sum(s[1::2]) - sum(s[::2]) for s in spans], pa.int64()),
                    pa.array([without_words(t, s) for t, s in zip(piece.column("text").to_pylist(), spans)], pa.string())], schema.fieldNames())

    found = map_batches(rows, run, schema)
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in kept.columns], "n_words_removed", "kept_text")
