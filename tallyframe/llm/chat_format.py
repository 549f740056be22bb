"""Conversations as token ids with a loss mask, assembled from separately encoded segments.

A template gives each role the control strings around its text. Control strings are single reserved ids beyond
the vocabulary; they are never produced by encoding text. Roles and texts are encoded apart, each for
itself, and the reserved ids are spliced between them at places that prefix sums of the lengths give; the mask is
the prefix sum of +1 where a learnt text begins and -1 where it ends. Control strings inside a text are escaped
before, so the written form can be read back too.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .common import map_batches, text_slices


@dataclass(frozen=True)
class Template:
    """What stands before and after a role's text. ``other`` marks any other role: before its name, after it, after the text.

    A control string begins with one character, such as ``<`` or ``[``, that none has further on; one role may have an
    empty first string.
    """

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>"), "system": ("<<SYS>>", "<</SYS>>")})
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    learnt: tuple[str, ...] = ("assistant",)
    #: control strings of the model that the template does not use; escaped in texts as well
    further: tuple[str, ...] = ("<s>",)

    @cached_property
    def controls(self) -> list[str]:
        return list(dict.fromkeys(c for c in (*(s for pair in self.roles.values() for s in pair), *self.other, *self.further) if c))

    @cached_property
    def _within(self) -> re.Pattern:
        return re.compile("|".join(f"(?:{re.escape(c[0])}\\\\*{re.escape(c[1:])})" for c in sorted(self.controls, key=len, reverse=True)))

    def escape(self, text: str) -> str:
        """A backslash after the first character of each control string, one more where some are there."""
        return self._within.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self._within.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


class Codec:
    """A byte-level vocabulary of ranks: every text decodes to itself. Reserved ids follow the vocabulary."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.own = tiktoken.Encoding("turns", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.spelt = [b""] * self.size
        for word, rank in ranks.items():
            self.spelt[rank] = word

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        found = [self.own.encode_ordinary(t) for t in texts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int32, int(size.sum())), size

    def decode(self, ids: list[int]) -> str:
        spelt = self.spelt
        return b"".join([spelt[i] for i in ids]).decode("utf-8", "replace")


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of every run of the given size."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def assemble(roles: list[str], texts: list[str], template: Template, words: Codec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and mask of all turns in a row, and where each turn begins (one more than turns)."""
    reserved = {c: words.size + k for k, c in enumerate(template.controls)}
    kinds = list(template.roles)
    kind = np.array([kinds.index(r) if r in template.roles else len(kinds) for r in roles], np.int64)
    marks = np.array([[reserved.get(a, -1), -1, reserved[b]] for a, b in template.roles.values()] + [[reserved[c] for c in template.other]])
    before, middle, after = marks[kind].T
    named = np.flatnonzero(kind == len(kinds))
    name_ids, name_sizes = words.encode([template.escape(roles[k]) for k in named])
    name = np.zeros(len(roles), np.int64)
    name[named] = name_sizes
    text_ids, text = words.encode([template.escape(t) for t in texts])
    # places by prefix sums: mark, name, mark, text, mark
    name_at = (before >= 0).astype(np.int64)
    text_at = name_at + name + (middle >= 0)
    bounds = np.concatenate([[0], np.cumsum(text_at + text + 1)])
    start = bounds[:-1]
    ids = np.empty(bounds[-1], np.int32)
    ids[start[before >= 0]] = before[before >= 0]
    ids[(start + text_at - 1)[middle >= 0]] = middle[middle >= 0]
    ids[start + text_at + text] = after
    ids[_spread((start + name_at)[named], name_sizes)] = name_ids
    ids[_spread(start + text_at, text)] = text_ids
    learnt = np.isin(kind, [kinds.index(r) for r in template.learnt])
    edges = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(edges, (start + text_at)[learnt], 1)
    np.add.at(edges, (start + text_at + text)[learnt], -1)
    return ids, np.cumsum(edges)[:-1] > 0, bounds


TURN = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("part", IntegerType()), StructField("start", LongType()),
    StructField("ids", ArrayType(IntegerType())), StructField("mask", ArrayType(BooleanType()))])


def format_turns(
    conversations: DataFrame, vocabulary: str, pattern: str, template: Template | None = None, parts: int | None = None,
) -> DataFrame:
    """Every turn with its ids and loss mask, and its place: ``part`` and ``start``, the ids before it in the part.

    Parts are ranges of (conv_id, turn, role, hash of the text): in the order of part and start, a conversation's
    turns follow each other, and so do their ids. NULL conv_ids and turns come first, NULL roles and texts are empty,
    repeated rows are repeated turns. Roles the template does not know are written out. Other columns are not read. An empty
    frame gives an empty frame.

    Spark splits ranges within a conversation, so one that holds a third of all turns is many parts.
    A task encodes a few MB of text at a time; a very long text is a slice of its own.
    """
    spark = conversations.sparkSession
    template = template or Template()
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "tie", "spread"]
    ranges = (
        rows.withColumns({"tie": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
        .repartitionByRange(n, *order).sortWithinPartitions(*order).select(*rows.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        words = codec(vocabulary, pattern)
        for batch in batches:
            for piece in text_slices(batch, "text"):
                ids, mask, bounds = assemble(piece.column("role").to_pylist(), piece.column("text").to_pylist(), template, words)
                at = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    piece.column("conv_id"), piece.column("turn"), pa.array(np.full(len(piece), part, np.int32)), pa.array(bounds[:-1] + done),
                    pa.ListArray.from_arrays(at, pa.array(ids)), pa.ListArray.from_arrays(at, pa.array(mask))], TURN.fieldNames())
                done += int(bounds[-1])

    return map_batches(ranges, run, TURN)


class Reader:
    """Turns from ids and mask again: role, text, the part under the mask, the length of the written form."""

    def __init__(self, template: Template, words: Codec):
        self.template, self.words = template, words
        self.control = {words.size + k: c for k, c in enumerate(template.controls)}
        self.first = {a: r for r, (a, _) in template.roles.items() if a}
        self.bare = next((r for r, (a, _) in template.roles.items() if not a), None)

    def _text(self, ids: list[int]) -> tuple[str, int]:
        written = self.words.decode(ids)
        return self.template.unescape(written), len(written)

    def turn(self, ids: list[int], mask: np.ndarray) -> tuple[str, str, str, int]:
        """Role, text, learnt text and written length of one turn's ids."""
        marks = [k for k, i in enumerate(ids) if i >= self.words.size]
        shown = [self.control[ids[k]] for k in marks]
        role_length, begin = 0, 0
        if shown[0] == self.template.other[0]:
            role, role_length = self._text(ids[1: marks[1]])
            begin = marks[1] + 1
        elif shown[0] in self.first:
            role, begin = self.first[shown[0]], 1
        else:
            role = self.bare
        text, length = self._text(ids[begin: marks[-1]])
        under = np.flatnonzero(mask)
        learnt = self._text([ids[k] for k in under if ids[k] < self.words.size])[0] if len(under) else ""
        return role, text, learnt, length + role_length + sum(map(len, shown))


_DIGEST = StructType([
    StructField("conv_id", LongType()), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
    StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())])


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.length = conv_id, 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, learnt: str, length: int) -> None:
        self.turns += 1
        self.turns_sha.update(f"{role}\n{text}\n".encode())
        self.loss += len(learnt)
        self.loss_sha.update(learnt.encode())
        self.length += length

    def row(self) -> dict:
        return dict(zip(_DIGEST.fieldNames(), (
            self.conv_id, self.turns, self.turns_sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.length)))


def read_back(turns: DataFrame, vocabulary: str, pattern: str, template: Template | None = None) -> DataFrame:
    """One row per conversation, read from ids and masks: number and digest of its turns, learnt and written text.

    A digest runs over a conversation's turns in order, one turn at a time; the turns of one conversation pass one
    task, a conversation is never held. An empty frame gives an empty frame.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now = Reader(template, codec(vocabulary, pattern)), None
        for batch in batches:
            done = []
            masks = batch.column("mask")
            for k, (conv, ids) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist())):
                if now is None or now.conv_id != conv:
                    done += [now.row()] if now else []
                    now = _Conversation(conv)
                now.add(*reader.turn(ids, masks[k].values.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_pylist(done, _arrow(_DIGEST))
        if now:
            yield pa.RecordBatch.from_pylist([now.row()], _arrow(_DIGEST))

    together = turns.select("conv_id", "ids", "mask", "part", "start").repartition("conv_id").sortWithinPartitions("conv_id", "part", "start")
    return map_batches(together, run, _DIGEST)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
