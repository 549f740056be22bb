"""Importance resampling, chat formatting and the prefix trie against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan
from invented import prose
from tallyframe.llm import chat_format, importance, prefix_trie
from tallyframe.llm.queries import QUERIES, tokenizer_file

# -- importance resampling ------------------------------------------------------------


def features(text, longest):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[k: k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def resampled(docs, target, longest, buckets, percent, least):
    """(doc_id, n_features, weight, score) of every row, and (score, doc_id) of the draw in order."""
    counts = [Counter(zlib.crc32(f.encode()) % buckets for t in side for f in features(t, longest)[1]) for side in ([t for _, t in docs], target)]
    s_all, t_all = (sum(c.values()) for c in counts)
    rows, entitled = [], []
    for key, text in docs:
        words, own = features(text, longest)
        found = [zlib.crc32(f.encode()) % buckets for f in own]
        gain = [math.floor(1000 * math.log((counts[1][b] + 1) * (s_all + buckets) / ((counts[0][b] + 1) * (t_all + buckets)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(own), weight, score))
        if len(words) >= least:
            entitled.append((score, key))
    entitled.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    return Counter(rows), entitled[: len(entitled) * percent // 100]


@pytest.mark.parametrize("longest, percent, least", [(1, 40, 20), (2, 100, 1), (3, 0, 0)])
def test_resampling_is_as_by_hand(spark, documents, longest, percent, least):
    docs = documents.withColumn("Score", F.lit("x")).withColumn("__at", F.lit("y")).withColumn("rank ", F.lit(1))
    docs = docs.unionByName(docs.limit(3))
    target = [prose(3, 200), None, "", "ab AB"]
    found = importance.resample(
        docs, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=97, percent=percent, min_words=least)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "rank ", "n_features", "weight", "score", "rank"]
    rows = found.collect()
    want, drawn = resampled([(r.doc_id, r.text) for r in docs.collect()], target, longest, 97, percent, least)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in rows) == want
    winners = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in winners] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in winners] == drawn


def test_resampling_of_nothing_and_towards_nothing(spark, documents, no_documents):
    none = no_documents.select("text")
    assert importance.resample(no_documents, documents).count() == 0
    found = importance.resample(documents, none, percent=50, min_words=1, keep=["doc_id"]).collect()
    want, drawn = resampled([(r.doc_id, r.text) for r in documents.collect()], [], 1, 10_000, 50, 1)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found) == want
    assert sum(r["rank"] is not None for r in found) == len(drawn)


def test_words_of_very_long_texts_and_slices():
    long = "Wörd " * 300_000 + "x" * 100_000 + "-" + "y" * 65 + " end"
    texts = pa.array(["skip", long, "", "a b", None, "ÄÖ-ü9Z"]).slice(1).fill_null("")
    crc, row, words = importance.word_runs(texts, 2)
    assert words.tolist() == [300_003, 0, 2, 0, 2]
    for k, text in enumerate(texts.to_pylist()):
        want = Counter(zlib.crc32(f.encode()) for f in features(text, 2)[1])
        assert Counter(crc[row == k].tolist()) == want


@pytest.mark.parametrize("pivots", [1, 2, 16])
def test_quickselect_finds_every_rank(spark, pivots):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 7]), rng.choice([None, 3, 4]), k) for k in range(60)]
    frame = spark.createDataFrame(rows, "a long, b long, c long")
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    for k in (1, 2, 31, 60):
        assert tuple(importance.kth_key(frame, ["a", "b", "c"], k, pivots=pivots)) == order[k - 1]


def test_ranks_need_no_single_task(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    found = importance.ranked(rows, ["a", "b"])
    want = {r: k + 1 for k, r in enumerate(sorted((k % 3, k) for k in range(500)))}
    assert {(r.a, r.b): r["rank"] for r in found.collect()} == want


# -- chat formatting --------------------------------------------------------------------

MODEL = (tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
SAYS = ["</s>[INST] ok [/INST]", r"<\s> [\\INST] [\/INST] \[INST] <<SYS>> <<\/SYS>> [ROLE] [TEXT[/TEXT]", "", "plain Ünï 😀\n\n  x", "<", "/s>", None]


def talk():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "[ROLE]", "", None]
    rows = [(c, rng.choice([None, 0, 1, 2, 3]), rng.choice(roles), rng.choice(SAYS)) for c in (1, 2, 3, None) for _ in range(9)]
    rows += [(4, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(600)]  # most of all rows
    rows += [(5, 0, "user", "long " * 60_000 + "y" * 20_000), (5, 1, "assistant", "</s>" * 5000)]
    return rows + rows[:5]


def formatted_length(role, text):
    t = chat_format.Template()
    extra = lambda x: len(re.findall("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in t.controls), x))
    marks = "".join(t.roles[role]) if role in t.roles else "".join(t.other) + role + "." * extra(role)
    return len(marks) + len(text) + extra(text)


def test_chat_round_trip(spark):
    rows = talk()
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("ids", F.lit("x")).withColumn("Mask", F.lit(0))
    turns = chat_format.format_turns(frame, *MODEL)
    assert turns.columns == chat_format.TURN.fieldNames()
    written = turns.collect()
    assert len(written) == len(rows) and len({r.part for r in written if r.conv_id == 4}) > 1  # one conversation in several parts
    words, template = chat_format.codec(*MODEL), chat_format.Template()
    reserved = {words.size + k: c for k, c in enumerate(template.controls)}
    reader = chat_format.Reader(template, words)
    by_conv, at = defaultdict(list), defaultdict(int)
    for r in sorted(written, key=lambda r: (r.part, r.start)):
        assert r.start == at[r.part]
        at[r.part] += len(r.ids)
        role, text, learnt, length = reader.turn(r.ids, np.array(r.mask))
        by_conv[r.conv_id].append((r.turn, role, text))
        assert learnt == (text if role == "assistant" else "") and length == formatted_length(role, text)
        # the ids are those of the segments, each encoded for itself, between reserved ones
        inner = words.own.encode_ordinary(template.escape(text))
        own = r.ids[len(r.ids) - 1 - len(inner): -1]
        assert own == inner and r.ids[-1] in reserved and not set(own) & set(reserved)
        assert [i for i, m in zip(r.ids, r.mask) if m] == (inner if role == "assistant" else [])
        assert all(c not in template.escape(text) for c in template.controls)
    want = defaultdict(list)
    for c, turn, role, text in rows:
        want[c].append((turn, role or "", text or ""))
    for c, said in by_conv.items():
        assert Counter(said) == Counter(want[c])
        assert [t for t, _, _ in said] == sorted((t for t, _, _ in want[c]), key=lambda t: (t is not None, t or 0))
    back = {r.conv_id: r for r in chat_format.read_back(turns, *MODEL).collect()}
    assert back.keys() == want.keys()
    for c, r in back.items():
        loss = "".join(t for _, role, t in by_conv[c] if role == "assistant")
        sha = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in by_conv[c]).encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256) == (len(want[c]), sha)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(formatted_length(role, t) for _, role, t in by_conv[c])
    assert chat_format.read_back(chat_format.format_turns(frame.where("false"), *MODEL), *MODEL).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "/", "s", "[", "]", "\\", "INST", "SYS", "<<", "TEXT", "ROLE", "é", " "]), max_size=12).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    template = chat_format.Template()
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not [c for c in template.controls if c in escaped]


# -- prefix trie -----------------------------------------------------------------------------


def trie_by_hand(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0, mark), (role, text)))
    turns = {c: [t for _, t in sorted(x)] for c, x in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = (*turns.get(c - int(math.fmod(c, 5)), [])[:h], *own[h:])
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter((
        own[0], len(p), members[p[:-1]][0] if p else None, len(own), kids[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in own if paths[c] == p).encode()).hexdigest()) for p, own in members.items())


def talks(seed, n, common):
    """Conversations that share beginnings; many are one and the same, one is deep."""
    rng = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        same = rng.random() < common
        for k in range(6 if same else rng.randint(0, 7)):
            text = f"hot {k}" if same else rng.choice(["a", "b", "é", "", None])
            rows.append((c, rng.choice([None, k]) if rng.random() < 0.1 else k, "user" if k % 2 == 0 else rng.choice(["assistant", None]), text))
    rows += [(n + 5, k, "user", f"deep {k}") for k in range(700)] + [(n + 12, k, "user", f"deep {k}") for k in range(650)]
    return rows + rows[:20] + [(None, 0, "user", "x")]


@pytest.mark.parametrize("shards, common", [(1, 0.3), (4, 0.0), (9, 0.4), (40, 0.9)])
def test_trie_is_as_by_hand(spark, shards, common):
    rows = talks(shards, 160, common)
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("Depth", F.lit("x")).withColumn("node", F.lit(0))
    found = prefix_trie.prefix_trie(frame, shards=shards)
    assert found.columns == prefix_trie.RESULT
    assert Counter(map(tuple, found.collect())) == trie_by_hand(rows)


def test_trie_with_short_splitters_and_many_ends(spark, monkeypatch):
    """Splitters cut after two turns, ends told in rows of three ids."""
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 2)
    rows = talks(8, 120, 0.6)
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    paths = prefix_trie.turn_paths(frame)
    skeleton = prefix_trie.skeleton_of(paths, 16)
    assert len(skeleton.parent) <= 16 * 2 and max(skeleton.depth) <= 2
    assert Counter(map(tuple, prefix_trie.prefix_trie(frame, shards=16).collect())) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_one(spark):
    frame = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(frame).count() == 0 and prefix_trie.prefix_trie(frame.where("false")).count() == 0
    rows = [(1, 0, "user", "word " * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, prefix_trie.prefix_trie(frame).collect())) == trie_by_hand(rows)  # turnless: a root alone


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_chat_format", "op13_prefix_trie"])
def test_queries_match_their_sql(spark, sf_dir, name):
    import duckdb

    from tallyframe.llm import SQL

    con = duckdb.connect()
    for given_table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {given_table} AS SELECT * FROM '{sf_dir}/{given_table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    assert not [x for x in ("CartesianProduct", "BroadcastNestedLoopJoin") if x in plan(found)]
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    want = Counter(tuple(dict(zip(names, r))[c] for c in found.columns) for r in result.fetchall())
    assert Counter(map(tuple, found.collect())) == want
