"""Each pipeline stage, and the rows of the whole run, against plain versions of what they must give."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import cotraining, repeats
from tallyframe.llm.queries import tokenizer_file

BLANK = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def plain_line_is_bad(line):
    """The line rules, one after the other."""
    words = len(words_of(line))
    if sum(c in "#*$%&<>~^=_+{}[]\\@" for c in line) * 4 > words or line.count("!") > max(2, words / 4):
        return True
    bars = sum(c in "|»›·•" for c in line)
    bars += sum(line[k] in "/>" and k > 0 and line[k - 1].isspace() and line[k + 1: k + 2].isspace() for k in range(len(line)))
    if bars >= 3 and words <= 4 * bars:
        return True
    if words < 4 and line.rstrip(BLANK)[-1:] not in tuple(".!?…:;,\"'”’»)]"):
        return True
    notices = ["all rights reserved", "accept cookies", "cookie policy", "click here to", "enable javascript", "privacy policy",
               "sign up for our newsletter", "subscribe to our", "terms of service", "terms of use", "lorem ipsum"]
    return any(n in line.lower() for n in notices)


def plain_rules(text):
    """The text without its bad lines, or None for a document that goes."""
    words = words_of(text)
    threes = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if threes[tuple(words[k: k + 3])] > 1 for j in range(3)}
    kept, seen, lost = [], set(), 0
    for line in (text or "").split("\n"):
        if not line.strip(BLANK):
            kept.append(line)
        elif line in seen or plain_line_is_bad(line):
            lost += len(words_of(line))
        else:
            kept.append(line)
        seen.add(line)
    if len(words) < 50 or 2 * len(covered) > len(words) or 2 * lost > len(words):
        return None
    return "\n".join(kept)


def plain_survivors(rows):
    """Least key of each group of documents whose five-word shingles agree by 0.8."""
    sets = {}
    for k, t in rows:
        w = words_of(t)
        sets[k] = frozenset(tuple(w[j: j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            x, y = sets[a], sets[b]
            if (len(x & y) >= 0.8 * len(x | y)) if x or y else True:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {find(k) for k in keys}


def plain_passages(rows, n):
    """Texts without the words that a passage of n words covers which starts twice or more."""
    words = {k: [(m.span(), m[0]) for m in WORD.finditer(t or "")] for k, t in rows}
    count = Counter(tuple(w for _, w in x[j: j + n]) for x in words.values() for j in range(len(x) - n + 1))
    out = {}
    for k, t in rows:
        x = words[k]
        gone = set()
        for j in range(len(x) - n + 1):
            if count[tuple(w for _, w in x[j: j + n])] > 1:
                gone |= set(range(j, j + n))
        text, done, at = [], 0, 0
        while at < len(x):
            if at in gone:
                end = at
                while end + 1 in gone:
                    end += 1
                text.append((t or "")[done: x[at][0][0]])
                done, at = x[end][0][1], end
            at += 1
        out[k] = ("".join([*text, (t or "")[done:]]), len(gone))
    return out


def plain_pieces(rows):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_file())
    out = Counter()
    for k, t in rows:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        for j in range(0, len(ids), 4096):
            part = np.array(ids[j: j + 4096], "<u4")
            out[k, j // 4096, j, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def given_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_quality_rules_as_by_hand(spark, sf_dir, given_docs, documents):
    for docs in (given_docs, documents):
        found = pairs(corpus_pipeline.quality_rules(spark, docs, sf_dir))
        assert Counter(found) == Counter((k, plain_rules(t)) for k, t in pairs(docs) if plain_rules(t) is not None)


def test_one_of_each_group_stays(spark, sf_dir, given_docs):
    found = pairs(corpus_pipeline.near_duplicates(spark, given_docs, sf_dir))
    rows = pairs(given_docs)
    assert sorted(k for k, _ in found) == sorted(plain_survivors(rows))
    assert set(found) <= set(rows)


@pytest.mark.parametrize("n", [5, 51])
def test_passages_are_counted_in_words(spark, n):
    words = "a bb ccc dddd e ff g".split()
    long = " ".join(words[k * k % 7] + str(k % 53) for k in range(120))
    short = "\n".join(chr(97 + k % 26) for k in range(51))  # 51 words in 101 bytes
    texts = [long, "x " + long[:300] + " y", f"one two\t{short}", f"three {short.replace(chr(10), '  ')} four five", None, "", " \t", "w " * 200,
             " ".join(f"u{k}" for k in range(300)), long, "ü é ß ö " * 3]
    rows = list(enumerate(texts)) + [(8, texts[8]), (None, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Kept_text", F.lit("x")).withColumn("spans", F.lit(1))
    found = [(r.doc_id, r.kept_text, r.n_words_removed) for r in repeats.remove_passages(docs, words=n).collect()]
    want = plain_passages(list(enumerate(t for _, t in rows)), n)
    assert Counter(found) == Counter((k, *want[j]) for j, (k, _) in enumerate(rows))
    assert repeats.remove_passages(docs.where("false")).count() == 0


def test_passages_of_very_long_texts(spark):
    base = [f"w{k * 7919 % 60_013}" for k in range(60_000)]
    rows = [(1, " ".join(base)), (2, "other " + " ".join(base[30_000: 30_051]) + " end")]
    found = {r.doc_id: r for r in repeats.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].n_words_removed, found[2].n_words_removed, found[2].kept_text) == (51, 51, "other  end")
    assert len(found[1].kept_text.split()) == 59_949


def test_passages_keep_one_python_worker_a_task(spark, monkeypatch):
    """What is written for the search has one Python step between exchanges."""
    plans, write = [], repeats.materialize

    def spy(df, name, path=None):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, path)

    monkeypatch.setattr(repeats, "materialize", spy)
    rows = [(k, " ".join(f"w{(k % 3) * 90 + j}" for j in range(80))) for k in range(6)]
    assert repeats.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("n_words_removed = 80").count() == 6
    assert len(plans) > 5
    for name, plan in plans:
        above = []  # depth of the Python steps that no exchange parts from the line
        for line in plan.split("\n"):
            depth = len(line) - len(line.lstrip(" :+-"))
            above = [d for d in above if d < depth]
            if "Exchange" in line:
                above = []
            if "MapInArrow" in line:
                assert not above, name
                above.append(depth)


def test_repeated_passages_stage(spark, sf_dir, given_docs):
    rows = pairs(given_docs)
    want = {k: t for k, (t, _) in plain_passages(rows, corpus_pipeline.PASSAGE_WORDS).items() if words_of(t)}
    found = corpus_pipeline.repeated_passages(spark, given_docs, sf_dir)
    assert found.columns == given_docs.columns and dict(pairs(found)) == want
    assert found.where("n_chars <> length(text)").count() == 0


def test_the_whole_run(spark, sf_dir, given_docs):
    """Verdicts of the classifier as they are, everything after it by the plain versions; packing by its own rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in cotraining.classify_keys(given_docs, labels).where("kept").collect()}
    assert not good & {r.doc_id for r in labels.where("quality = 0").collect()}
    rows = [(k, plain_rules(t)) for k, t in pairs(given_docs) if k in good]
    rows = [(k, t) for k, t in rows if t is not None]
    alive = plain_survivors(rows)
    cut = plain_passages([(k, t) for k, t in rows if k in alive], corpus_pipeline.PASSAGE_WORDS)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    want = plain_pieces([(k, t) for k, (t, _) in cut.items() if words_of(t)])
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    lengths = [k[3] for k in want.elements()]
    assert len(sequences) <= -(-sum(lengths) // 4096) + sum(n > 2048 for n in lengths)
