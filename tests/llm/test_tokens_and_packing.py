"""Token files, packing and pieces against the libraries and exhaustive search."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import packing, pieces, token_files
from tallyframe.llm.queries import packing_query, piece_encoding, token_output, tokenizer_file
from tallyframe.llm.word_tokens import WordEncoder
from tallyframe.session import work_dir

HARD = [
    "", " ", "It's don't WE'LL x'sy 'S ''s", "İstanbul ΣΑΣ ǅ ß", "é ́e à, x≠ ≮", "123 4a5 a.b,c.. ,.", "a b\u0085c",
    "日本語 かな", "😀👍🏽 a😀b", "Ünïcödé,, ªº µm", "a\x00b\x1c\x0bd", "don’t", "\ufeffx", "ﬁ Ⅳ ²", "a." * 50, "<|endoftext|> x",
]


def ids_of(path, texts):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return [e.ids + [1] for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_encoder_equals_the_library(name):
    path = tokenizer_file(name)
    ids, starts = WordEncoder(path).encode(pa.array(HARD))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == ids_of(path, HARD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab's,.!É é\u0301\n\u00a03ΣİŁ-–"), max_size=12), min_size=1, max_size=6))
def test_word_encoder_on_any_text(batch):
    path = tokenizer_file()
    global _ENCODER
    ids, starts = _ENCODER.encode(pa.array(batch, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == ids_of(path, batch)


_ENCODER = WordEncoder(tokenizer_file())


def test_token_files_hold_every_text_in_key_order(spark, documents, word_file):
    folder = work_dir(spark, "files")
    token_files.write_token_files(documents, folder, word_file)
    rows = documents.select("doc_id", "text").collect()
    want = Counter()
    keys = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start = 0
    for r, ids in zip(keys, ids_of(word_file, [r.text for r in keys])):
        want[(r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    found = token_files.read_documents(spark, folder).collect()
    assert Counter(map(tuple, found)) == want


def test_token_files_of_nothing(spark, no_documents, word_file):
    folder = work_dir(spark, "files")
    assert token_files.write_token_files(no_documents, folder, word_file)["parts"] == []
    assert token_files.read_documents(spark, folder).collect() == []


def checked(packed, capacity):
    """Sequences as dicts of offset to length; asserts that they are gapless and within capacity."""
    out = {}
    for r in packed.collect():
        out.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in out.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return out


def best_fit(lengths, capacity):
    """Sequences of best-fit decreasing, one piece after the other."""
    left = []
    for n in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(left) if room >= n]
        if fitting:
            left[min(fitting, key=lambda k: left[k])] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_documents_are_packed_whole(documents, word_file):
    clashing = documents.withColumn("offset", F.lit("x")).withColumn("Piece", F.lit("y"))
    packed = packing.pack_documents(clashing, word_file, capacity=64, keep=["doc_id", "offset", "Piece"])
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = documents.select("doc_id", "text").collect()
    want = Counter()
    for r, ids in zip(rows, ids_of(word_file, [r.text for r in rows])):
        for k in range(0, len(ids), 64):
            part = np.array(ids[k: k + 64], "<u4")
            want[(r.doc_id, k // 64, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == want
    lengths = [k[3] for k, n in want.items() for _ in range(n)]
    # no plan needs fewer than the tokens fill, nor than there are pieces over half; and it is as good as best fit piece by piece
    least = max(-(-sum(lengths) // 64), sum(n > 32 for n in lengths))
    assert least <= len(checked(packed, 64)) <= best_fit(lengths, 64)


def test_packed_ids_come_back(documents, word_file):
    packed = packing.pack_documents(documents, word_file, capacity=64, keep=["doc_id"], with_ids=True)
    found = {r.sequence_id: (bytes(r.ids), r.lengths) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert found[r.sequence_id][0][4 * r.offset: 4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_of_nothing(no_documents, word_file):
    assert packing.pack_documents(no_documents, word_file).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit_equals_best_fit_item_by_item(lengths):
    runs = packing.best_fit(Counter(lengths), 20)
    bins, room = {}, []
    for length, rank, first, offset, per in runs.tolist():
        later = [r[1] for r in runs.tolist() if r[0] == length and r[1] > rank]
        for k in range((min(later) if later else lengths.count(length)) - rank):
            bins.setdefault(first + k // per, []).append((offset + k % per * length, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 20
    for x in sorted(lengths, reverse=True):  # the plain algorithm
        fitting = [k for k, r in enumerate(room) if r >= x]
        if fitting:
            room[min(fitting, key=lambda k: room[k])] -= x
        else:
            room.append(20 - x)
    assert len(bins) == len(room)
    assert sum(len(p) for p in bins.values()) == len(lengths)


def test_strings_of_special_tokens_as_the_library_has_them(spark, tmp_path):
    texts = [*HARD, "a <|startoftext|>b<|endoftext|>", "<|ENDOFTEXT|> Ab", "", "plain words", "x<|endoftext|><|endoftext|>, y"]
    whole = Tokenizer.from_file(tokenizer_file())
    want = [e.ids + [1] for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert sum(49407 in x for x in want) == 3 and sum(49406 in x for x in want) == 1
    ids, starts = WordEncoder(tokenizer_file(), special_as_text=False).encode(pa.array(texts))
    assert [ids[lo:hi].tolist() for lo, hi in zip(starts, starts[1:])] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crcs = {k: zlib.crc32(np.array(x, "<u4").tobytes()) for k, x in enumerate(want)}
    assert {r.doc_id: r.ids_crc32 for r in packing_query(spark, str(tmp_path)).collect()} == crcs
    assert {r.doc_id: r.ids_crc32 for r in token_output(spark, str(tmp_path)).collect()} == crcs


def test_a_length_over_the_capacity_fails():
    with pytest.raises(ValueError):
        packing.best_fit({21: 1}, 20)


@pytest.fixture(scope="module")
def piece_model():
    return pieces.PieceModel(tokenizer_file("piece_bpe_32k.model"), 4)


def exhaustive(model, text, n):
    found = []

    def go(at, score):
        if at == len(text):
            found.append(score)
            return
        whole = [k for k in range(at + 1, len(text) + 1) if text[at:k] in model.id_of]
        for k in whole:
            go(k, score + model.id_of[text[at:k]][1])
        if at + 1 not in whole:
            go(at + 1, score + model.unknown * len(text[at].encode()))

    go(0, 0.0)
    return sorted(found, reverse=True)[:n]


def test_n_best_equals_exhaustive_search(piece_model):
    rng = random.Random(5)
    for _ in range(80):
        text = "".join(rng.choices("then ato,.é \n1", k=rng.randint(0, 9)))
        ids, scores, way = piece_model.encode(text)
        assert scores == pytest.approx(exhaustive(piece_model, "▁" + text.replace(" ", "▁"), 4))
        every = [tuple(x.tolist()) for x in way]
        assert every[0] == tuple(ids.tolist()) and len(set(every)) == len(every)
        assert all(piece_model.decode(x) == text for x in every)


def test_equal_scores_are_different_segmentations(piece_model):
    for text in ("%%%", "$$$", "a%%%", "%%%%", "x$$$y", "é%%%"):
        ids, scores, way = piece_model.encode(text)
        every = [tuple(x.tolist()) for x in way]
        assert every[0] == tuple(ids.tolist()) and len(set(every)) == len(every) == len(scores)
        assert scores == pytest.approx(exhaustive(piece_model, "▁" + text.replace(" ", "▁"), 4))


@pytest.mark.parametrize("shift", [0.0, 0.25])
def test_cuts_side_by_side_have_the_choices_of_one_search(shift):
    """Whole scores are searched by single numbers, others by sums."""
    model = pieces.PieceModel(tokenizer_file("piece_bpe_32k.model"), 4)
    model.id_of = {p: (k, s + shift * (k % 3)) for p, (k, s) in model.id_of.items()}
    model.begun |= model.id_of
    model._index_pieces()
    rng = random.Random(6)
    texts = ["".join(rng.choices("%$then atoé\x07", k=rng.randint(0, 12))) for _ in range(2000)]
    model.cuts_of_all(pa.array([*texts, "e" * 40, "%" * 40]))
    ties = 0
    for cut, k in model.place.items():
        want = model.n_best(cut.replace(" ", "▁"), 4)
        ties += len({score for score, _ in want}) < len(want)
        kept = [(model.score[k, c], tuple(model.ids_at(np.array([k]), [{0: c}])[0].tolist())) for c in range(len(want))]
        assert kept == want and not np.isfinite(model.score[k, len(want):]).any()
    assert ties > 20 or shift


def test_round_trip_sees_the_whole_text():
    class Disordered(pieces.PieceModel):
        def cuts_of_all(self, texts):
            at, starts = super().cuts_of_all(texts)
            return np.concatenate([at[lo:hi][::-1] for lo, hi in zip(starts, starts[1:])]), starts

    texts, path = pa.array(["one two", "", "x"]), tokenizer_file("piece_bpe_32k.model")
    *_, same, ids = pieces.encode_slice(pieces.PieceModel(path, 4), texts, True)
    assert same.to_pylist() == [True] * 3 and min(map(len, ids.to_pylist())) > 0
    assert pieces.encode_slice(Disordered(path, 4), texts, False)[-1].to_pylist() == [False, True, True]


def test_piece_query_returns_all_segmentations(spark, sf_dir):
    coded = piece_encoding(spark, sf_dir)
    best = coded.select("doc_id", F.explode("nbest_ids").alias("ids"), F.size("nbest_scores").alias("n"))
    back = pieces.decode_ids(best, tokenizer_file("piece_bpe_32k.model")).groupBy("doc_id", "text").agg(
        F.count("*").alias("found"), F.max("n").alias("n"))
    want = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert back.join(want, ["doc_id", "text"]).where("found = n").count() == want.count()


def test_texts_come_back_from_pieces(spark, documents, no_documents):
    path = tokenizer_file("piece_bpe_32k.model")
    coded = pieces.encode_texts(documents.withColumn("N_pieces", F.lit("x")), path)
    assert coded.where("NOT round_trip").count() == 0 and "N_pieces" not in coded.columns
    best = coded.select("doc_id", "text", F.col("nbest_ids")[0].alias("ids"))
    back = pieces.decode_ids(best.withColumnRenamed("text", "was"), path)
    assert back.where(~F.coalesce("was", F.lit("")).eqNullSafe(F.col("text"))).count() == 0
    assert coded.where(F.get("nbest_scores", F.lit(0)) < F.get("nbest_scores", F.lit(1))).count() == 0
    assert pieces.encode_texts(no_documents, path).count() == 0
