"""Line rules, digests, repeated windows, similarity join and classifier against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from invented import prose
from tallyframe.llm import cotraining, digest, graph, jaccard, line_rules, repeats
from tallyframe.llm.common import text_slices
from tallyframe.llm.repeats_kernel import Hashes, anchors, sliding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_base_counts(documents, no_documents):
    clashing = documents.withColumn("Kept", F.lit("x"))
    found = line_rules.clean_lines(clashing)
    assert "Kept" not in found.columns
    for r in found.collect():
        text = r.text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        inside = {k + i for k in range(len(words) - 2) for i in range(3) if windows[tuple(words[k:k + 3])] > 1}
        lines, seen = 0, set()
        for line in text.split("\n"):
            lines += bool(WORD.search(line)) and line in seen
            seen.add(line)
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside), failed)
        assert not (r.kept and failed)
    assert line_rules.clean_lines(no_documents).count() == 0


@pytest.mark.parametrize("line, fault", [
    ("Home | About | News | Contact", "navigation"), ("### the&&& of*** in%%%", "symbols"), ("READ!! MORE!! NOW!!", "exclamations"),
    ("Contact us", "fragment"), ("We use it. See our cookie policy for more of this.", "notice"),
    ("This is a plain sentence, and it ends here.", None), ("A heading of four words", None), ("Why so!", None),
])
def test_line_faults(line, fault):
    assert line_rules.line_fault(line, len(WORD.findall(line)), line_rules.LineRules()) == fault


def test_lost_text_rejects(spark):
    menu = "\n".join("Home | About | News | Contact | Help | Imprint | Jobs" for _ in range(1)) + "\n"
    good = prose(1, 80)
    bars = "\n".join(f"w{k} | x{k} | y{k} | z{k} | v{k} | u{k}" for k in range(30))
    rows = spark.createDataFrame([(1, menu + good), (2, bars + "\n" + good)], "doc_id int, text string")
    found = {r.doc_id: r for r in line_rules.clean_lines(rows).collect()}
    assert found[1].kept and found[1].clean_text == good and found[1].n_failed_lines == 1
    assert not found[2].kept and not found[2].base_failed


def test_digest_against_next(documents, no_documents):
    found = Counter(map(tuple, digest.compare_with_next(documents).collect()))
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    # rows of one key are the same row twice here, so their order does not matter
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    want = Counter()
    for k, (key, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other = digest.fingerprint(text), digest.fingerprint(changed)
        want[(key, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other, digest.likeness(own, other),
              digest.likeness(own, digest.fingerprint(after)))] += 1
    assert found == want
    assert digest.compare_with_next(no_documents).count() == 0
    assert digest.add_fingerprint(documents.withColumn("Fingerprint", F.lit(1))).columns[-1] == "fingerprint"


def test_a_single_document_follows_itself(documents):
    row = digest.compare_with_next(documents.where("doc_id = 0")).first()
    assert row.near_next == 1.0 and 0 <= row.near_edited <= 1


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=200), st.binary(max_size=200))
def test_likeness_is_bounded_and_symmetric(a, b):
    x, y = (digest.fingerprint(v.decode("latin-1")) for v in (a, b))
    assert 0 <= digest.likeness(x, y) == digest.likeness(y, x) <= 1 and digest.likeness(x, x) == 1


def test_chunked_counts_are_whole_counts(monkeypatch):
    data = prose(3, 500).encode()
    whole = digest.bucket_counts(data)
    monkeypatch.setattr(digest, "CHUNK", 97)
    assert (digest.bucket_counts(data) == whole).all()


def plain_repeats(texts, window):
    count = Counter(t[k: k + window] for t in texts for k in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if count[t[k: k + window]] > 1:
                gone[k: k + window] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_windows(documents, no_documents):
    rows = documents.select("doc_id", "text").collect()
    want = Counter(zip([r.doc_id for r in rows], plain_repeats([(r.text or "").encode() for r in rows], 400)))
    found = repeats.remove_repeats(documents.withColumn("N_bytes", F.lit("x")))
    assert "N_bytes" not in found.columns
    got = Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in found.collect())
    assert got == want
    assert sum(n > 0 for (_, (_, n, _, _)) in want) > 5
    assert repeats.remove_repeats(no_documents).count() == 0


def test_repeated_windows_in_low_entropy(spark, monkeypatch):
    """Short windows over few letters: every pass and every border is met."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab"), int(n))) for n in rng.integers(0, 160, 30)]
    texts += ["ab" * 60, "a" * 90, texts[3] + "x" + texts[5], texts[7][10:60] + "é" + texts[7][:50]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeats.remove_repeats(rows, window=24, gram=9, widths=(8, 2, 1))
    want = dict(enumerate(plain_repeats([t.encode() for t in texts], 24)))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()} == want


def test_windows_belong_to_their_leftmost_least_gram():
    data = b"abracadabra abracadabra abracad"
    hashes = Hashes(data)
    h = hashes.of(np.arange(len(data) - 3 + 1), 3) >> np.uint64(32)
    at, first, last = anchors(hashes, 12, 3)
    owner = [k + int(np.argmin(h[k: k + 10])) for k in range(len(data) - 12 + 1)]
    assert [a for a, f, e in zip(at, first, last) for _ in range(f, e + 1)] == owner
    assert sliding(np.minimum, np.array([3, 1, 2, 5, 0]), 3).tolist() == [1, 1, 0]


def sets_of(texts):
    out = []
    for t in texts:
        w = WORD.findall(t or "")
        out.append(frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def plain_join(keys, texts, t=0.8):
    sets, n = sets_of(texts), len(texts)
    links, label = defaultdict(set), list(range(n))
    for a in range(n):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= t * union > 0:
                links[a].add(b)
                links[b].add(a)
    changed = True
    while changed:
        changed = False
        for a in range(n):
            low = min([label[a], *(label[b] for b in links[a])])
            changed |= low != label[a]
            label[a] = low
    least = {}
    for k, root in zip(keys, label):
        least[root] = min((x for x in (least.get(root), k) if x is not None), default=None)
    return Counter((k, least[label[a]], len(links[a])) for a, k in enumerate(keys))


def test_similarity_join(documents, no_documents):
    rows = documents.select("doc_id", "text").collect()
    found = jaccard.join_similar(documents)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in found.collect())
    assert got == plain_join([r.doc_id for r in rows], [r.text for r in rows])
    assert jaccard.join_similar(no_documents).count() == 0


def test_similarity_join_in_blocks(spark, monkeypatch):
    """Near copies in many small blocks, with similarities around the threshold."""
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rng = np.random.default_rng(4)
    base = prose(5, 120).split()
    texts = []
    for k in range(40):
        words = list(base)
        for place in rng.choice(len(words), int(rng.integers(0, 4)), replace=False):
            words[place] = f"new{k}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard.join_similar(rows).collect())
    assert got == plain_join(list(range(40)), texts)


def test_one_document_of_each_class_stays(documents):
    kept = jaccard.keep_one(documents)
    assert kept.columns == documents.columns
    classes = {r.class_id for r in jaccard.join_similar(documents).collect()}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(classes)


def test_pruning_keeps_what_may_reach_the_threshold():
    for n in (16, 64, 128):
        floor = jaccard.least_matches(n, 0.8, 1e-6)
        assert 0 < floor < 0.8 * n
        p = [sum(jaccard.comb(n, j) * 0.8**j * 0.2 ** (n - j) for j in range(floor))]
        assert p[0] < 1e-5  # a pair at the threshold is hardly ever dropped


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(30)]
    star = [(100, k) for k in range(101, 140)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (200, 201), (201, 200)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert graph.components(edges.where("false")).count() == 0


def test_components_of_many_shapes(spark):
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 400, (330, 2)).tolist() + [[1000, k] for k in range(900, 1000)]
    root = {k: k for p in pairs for k in p if p[0] != p[1]}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = graph.components(spark.createDataFrame(pairs + pairs[:9], "a long, b long")).collect()
    assert len(found) == len(root) and {r.node: r.root for r in found} == {k: find(k) for k in root}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written, write = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name, path: written.append(name) or write(df, name, path))
    stars = [(0, k) for k in range(1, 9)] + [(20, 30), (31, 20)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(9)}, **{k: 20 for k in (20, 30, 31)}}
    assert len(written) == 1


def test_classifier_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # enough labels to learn from a half of them
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.where("doc_id % 2 = 0")
    found = cotraining.classify(docs, known).join(labels.where("doc_id % 2 = 1"), "doc_id")
    wrong = found.where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 0.05 * found.count()


def test_text_measures(texts):
    """The vector form against one text at a time."""
    values = [t or "" for t in texts]
    found = cotraining.text_measures(pa.array(values, pa.string()))
    got = {name: column.to_numpy() for name, column in zip(cotraining.TEXT, found)}
    for k, t in enumerate(values):
        size, words = max(len(t), 1), WORD.findall(t.lower())
        assert got["bars"][k] == pytest.approx((t.count("|") / size) ** 0.5)
        assert got["stops"][k] == pytest.approx(sum(c in ".,;:?" for c in t) / size)
        assert got["capitals"][k] == pytest.approx(sum(c.isupper() and ord(c) < 256 for c in t) / size)
        assert got["distinct"][k] == pytest.approx(len(set(words)) / max(len(words), 1))
        assert got["line_length"][k] == pytest.approx(np.log1p(len(words) / (t.count("\n") + 1)))


def thue_morse(n):
    return bytes(97 + bin(k).count("1") % 2 for k in range(n))


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_regular_strings_have_different_hashes(n):
    """Strings of two letters that a polynomial modulo a power of two cannot tell apart."""
    from tallyframe.llm.repeats_kernel import Hashes

    one = thue_morse(n)
    other = bytes(97 + 98 - b for b in one)
    both = Hashes(one + other + one)
    first, second, again = (both.of(np.array([at]), n, which=1)[0] for at in (0, n, 2 * n))
    assert first == again != second


def test_regular_windows_that_differ_stay(spark):
    one = thue_morse(1024).decode()
    other = one.translate({97: 98, 98: 97})
    rows = [(1, "x" + one + "y"), (2, "p" + other + "q"), (3, "r" + one + "s")]
    found = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=1024).collect()}
    assert found == {1: 1024, 2: 0, 3: 1024}


def plain_links(rows, width=5, threshold=0.8):
    """Links of every document by comparing all pairs of shingle sets."""
    sets = []
    for _, t in rows:
        words = (t or "").split()
        sets.append({tuple(words[k: k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    out = []
    for k, a in enumerate(sets):
        others = [b for j, b in enumerate(sets) if j != k]
        out.append(sum((len(a & b) >= threshold * len(a | b)) if a or b else True for b in others))
    return out


def test_sets_in_ranges_give_the_same_links(spark, monkeypatch):
    """Rows of a few KB: every cluster's sets are cut into ranges; blocks of few nodes."""
    monkeypatch.setattr(jaccard, "ROW_BYTES", 4096)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = prose(1, 900).split()
    texts = [" ".join([*base[:k * 7], f"w{k}", *base[k * 7:]]) for k in range(14)] + [" ".join(base[: 900 - 60 * k]) for k in range(6)]
    rows = [(k, t) for k, t in enumerate([*texts, texts[0], prose(2, 300), None, "", "one two", "one two"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in jaccard.join_similar(docs).collect()}
    assert [found[k].n_links for k, _ in rows] == plain_links(rows)


def test_long_near_copies_keep_rows_bounded(spark, monkeypatch):
    """Forty near copies of 200,000 words: no row of work is larger than its bound allows."""
    monkeypatch.setattr(jaccard, "ROW_BYTES", 4 << 20)
    largest = []
    sets = jaccard.blocked

    def watched(*args, **more):
        out = sets(*args, **more)
        if "grams" in args[4]:
            whole = F.aggregate("m", F.lit(0).cast("long"), lambda n, m: n + F.octet_length(m["grams"]))
            largest.append(out.agg(F.max(whole), F.max("part")).first())
        return out

    monkeypatch.setattr(jaccard, "blocked", watched)
    base = [f"w{k * 7919 % 200_003}" for k in range(200_000)]
    rows = [(k, " ".join([*base[: k * 100], f"new{k}", *base[k * 100:]])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = jaccard.join_similar(docs).collect()
    assert all((r.class_id, r.class_size, r.n_text_links) == (0, 40, 39) for r in found) and len(found) == 40
    (bytes_, parts), = largest
    assert parts > 10 and bytes_ < 1.1 * (4 << 20)


def test_views_exchange_labels(spark):
    """Only the metadata tells some good rows apart; the text view learns from what it names."""
    good, bad = prose(1, 80), "### a&&& ***%%% " * 20
    rows = [(k, good if k % 2 else bad, "en", "wiki" if k % 2 else "farm", 100) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = cotraining.fit(cotraining.featurize(docs, labels), rounds=2, sure=0.6)
    assert all(sum(map(sum, given)) > 0 for given in model.pseudo_labels.values())  # each view was given rows by the other
    found = cotraining.score(docs, model).collect()
    assert all(r.kept == bool(r.doc_id % 2) for r in found)


@pytest.mark.parametrize("partitions, adaptive, broadcast", [(1, "true", "10485760"), (8, "true", "-1"), (200, "false", "-1")])
def test_classifier_does_not_depend_on_partitions(spark, sf_dir, partitions, adaptive, broadcast):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    want = {r.doc_id: r for r in cotraining.classify_keys(docs, labels).collect()}
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": adaptive,
                "spark.sql.autoBroadcastJoinThreshold": broadcast}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = cotraining.classify_keys(docs.repartition(partitions), labels.repartition(3)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == len(want)
    for r in found:
        assert r.kept == want[r.doc_id].kept and r.score == pytest.approx(want[r.doc_id].score, abs=1e-9)


def test_sums_of_sure_rows_are_as_by_hand(spark, sf_dir):
    """Gradient and curvature of all sure rows, one row at a time; copies of a row count once."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    features = cotraining.featurize(docs.unionByName(docs.withColumn("doc_id", -F.col("doc_id") - 1)), labels)
    views = cotraining.views_of(("lang", "source"), ("n_chars",))
    names = [n for v in views.values() for n in v.names]
    known = features.where("__label IS NOT NULL").toPandas()
    target, fold = known["__label"].to_numpy(float), np.arange(len(known)) % 5
    fits = {v: cotraining._Fit(view, known, target, fold) for v, view in views.items()}
    givers, shares = {v: f.raw() for v, f in fits.items()}, {"text": np.array([0.5, 1.0]), "meta": np.array([1.0, 0.25])}
    pool = features.where("__label IS NULL").select(*names).distinct()
    found = cotraining.sure_sums(pool, fits, givers, shares, 0.8)
    counted = set()
    want = {v: [np.zeros(2), np.zeros(len(f.w)), np.zeros((len(f.w), len(f.w)))] for v, f in fits.items()}
    for row in features.where("__label IS NULL").select(*names).collect():
        if tuple(row) in counted:
            continue
        counted.add(tuple(row))
        for v, other in (("text", "meta"), ("meta", "text")):
            x, y = (views[k].matrix([np.array([row[n]]) for n in views[k].names]) for k in (v, other))
            p = 1 / (1 + np.exp(-(y @ givers[other][0] + givers[other][1])))[0]
            if 0.2 < p < 0.8:
                continue
            good = int(p >= 0.8)
            own = np.append((x[0] - fits[v].mean) / fits[v].spread, 1.0)
            q = 1 / (1 + np.exp(-np.clip(own @ fits[v].w, -30, 30)))
            want[v][0][good] += 1
            want[v][1] += shares[v][good] * (good - q) * own
            want[v][2] += shares[v][good] * max(q * (1 - q), 1e-6) * np.outer(own, own)
    for v in fits:
        for a, b in zip(found[v], want[v]):
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)
    assert sum(want["meta"][0]) > 0


def test_classifier_takes_very_long_and_clashing_rows(spark):
    long = "### a&&& ***%%% " * 40_000
    rows = [(k, long if k == 7 else (prose(k, 60) if k % 2 else "### a&&& *** " * 9), "en", "s", 9) for k in range(60)] * 2 + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {"__label": F.lit("x"), "__words": F.lit(1), "Kept": F.lit(2)})
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    for found in (cotraining.classify(docs, labels), cotraining.classify_keys(docs, labels)):
        assert found.count() == len(rows) and found.where("score IS NULL OR isnan(score)").count() == 0
        pairs = found.groupBy("doc_id").agg(F.countDistinct("score").alias("n")).where("n > 1")
        assert pairs.count() == 0  # repeated rows score alike


def test_classifier_without_labels_keeps_all(documents, no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = cotraining.classify(documents.withColumn("Score", F.lit("x")), none)
    assert found.count() == documents.count() and found.where("NOT kept OR score <> 1").count() == 0
    one = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    assert cotraining.classify(no_documents, one).count() == 0
    assert cotraining.classify(documents, one).where("score IS NULL OR isnan(score)").count() == 0


def test_kernels_take_a_megabyte_at_once():
    """A worker keeps what its largest slice took: four megabytes put an executor over its memory."""
    texts = ["x" * 50_000] * 100 + ["y" * 3_000_000] + [None] + ["z"] * 5
    slices = list(text_slices(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text"))
    assert [t for s in slices for t in s.column("text").to_pylist()] == texts
    assert all(sum(len(t or "") for t in s.column("text").to_pylist()) <= (1 << 20) + 50_000 or s.column("text")[0].as_py()[0] == "y" for s in slices)
