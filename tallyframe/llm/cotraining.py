"""Quality classifier by co-training: a text view and a metadata view teach each other.

Both views are logistic models over a few columns of a row: measures of its text, taken from Arrow slices,
and its metadata. They start from a bounded sample of labelled rows. In each round every view
labels all unlabelled rows that it is sure of, and the other view is fitted anew on the labelled rows and on these: they
enter through sums of gradients and curvatures that Spark takes over the whole table. Sureness is measured
after calibration on labelled rows that the calibrated fit has not seen (cross-fitting). At the end the calibrated
views are combined by a third logistic model, and all documents are scored by plain expressions.

Nothing depends on how the rows lie: samples and folds come from hashes of the keys, and there are no row numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..session import materialize
from .common import codes_of, map_batches, map_text, without, words_of

#: Labelled rows used at most (those with the least hashes of their key).
MAX_LABELLED = 20_000
#: Rounds at most; they end earlier when both views name as many rows as the round before.
ROUNDS = 3
#: Newton steps of a round: passes over the sure rows.
STEPS = 3
#: Folds of the labelled rows, by a hash of their key.
FOLDS = 5
SURE = 0.97
#: Weights that a category's values share, by hash.
BUCKETS = 64
#: Rows whose matrices a task builds at once.
SLICE_ROWS = 1024
RESULT = ("p_text", "p_meta", "score", "kept")

#: Classes of ASCII bytes that a text is measured by.
CLASSES = {
    "symbols": b"#*$%&<>~^=_+{}[]\\@", "bars": b"|", "bangs": b"!", "digits": b"0123456789", "stops": b".,;:?",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
TEXT = ("symbols", "bars", "bangs", "digits", "stops", "capitals", "variety", "distinct", "word_length", "words", "line_length")
TEXT_FIELDS = [StructField(f"__{name}", DoubleType()) for name in TEXT]


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(chars)] = 1
    return out


_TABLES = {name: _table(chars) for name, chars in CLASSES.items()}
_LINES = _table(b"\n")


def text_measures(texts: pa.Array) -> list[pa.Array]:
    """The text view: shares of marks, capitals (A-Z and Latin-1) and digits, repetition, lengths of words and lines."""
    n = len(texts)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(t.encode() for t in texts.to_pylist()), np.uint8)
    starts = np.cumsum(size) - size
    full = np.flatnonzero(size)

    def per_text(marks: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if len(full):
            out[full] = np.add.reduceat(marks, starts[full])
        return out

    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    share = {name: per_text(table[data]) / chars for name, table in _TABLES.items()}
    if len(data) > 1:  # capitals of Latin-1 are C3 80 to C3 9E, but for the multiplication sign
        second = np.zeros(len(data), np.int32)
        second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        share["capitals"] = share["capitals"] + per_text(second) / chars
    words, row = words_of(pc.utf8_lower(texts))
    code = codes_of(words)
    n_words = np.bincount(row, minlength=n).astype(float)
    base = int(code.max(initial=0)) + 1
    different = np.bincount(np.unique(row * base + code) // base, minlength=n).astype(float)
    lines = per_text(_LINES[data]) + 1
    some = np.maximum(n_words, 1)
    values = {
        **{name: np.sqrt(share[name]) for name in ("symbols", "bars", "bangs", "digits")}, "stops": share["stops"],
        "capitals": share["capitals"], "variety": np.log1p(different) / np.log1p(some), "distinct": different / some,
        "word_length": np.log1p(chars / some), "words": np.log1p(n_words), "line_length": np.log1p(n_words / lines),
    }
    return [pa.array(values[name]) for name in TEXT]


def with_text_features(docs: DataFrame, text: str, keep: Sequence[str] | None = None) -> DataFrame:
    return map_text(docs, text, TEXT_FIELDS, lambda: text_measures, keep)


def meta_features(categories: Sequence[str], numbers: Sequence[str]) -> dict[str, Column]:
    """Hashed categories as bucket numbers, and the logarithms of numbers with their squares."""
    out = {}
    for c in categories:
        out[c] = F.pmod(F.xxhash64(F.lit(c), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit(BUCKETS)).cast("int")
    for c in numbers:
        x = F.log1p(F.greatest(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)))
        out |= {c: x, f"{c}_squared": x * x}
    return out


@dataclass(frozen=True)
class View:
    """The columns of a view: numbers as they are, categories as bucket numbers."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f"__{n}" for n in (*self.numbers, *self.categories)]

    def matrix(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Rows of numbers and, per category, a 1 in the place of its bucket."""
        n = len(self.numbers)
        out = [np.stack([np.asarray(c, float) for c in columns[:n]], axis=1)] if n else []
        return np.hstack([*out, *[np.eye(BUCKETS)[np.asarray(c, np.int64)] for c in columns[n:]]])

    def logit(self, weights: np.ndarray, bias: float) -> Column:
        total, n = F.lit(float(bias)), len(self.numbers)
        for name, w in zip(self.numbers, weights):
            total = total + F.lit(float(w)) * F.col(f"`__{name}`")
        for k, name in enumerate(self.categories):
            own = weights[n + k * BUCKETS: n + (k + 1) * BUCKETS]
            total = total + F.element_at(F.array(*[F.lit(float(w)) for w in own]), F.col(f"`__{name}`") + 1)
        return total


@dataclass(frozen=True)
class Model:
    """Calibrated weights and bias of both views, and of their combination; how many rows each view named in each round."""

    views: dict[str, View]
    weights: dict[str, tuple[np.ndarray, float]]
    joint: tuple[np.ndarray, float]
    pseudo_labels: dict[str, list[tuple[int, int]]] = field(default_factory=dict)


def _p(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def newton(
    x: np.ndarray, target: np.ndarray, ridge: float = 1.0, start: np.ndarray | None = None,
    more: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, steps: int = 60,
) -> np.ndarray:
    """Logistic weights of rows that end with a 1. ``more`` = (at, gradient, curvature): further rows, as a parabola around ``at``."""
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    at, gradient, curvature = more or (np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros((x.shape[1],) * 2))
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    for _ in range(steps):
        p = _p(x @ w)
        slope = x.T @ (target - p) + gradient - curvature @ (w - at) - penalty * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + curvature + np.diag(penalty)
        change = np.linalg.solve(curve, slope)
        change *= min(1.0, 5.0 / max(np.abs(change).max(), 1e-12))
        w = w + change
        if np.abs(change).max() < 1e-12:
            break
    return w


class _Fit:
    """One view's labelled rows, standardised, with its weights, calibration and the sums of the sure rows."""

    def __init__(self, view: View, rows, target: np.ndarray, fold: np.ndarray):
        x = view.matrix([rows[n].to_numpy() for n in view.names])
        self.view, self.target, self.fold = view, target, fold
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0)
        self.spread[self.spread < 1e-9] = 1.0
        # categories stay 0 and 1, so that values which never meet leave zeros in the curvature
        self.mean[len(view.numbers):], self.spread[len(view.numbers):] = 0.0, 1.0
        self.x = self.standard(x)
        self.w = newton(self.x, target)
        self.more = None
        self.calibrate()

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.spread, np.ones((len(x), 1))])

    def refit(self, gradient: np.ndarray, curvature: np.ndarray) -> None:
        self.more = (self.w, gradient, curvature)
        self.w = newton(self.x, self.target, start=self.w, more=self.more)

    def calibrate(self) -> None:
        """Logits of each fold from a fit without it; a fold whose rest lacks a class takes the whole fit's."""
        self.unseen = self.x @ self.w
        for f in range(FOLDS):
            rest, own = self.fold != f, self.fold == f
            if own.any() and len(set(self.target[rest])) == 2:
                self.unseen[own] = self.x[own] @ newton(self.x[rest], self.target[rest], start=self.w, more=self.more)
        self.scale = newton(np.stack([self.unseen, np.ones(len(self.unseen))], axis=1), self.target, ridge=0.1)

    def raw(self) -> tuple[np.ndarray, float]:
        """Calibrated weights and bias over the view's own columns."""
        a, b = self.scale
        weights = self.w[:-1] / self.spread
        return a * weights, float(a * (self.w[-1] - weights @ self.mean) + b)


def sure_sums(pool: DataFrame, fits: dict[str, _Fit], givers: dict[str, tuple[np.ndarray, float]], shares, sure: float):
    """For each view: over all rows that the other view is sure of, gradient and curvature at its weights, and the counts.

    ``givers`` are the calibrated views that label; ``shares`` the weights of a bad and of a good row. A task gives
    one number per entry that is not zero, Spark adds them up, and the driver gets as many numbers as the matrices have.
    """
    names = [n for fit in fits.values() for n in fit.view.names]
    other = dict(zip(fits, reversed(list(fits))))
    size = {v: len(fit.w) for v, fit in fits.items()}
    # what tasks get: no labelled rows
    sent = {v: (fit.view, fit.mean, fit.spread, fit.w) for v, fit in fits.items()}

    def run(batches):
        total = {v: np.zeros(2 + size[v] + size[v] ** 2) for v in sent}
        for batch in (whole.slice(lo, SLICE_ROWS) for whole in batches for lo in range(0, whole.num_rows, SLICE_ROWS)):
            columns = dict(zip(names, (c.to_numpy(zero_copy_only=False) for c in batch.columns)))
            x = {v: view.matrix([columns[n] for n in view.names]) for v, (view, *_) in sent.items()}
            for v, (_, mean, spread, w) in sent.items():
                weights, bias = givers[other[v]]
                p = _p(x[other[v]] @ weights + bias)
                good, bad = p >= sure, p <= 1 - sure
                rows = np.flatnonzero(good | bad)
                if not len(rows):
                    continue
                mark, own = good[rows].astype(float), np.hstack([(x[v][rows] - mean) / spread, np.ones((len(rows), 1))])
                share = np.where(good[rows], shares[v][1], shares[v][0])
                q = _p(own @ w)
                curve = np.triu((own * (share * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ own)  # it is symmetric
                total[v] += np.concatenate([[bad.sum(), good.sum()], own.T @ (share * (mark - q)), curve.ravel()])
        for k, v in enumerate(sent):
            some = np.flatnonzero(total[v])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), pa.array(total[v][some])],
                                             ["view", "place", "amount"])

    schema = StructType([StructField("view", IntegerType()), StructField("place", IntegerType()), StructField("amount", DoubleType())])
    out = {v: np.zeros(2 + size[v] + size[v] ** 2) for v in fits}
    for r in map_batches(pool.select(*[f"`{n}`" for n in names]), run, schema).groupBy("view", "place").agg(F.sum("amount").alias("amount")).collect():
        out[list(fits)[r["view"]]][r["place"]] = r["amount"]
    curves = {v: x[2 + size[v]:].reshape(size[v], size[v]) for v, x in out.items()}
    return {v: (x[:2], x[2: 2 + size[v]], curves[v] + np.triu(curves[v], 1).T) for v, x in out.items()}


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def featurize(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
    categories: Sequence[str] = ("lang", "source"), numbers: Sequence[str] = ("n_chars",),
) -> DataFrame:
    """One row per document: ``__id``, the columns of both views and ``__label`` (NULL: unlabelled), as a written table.

    A key labelled several times takes the majority (ties: good); NULL keys and labels are left out.
    """
    voted = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("__label"))
    wanted = list(dict.fromkeys([key, *categories, *numbers]))
    views = with_text_features(docs.select(*[f"`{c}`" for c in dict.fromkeys([*wanted, text])]), text, wanted)
    views = views.select(
        F.col(f"`{key}`").alias("__id"), *[f.name for f in TEXT_FIELDS],
        *[c.alias(f"__{n}") for n, c in meta_features(categories, numbers).items()])
    return materialize(views.join(voted, F.col("__id") == F.col("__key"), "left").drop("__key"), "features")


def views_of(categories: Sequence[str], numbers: Sequence[str]) -> dict[str, View]:
    return {"text": View(TEXT), "meta": View(tuple(n for c in numbers for n in (c, f"{c}_squared")), tuple(categories))}


def fit(
    features: DataFrame, categories: Sequence[str] = ("lang", "source"), numbers: Sequence[str] = ("n_chars",),
    max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, sure: float = SURE,
) -> Model | None:
    """The fitted views from ``featurize``'s table, or None when the labels lack a class.

    Every unlabelled row that a view is sure of counts in the round, rows of equal features once. All sure rows of a class weigh
    together as much as the labelled rows of that class at most. The driver holds ``max_labelled`` rows and one
    square matrix per view.
    """
    views = views_of(categories, numbers)
    names = [n for v in views.values() for n in v.names]
    labelled = features.where("__label IS NOT NULL")
    # a fifth more than the sample by a bound on the hashes, so that tasks send the driver no more than that in all
    place = F.shiftrightunsigned(F.xxhash64("__id", F.lit("sample")), 1)
    most = (1 << 63) - 1
    least = min(most, most * 6 * max_labelled // (5 * max(labelled.count(), 1)))
    rows = (
        labelled.where(place <= F.lit(least)).orderBy(place, "__id", F.xxhash64(*names)).limit(max_labelled)
        .withColumn("__fold", F.pmod(F.xxhash64("__id", F.lit("fold")), F.lit(FOLDS))).toPandas())
    if rows["__label"].nunique() < 2:
        return None
    target, fold = rows["__label"].to_numpy(float), rows["__fold"].to_numpy(np.int64)
    fits = {v: _Fit(view, rows, target, fold) for v, view in views.items()}
    pool = materialize(features.where("__label IS NULL").select(*names).distinct(), "pool")
    marked = np.array([(target == 0).sum(), (target == 1).sum()], float)
    counts = {v: [] for v in views}
    for _ in range(rounds):
        givers = {v: f.raw() for v, f in fits.items()}
        shares, seen = {v: np.ones(2) for v in fits}, None
        for step in range(STEPS + 1):
            sums = sure_sums(pool, fits, givers, shares, sure)
            if step == 0:  # the first pass counts, so that later ones can weigh
                seen = {v: s[0] for v, s in sums.items()}
                shares = {v: np.minimum(1.0, marked / np.maximum(n, 1)) for v, n in seen.items()}
                if all((shares[v] == 1).all() for v in fits):
                    step = 1
            if step:
                for v, f in fits.items():
                    f.refit(*sums[v][1:])
        for v, f in fits.items():
            f.calibrate()
            counts[v].append(tuple(int(n) for n in seen[v]))
        if all(len(given) > 1 and given[-1] == given[-2] for given in counts.values()):
            break  # the views have nothing new to tell each other
    both = np.stack([*(f.scale[0] * f.unseen + f.scale[1] for f in fits.values()), np.ones(len(rows))], axis=1)
    joint = newton(both, target, ridge=0.1)
    return Model(views, {v: f.raw() for v, f in fits.items()}, (joint[:-1], float(joint[-1])), counts)


def score_views(rows: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """Rows with the columns of both views to rows with p_text, p_meta, score and kept; plain expressions only."""
    if model is None:
        one = F.lit(1.0)
        return rows.withColumns({"p_text": one, "p_meta": one, "score": one, "kept": F.lit(True)})
    staged = rows.withColumns({f"__z{v}": view.logit(*model.weights[v]) for v, view in model.views.items()})
    (a, b), bias = model.joint
    joint = _sigmoid(F.lit(float(a)) * F.col("__ztext") + F.lit(float(b)) * F.col("__zmeta") + F.lit(bias))
    scored = staged.withColumns({"p_text": _sigmoid(F.col("__ztext")), "p_meta": _sigmoid(F.col("__zmeta")), "score": joint})
    return scored.withColumn("kept", F.col("score") >= threshold)


def score(
    docs: DataFrame, model: Model | None, text: str = "text", categories: Sequence[str] = ("lang", "source"),
    numbers: Sequence[str] = ("n_chars",), threshold: float = 0.5,
) -> DataFrame:
    """Every row with p_text, p_meta (calibrated views), score (both) and kept; no shuffle.

    Without a model (no labels, or of one class) nothing is known: the columns say 1 and true. NULL and
    empty texts are scored by their empty features; a very long text is measured whole, as a slice of its own. Repeated rows
    score alike. Columns named as the result or starting with two underscores are replaced or left out.
    """
    kept = without(docs, [*RESULT, *(c for c in docs.columns if c.startswith("__"))])
    if model is None:
        return score_views(kept, None)
    rows = with_text_features(kept, text).withColumns({f"__{n}": c for n, c in meta_features(categories, numbers).items()})
    return score_views(rows, model, threshold).select(*[f"`{c}`" for c in kept.columns], *RESULT)


def classify_keys(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = 0.5, **options) -> DataFrame:
    """One row per document with its key and result: the texts are measured once, for the fit and for the scores.

    NULL, empty and very long texts, repeated rows and further columns count as in ``score``.
    """
    features = featurize(docs, labels, key)
    return score_views(features, fit(features, **options), threshold).select(F.col("__id").alias(key), *RESULT)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Fit on the labelled documents and score all of them, with all their columns; see ``fit`` and ``score``."""
    return score(docs, fit(featurize(docs, labels, key), **options))
