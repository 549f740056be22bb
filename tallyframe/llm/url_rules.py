"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

A rule is a host and a path prefix, such as ``example.com/en/``. It fits its host and all
subdomains when the path starts with its prefix; of those that fit, the longest wins. Urls
without a rule are judged by a model of signed n-gram hashes, trained on the driver from a
small labelled table (under two thousand rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .common import map_text, mix64, without

ALLOW, BLOCK = "allow", "block"
WIDTHS = (3, 4, 5)
BUCKETS = 1 << 15

# words of hosts and paths that are wanted or not; the labelled table is made of them
WANTED = (
    "about archive article biology blog book building chemistry city cooking course culture daily docs education engineering essay europe gardening "
    "geology guide health history journal kitchen language law learning library lecture literature magazine manual medicine "
    "museum music nature news painting paper physics poetry press recipe reference report research review school science "
    "story teacher travel tutorial university weather wiki writing"
).split()
UNWANTED = (
    "ad ads adserver adult affiliate banner betting bonus casino cheap cheap-pills clickbait coupons crack dating doubleclick "
    "download-free escort fake-watches free-money gambling get-rich jackpot keygen link-farm loan-shark lottery malware nude "
    "payday phishing pills pixel poker popup porn replica sex slots spam sponsor sportsbet torrent track tracker "
    "tracking viagra warez webcam win win-prize xxx ads-track cheap-loans online-pharmacy"
).split()


# common syllables; names made of them say nothing about a site and are wanted
SYLLABLES = (
    "al an ar as at au ber ble ca che cia con da de der di do ed el en er es eu fa ge ha he ho in ing ion is la le li lo ly ma "
    "me mo na ne no nt on or ou pa pe po que ra re ri ro sa schaft sh si so st ta te th ti to tre un ung ur va ver vi wa we wh"
).split()
ENDS = "example.com example.org example.net example.info test.dev invalid.co.uk test.io example.de example.fr example.es".split()
FRONTS = ("", "", "www.", "m.", "blog.", "en.", "static.", "go.", "shop.", "news.")
LANGS = ("en", "de", "fr", "es", "index.html", "page", "a", "2023", "item", "view")
LETTERS = "aeioubcdfghjklmnprstvwyzth"
#: Labelled urls of each class that hold words; there are as many with plain names only.
LABELLED = 800


class _Draws:
    """Repeatable picks: the next numbers of a hash sequence."""

    def __init__(self, seed: int):
        self.seed, self.at = seed, 0

    def below(self, n: int) -> int:
        self.at += 1
        return int(mix64(np.array([self.seed * 1_000_003 + self.at], np.uint64))[0] % np.uint64(n))

    def of(self, items: Sequence[str]) -> str:
        return items[self.below(len(items))]


def labelled_urls(size: int = LABELLED) -> list[tuple[str, str, str]]:
    """The small labelled table by a rule: (host, path, verdict), ``size`` rows of each class, and ``size`` of plain names.

    Hosts and paths are put together as sites do it: one word or two, joined or hyphenated, with numbers, fronts and
    ends, over paths of several parts. A blocked url has an unwanted word in its host or in its path, next to words that say
    nothing or would be wanted alone; an allowed one has wanted words or plain names only. So the same words
    come in many surroundings, and surroundings come with both verdicts.
    """
    rows = []
    for verdict, own in ((ALLOW, WANTED), (BLOCK, UNWANTED)):
        draw = _Draws(1 if verdict == ALLOW else 2)

        def name() -> str:
            return "".join(draw.of(SYLLABLES) for _ in range(2 + draw.below(2)))

        def other() -> str:
            return name() if draw.below(2) else draw.of(WANTED)

        for k in range(size):
            word = own[k % len(own)]
            joint = draw.of(("", "-", "."))
            in_host = verdict == ALLOW or draw.below(3) > 0
            kind = draw.below(5)
            if not in_host or (verdict == ALLOW and kind == 0):
                label = name() if draw.below(3) else f"{other()}{joint}{other()}"
            elif kind <= 2:
                label = word + (str(draw.below(1000)) if draw.below(4) == 0 else "")
            else:
                label = f"{word}{joint}{other()}" if draw.below(2) else f"{other()}{joint}{word}"
            plain = in_host and draw.below(2)  # half of the hosts that tell enough have a path that tells nothing
            if plain:
                rows.append((f"{draw.of(FRONTS)}{label}.{draw.of(ENDS)}", f"/{draw.of(LANGS)}/{draw.below(10_000)}{draw.of(('', '/', '.html'))}", verdict))
                continue
            path = "/".join(["", draw.of(LANGS), *[other() for _ in range(draw.below(3))]])
            if not in_host or (verdict == ALLOW and draw.below(2)) or draw.below(6) == 0:
                path += f"/{word}"
            tail = draw.of(("", "/", f"/{draw.below(100_000)}", f"-{draw.below(1000)}.html", ".php"))
            rows.append((f"{draw.of(FRONTS)}{label}.{draw.of(ENDS)}", path + tail, verdict))
    draw = _Draws(3)
    for _ in range(size):  # names of any letters: what the model has never seen is wanted
        label = "".join(draw.of(SYLLABLES) if draw.below(2) else draw.of(LETTERS) + draw.of(LETTERS) for _ in range(2 + draw.below(3)))
        path = "/".join(["", draw.of(LANGS), *["".join(draw.of(SYLLABLES) for _ in range(2))][: draw.below(2)], str(draw.below(10_000))])
        rows.append((f"{draw.of(FRONTS)}{label}.{draw.of(ENDS)}", path + draw.of(("", "/", ".html")), ALLOW))
    return rows


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path. NULL or a text without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return (
        F.when(at > 0, F.translate(host, upper, lower)).otherwise(F.lit("")),
        F.when(at > 0, path).otherwise(F.lit("")),
    )


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, else NULLs. Equal rules: block before allow."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == BLOCK, r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(texts: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every character n-gram (UTF-8 bytes, with edge marks) of each text; numbers count as 0."""
    parts, rows = [], []
    marked = pc.binary_join_element_wise("^", pc.replace_substring_regex(texts, "[0-9]+", "0"), "$", "")
    flat = np.frombuffer(b"".join(x.encode() for x in marked.to_pylist()), np.uint8).astype(np.uint64)
    sizes = pc.binary_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    for width in WIDTHS:
        if len(flat) < width:
            continue
        code = np.full(len(flat) - width + 1, salt * 8 + width, np.uint64)
        for k in range(width):
            code = code * np.uint64(257) + flat[k: len(flat) - width + 1 + k]
        inside = row[: len(code)] == row[width - 1:]
        parts.append((mix64(code[inside]) % np.uint64(BUCKETS)).astype(np.int64))
        rows.append(row[: len(code)][inside])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(rows)


def logits(weights: np.ndarray, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
    """Bias plus the mean n-gram weight of the host and of the path, by the root of their number."""
    total = np.full(len(hosts), weights[-1])
    for salt, texts in ((1, hosts), (2, paths)):
        bucket, row = grams(texts, salt)
        count = np.maximum(np.bincount(row, minlength=len(hosts)), 1)
        total += np.bincount(row, weights[bucket], minlength=len(hosts)) / np.sqrt(count)
    return total


def train(rows: Sequence[tuple[str, str, str]], rounds: int = 1500, rate: float = 20.0, decay: float = 3e-5) -> np.ndarray:
    """Weights by gradient descent, both verdicts with equal weight (the last number is the bias).

    Rows without both verdicts: all zero but for the bias, which allows.
    """
    weights = np.zeros(BUCKETS + 1)
    target = np.array([r[2] == BLOCK for r in rows], float)
    if not len(target) or target.min() == target.max():
        weights[-1] = -1.0
        return weights
    share = np.where(target == 1, 0.5 / target.sum(), 0.5 / (1 - target).sum())
    sides = []
    for salt, column in ((1, 0), (2, 1)):
        bucket, row = grams(pa.array([r[column] for r in rows], pa.string()), salt)
        count = np.maximum(np.bincount(row, minlength=len(rows)), 1)
        sides.append((bucket, row, 1 / np.sqrt(count[row])))
    bucket, row, value = (np.concatenate(x) for x in zip(*sides))
    used, bucket = np.unique(bucket, return_inverse=True)
    inner, bias = np.zeros(len(used)), 0.0
    for _ in range(rounds):
        z = bias + np.bincount(row, inner[bucket] * value, minlength=len(rows))
        fault = (1 / (1 + np.exp(-z)) - target) * share
        inner -= rate * (np.bincount(bucket, fault[row] * value, minlength=len(used)) + decay * inner)
        bias -= rate / 20 * fault.sum()
    weights[used], weights[-1] = inner, bias
    return weights


@lru_cache(maxsize=1)
def _own_weights() -> np.ndarray:
    return train(labelled_urls())


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: Sequence[tuple[str, str, str]] | None = None,
    url: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """Every row with host, path, rule, verdict and block_probability.

    Verdict: the rule's, else ``block`` when the model's probability reaches ``threshold``.
    NULL urls and urls without ``://`` have an empty host and path, fit no rule and are judged
    by the model like any text. Repeated rows are judged alike. Columns of these names in the
    input are replaced. The model is one bounded array (BUCKETS + 1 numbers) sent with the
    task; there is no shuffle.
    """
    weights = _own_weights() if labelled is None else train(labelled)
    host, path = split_url(F.col(f"`{url}`"))
    judged = without(pages, [c for c in ("host", "path", "rule", "verdict", "block_probability") if c != url])
    judged = judged.withColumns({"__host": host, "__path": path})
    rule, kind = matched_rule(F.col("__host"), F.col("__path"), rules)
    judged = judged.withColumns({"__rule": rule, "__kind": kind, "__both": F.concat("__host", F.lit("\n"), "__path")})

    def make():
        def run(both: pa.Array) -> list:
            parts = pc.split_pattern(both, "\n", max_splits=1)
            z = logits(weights, pc.list_element(parts, 0), pc.list_element(parts, 1))
            return [pa.array(1 / (1 + np.exp(-z)))]

        return run

    kept = [c for c in judged.columns if c != "__both"]
    scored = map_text(judged, "__both", [StructField("block_probability", DoubleType())], make, kept)
    by_model = F.when(F.col("block_probability") >= threshold, BLOCK).otherwise(ALLOW)
    names = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict", "block_probability"}]
    return scored.select(
        *[F.col(f"`{c}`") for c in names], F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("__rule").alias("rule"), F.coalesce("__kind", by_model).alias("verdict"), "block_probability",
    )
