"""Quality rules, lines first: judge every line, remove failures, then judge what is left.

A line fails when it is a row of symbols or exclamations, a navigation row, a short fragment
without end punctuation, a boilerplate notice, or a repetition of an earlier line. Lines
without a word are kept. A document is rejected when its removed lines held more than
``max_lost`` of its words, or when it fails the base rules (too few words, too many words in
repeated three-word windows).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from .common import codes_of, map_text, words_of

# Notices that are no part of a text's content, in lower case.
NOTICES = (
    "all rights reserved", "accept cookies", "cookie policy", "click here to", "enable javascript", "privacy policy",
    "sign up for our newsletter", "subscribe to our", "terms of service", "terms of use", "lorem ipsum",
)
SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = r"[#*$%&|<>]"
MARKS = re.compile(r"[#*$%&<>~^=_+{}\[\]\\@]")
SEPARATORS = re.compile(r"[|»›·•]|(?<=\s)[/>](?=\s)")
END = re.compile(r"[.!?…:;,\"'”’»)\]]$")


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    max_repeated_percent: int = 50
    max_marks_per_word: float = 0.25
    max_bangs_per_word: float = 0.25
    min_separators: int = 3
    words_per_separator: float = 4.0
    min_fragment_words: int = 4
    max_lost: float = 0.5
    notices: tuple[str, ...] = NOTICES


def line_fault(line: str, n_words: int, rules: LineRules) -> str | None:
    """The first rule that a line with words breaks."""
    if len(MARKS.findall(line)) > rules.max_marks_per_word * n_words:
        return "symbols"
    if line.count("!") > max(2, rules.max_bangs_per_word * n_words):
        return "exclamations"
    separators = len(SEPARATORS.findall(line))
    if separators >= rules.min_separators and n_words <= rules.words_per_separator * separators:
        return "navigation"
    if n_words < rules.min_fragment_words and not END.search(line.rstrip(SPACE)):
        return "fragment"
    low = line.lower()
    if any(notice in low for notice in rules.notices):
        return "notice"
    return None


def judge_lines(text: str, rules: LineRules) -> tuple[str, int, int, int]:
    """Text without its failed lines; failed lines, words in them, repeated lines."""
    kept, seen, faults, lost, repeats = [], set(), 0, 0, 0
    for line in text.split("\n"):
        if not line.strip(SPACE):
            kept.append(line)
            continue
        n_words = len(WORD.findall(line))
        repeated = line in seen
        repeats += repeated
        if repeated or line_fault(line, n_words, rules):
            faults, lost = faults + 1, lost + n_words
        else:
            kept.append(line)
        seen.add(line)
    return "\n".join(kept), faults, lost, repeats


def repeated_words(words: pa.Array, row: np.ndarray, n_rows: int, width: int = 3) -> np.ndarray:
    """Per row: words inside a ``width``-word window that the row has twice or more."""
    out = np.zeros(n_rows, np.int64)
    if len(row) < width:
        return out
    window = codes_of(words)
    base = int(window.max()) + 1
    single = window
    for k in range(1, width):  # exact: renumber the pairs after each step
        window = np.unique(window[: len(single) - k] * base + single[k:], return_inverse=True)[1]
    inside = row[: len(window)] == row[width - 1:]
    window, at = window[inside], np.flatnonzero(inside)
    if not len(at):
        return out
    _, inverse, count = np.unique(window * n_rows + row[at], return_inverse=True, return_counts=True)
    twice = at[count[inverse] > 1]
    covered = np.zeros(len(row), bool)
    for k in range(width):
        covered[twice + k] = True
    return np.bincount(row[covered], minlength=n_rows)


FIELDS = [
    *[StructField(c, LongType()) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "n_lost_words")],
    StructField("base_failed", BooleanType()), StructField("kept", BooleanType()), StructField("clean_text", StringType()),
]


def kernel(rules: LineRules):
    def run(texts: pa.Array) -> list:
        n = len(texts)
        words, row = words_of(texts)
        n_words = np.bincount(row, minlength=n)
        chars = np.bincount(row, pc.utf8_length(words).to_numpy(zero_copy_only=False), minlength=n).astype(np.int64)
        repeats = repeated_words(words, row, n)
        lines = [judge_lines(t, rules) for t in texts.to_pylist()]
        lost = np.array([x[2] for x in lines], np.int64)
        failed = (n_words < rules.min_words) | (100 * repeats > rules.max_repeated_percent * n_words)
        kept = ~failed & (lost <= rules.max_lost * n_words)
        numbers = [
            n_words, chars, pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False),
            [x[3] for x in lines], repeats, [x[1] for x in lines], lost,
        ]
        return [
            *(pa.array(np.asarray(x, np.int64)) for x in numbers), pa.array(failed), pa.array(kept),
            pa.array([x[0] for x in lines], pa.string()),
        ]

    return run


def clean_lines(
    docs: DataFrame, text: str = "text", rules: LineRules = LineRules(), keep: list[str] | None = None
) -> DataFrame:
    """Every document with its counts, verdict and cleaned text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (on the whole input text),
    n_failed_lines, n_lost_words, base_failed, kept and clean_text; columns of these names in
    the input are replaced. ``keep`` names the input columns to carry (default: all).

    A NULL or empty text counts as no words: base_failed is true and clean_text is empty.
    Repeated rows are judged alike, each on its own. An empty frame gives an empty frame. A row
    depends on nothing but its text, so there is no shuffle and no group.
    """
    return map_text(docs, text, FIELDS, lambda: kernel(rules), keep)
