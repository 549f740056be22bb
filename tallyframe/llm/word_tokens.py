"""Token ids of whole texts, fast: each different word goes through the tokenizer once per task.

A tokenizer that drops white space gives a text the ids of its words, one after the other. So a
batch is cut at ASCII white space, its different words are looked up in a bounded cache, and
only new ones are encoded by the ``tokenizers`` library. Words of Latin letters skip the
library's normaliser and splitter (they stay one word, lowered and written as bytes) and go
to its BPE model directly; all others go through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
#: Words remembered by a task; beyond that the cache starts anew, which costs time only.
CACHE_WORDS = 800_000
# letters whose lower case and normal form are one character each
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
LETTERS = f"^[{_LETTER}]+$"
# ASCII marks; between a letter and one of them the tokenizer always cuts
TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CORE = f"^[{_LETTER}]+"
_PARTED = f"^[{_LETTER}]+[!-/:-@\\[-`{{-~]+$"


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level models write each byte: itself if printable, else 256 and up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _grown(x: np.ndarray, need: int) -> np.ndarray:
    return x if need <= len(x) else np.concatenate([x, np.zeros(max(need - len(x), len(x)), x.dtype)])


class WordEncoder:
    def __init__(self, path: str, end_id: int | None = END_ID, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = special_as_text
        spec = json.loads(self.whole.to_str())
        strings = [] if special_as_text else [re.escape(t["content"]) for t in spec["added_tokens"] if t["special"]]
        self.special = "(?i)" + "|".join(strings) if strings else None
        self.by_word, self.fast = self._traits(spec)
        self.model = Tokenizer(self.whole.model) if self.fast else None
        self.letters, self.end_id = byte_letters(), end_id
        self.dtype = np.dtype("<u2") if max(self.whole.get_vocab_size(), end_id or 0) <= 1 << 16 else np.dtype("<u4")
        self._clear()

    @staticmethod
    def _traits(spec: dict) -> tuple[bool, bool]:
        """Whether white space always parts and vanishes; whether lower-cased words of letters stay whole."""
        steps = lambda part, key: [part, *part.get(key, [])] if part else []
        patterns = [
            s["pattern"].get("Regex", "") for s in steps(spec.get("pre_tokenizer"), "pretokenizers")
            if s["type"] == "Split" and s.get("invert") and s["behavior"] == "Removed"]
        by_word = any(r"[^\s" in p and r"\s+" not in p for p in patterns)
        kinds = {s["type"] for s in steps(spec.get("normalizer"), "normalizers")} - {"Sequence"}
        return by_word, by_word and kinds == {"NFC", "Replace", "Lowercase"} and any(r"[\p{L}]+" in p for p in patterns)

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, words: list[str], plain: bool) -> np.ndarray:
        """Encode new words and keep their ids; plain ones (letters only) take the short way."""
        first, last = len(self.place), len(self.place) + len(words)
        self.start, self.size = _grown(self.start, last), _grown(self.size, last)
        for lo in range(0, len(words), 50_000):
            part = words[lo: lo + 50_000]
            if plain:
                letters = self.letters
                spelt = [w if w.isascii() else w.lower().encode().decode("latin-1").translate(letters) for w in part]
                found = [e.ids for e in self.model.encode_batch_fast(spelt, add_special_tokens=False)]
            else:
                found = [e.ids for e in self.whole.encode_batch_fast(part, add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(found), self.dtype)
            size = np.fromiter(map(len, found), np.int64, len(found))
            self.pool = _grown(self.pool, self.used + len(flat))
            self.pool[self.used: self.used + len(flat)] = flat
            self.size[first + lo: first + lo + len(part)] = size
            self.start[first + lo: first + lo + len(part)] = self.used + np.cumsum(size) - size
            self.used += len(flat)
        self.place.update(zip(words, range(first, last)))
        return np.arange(first, last)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the ids of each word are kept, learning those that are new."""
        words = words.dictionary_encode()
        listed = words.dictionary.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.place.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(at < 0)
        if len(new):
            plain = np.zeros(len(new), bool)
            if self.fast:
                plain = pc.match_substring_regex(words.dictionary.take(pa.array(new)), LETTERS).to_numpy(zero_copy_only=False)
            for kind in (True, False):
                some = new[plain == kind]
                at[some] = self._learn(listed[some].tolist(), kind)
        return at[words.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one more entry than texts)."""
        if not self.by_word:
            found = [e.ids for e in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            flat = np.array([i for x in found for i in x], self.dtype)
            counts = np.array([len(x) for x in found], np.int64)
            return self._ended(flat, counts)
        if self.special:
            odd = pc.match_substring_regex(texts, self.special)
            if pc.any(odd).as_py():  # texts that hold a special token's string go through the tokenizer as a whole
                flat, starts = self._by_words(pc.if_else(odd, "", texts))
                found = [e.ids for e in self.whole.encode_batch(texts.filter(odd).to_pylist(), add_special_tokens=False)]
                added = np.zeros(len(texts), np.int64)
                added[odd.to_numpy(zero_copy_only=False)] = [len(x) for x in found]
                flat = np.insert(flat, np.repeat(starts[:-1], added), np.fromiter(chain.from_iterable(found), self.dtype))
                return flat, starts + np.concatenate([[0], np.cumsum(added)])
        return self._by_words(texts)

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self.fast else texts)
        words = pc.list_flatten(split).dictionary_encode()
        row = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
        if len(self.place) > CACHE_WORDS:
            self._clear()
        code = words.indices.to_numpy(zero_copy_only=False)
        if self.fast:  # a word of letters and the marks after it are two pieces
            parted = pc.match_substring_regex(words.dictionary, _PARTED)
            core = pc.if_else(parted, pc.ascii_rtrim(words.dictionary, TAIL), words.dictionary)
            tail = pc.if_else(parted, pc.replace_substring_regex(words.dictionary, _CORE, ""), "")
            at = np.stack([self._places(core)[code], self._places(tail)[code]], axis=1).ravel()
            row = np.repeat(row, 2)
        else:
            at = self._places(words.dictionary)[code]
        start, size = self.start[at], self.size[at]
        ends = np.cumsum(size)
        flat = self.pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        counts = np.bincount(row, size, minlength=len(texts)).astype(np.int64)
        return self._ended(flat, counts)

    def _ended(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        if self.end_id is None:
            return flat, starts
        flat = np.insert(flat, starts[1:], np.asarray(self.end_id, self.dtype))
        return flat, starts + np.arange(len(starts))


@lru_cache(maxsize=1)
def encoder(path: str, end_id: int | None = END_ID, special_as_text: bool = True) -> WordEncoder:
    """One encoder per Python worker and tokenizer file; its cache lives on between tasks."""
    return WordEncoder(path, end_id, special_as_text)


def crc_of(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
