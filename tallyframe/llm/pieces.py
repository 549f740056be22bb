"""SentencePiece encoding and decoding with the N best segmentations.

The lattice of a text has an edge for every piece that occurs in it, with the piece's score; a
character that is no piece is one edge of its UTF-8 bytes' pieces. A forward Viterbi pass gives the
best score of every prefix. Read backwards, that is the exact cost of what is left, so an A-star
search from the end pops complete segmentations in order of their total score; of equal scores, the one whose last
pieces begin later comes first.

Two neighbouring characters that no piece holds side by side always part a segmentation. Texts are cut
at all such places, each different cut is searched once per task for its N best (many cuts of one length side by side),
and the N best of a text are the N best sums of its cuts' alternatives.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .common import map_batches, map_text

MARK = "▁"  # fixed value: how the model writes a space
#: Score of a character outside the model, below the least piece by so much.
UNKNOWN_PENALTY = 10.0
#: Scores below are a model's sign for pieces out of order, such as runs of spaces; they set no scale.
NEVER = -1e8
#: Different words and cuts that a task remembers; beyond that it starts anew, which costs time only.
CACHE_CUTS = 400_000
#: Cuts longer than this are searched one by one.
LONG_CUT = 32
#: Places for edges in the lattices that are searched side by side; bounds their memory.
BLOCK_EDGES = 400_000
N_BEST = 4
WORDS = re.compile(" *[^ ]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C55)


class PieceModel:
    def __init__(self, path: str, n: int = N_BEST):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.text_of = [sp.id_to_piece(k) for k in range(size)]
        self.byte_of: dict[int, int] = {}
        self.id_of: dict[str, tuple[int, float]] = {}
        for k in range(size):
            if sp.is_byte(k):
                self.byte_of[k] = int(self.text_of[k][3:5], 16)
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                self.id_of[self.text_of[k]] = (k, sp.get_score(k))
        self.of_byte = {b: k for k, b in self.byte_of.items()}
        self.unknown = min(s for _, s in self.id_of.values() if s > NEVER) - UNKNOWN_PENALTY
        # beginnings of pieces, with id and score where the piece is whole
        self.begun = {p[:k]: None for p in self.id_of for k in range(1, len(p))} | self.id_of
        self.pairs = {p[k: k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self.pair_codes = np.array(sorted(ord(a) << 32 | ord(b) for a, b in self.pairs), np.uint64)
        # words are cut off at spaces unless some piece goes on after a space
        self.spaced = not any(a != MARK and b == MARK for a, b in self.pairs)
        self.bytes_of = [
            bytes([self.byte_of[k]]) if k in self.byte_of else self.text_of[k].replace(MARK, " ").encode() for k in range(size)]
        self.bytes_array = pa.array(self.bytes_of, pa.large_binary())
        self.n = n
        self._index_pieces()
        self._clear()

    # -- lattice -------------------------------------------------------------------------

    def lattice(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Edges (start, score, ids) by the place where they end."""
        size, begun = len(text), self.begun
        into: list = [[] for _ in range(size + 1)]
        for start in range(size):
            end, single = start + 1, False
            while end <= size:
                piece = begun.get(text[start:end], 0)
                if piece == 0:  # no piece begins like this
                    break
                if piece is not None:
                    into[end].append((start, piece[1], (piece[0],)))
                    single |= end == start + 1
                end += 1
            if not single:
                raw = text[start].encode("utf-8", "surrogatepass")
                into[start + 1].append((start, self.unknown * len(raw), tuple(self.of_byte[b] for b in raw)))
        return into

    def viterbi(self, into: list) -> tuple[list[float], list]:
        """The best score of every prefix and its last edge."""
        best, last = [0.0], [None]
        for edges in into[1:]:
            score, edge = max((best[e[0]] + e[1], e) for e in edges)
            best.append(score)
            last.append(edge)
        return best, last

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a cut, best first; of equal scores, the one whose last pieces begin later."""
        size, edges = len(text), self.lattice(text)
        best, _ = self.viterbi(edges)
        # (-total, minus the places of all starts so far as bits, position, score from here to the end, ids from here)
        heap = [(-best[size], 0, size, 0.0, ())]
        out, visits = [], [0] * (size + 1)
        while heap and len(out) < n:
            total, starts, at, behind, tail = heapq.heappop(heap)
            visits[at] += 1
            if visits[at] > n:  # n better ways through this place are known
                continue
            if at == 0:
                out.append((behind, tuple(i for ids in reversed(tail) for i in ids)))
                continue
            for start, s, ids in edges[at]:
                score = behind + s
                heapq.heappush(heap, (-(best[start] + score), starts - (1 << start), start, score, tail + (ids,)))
        return out

    # -- many cuts at once ---------------------------------------------------------------

    def _index_pieces(self) -> None:
        """Pieces by the hash of their characters, in order of the hash; the longest piece's length."""
        found = sorted((_hash_text(p), k, s) for p, (k, s) in self.id_of.items())
        self.piece_hash = np.array([x[0] for x in found], np.uint64)
        self.piece_id = np.array([x[1] for x in found], np.int32)
        self.piece_score = np.array([x[2] for x in found])
        self.longest = max(map(len, self.id_of))
        # which low bits of a hash occur at all: most parts of a text are no piece, and need no search
        self.occurs = np.zeros(1 << 19, bool)
        self.occurs[self.piece_hash & np.uint64(len(self.occurs) - 1)] = True

    def search_all(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """``n_best`` for many cuts: those of one length are searched side by side.

        Yields places in ``texts``, the scores of their choices (a column for each of the n, -inf: there is none), the
        choices' number of ids and all these ids, cut by cut and choice by choice.
        """
        by_size: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            by_size.setdefault(len(t) if 0 < len(t) <= LONG_CUT else 0, []).append(k)
        alone = by_size.pop(0, [])
        for size, some in by_size.items():
            rows = max(64, BLOCK_EDGES // (size * size))
            for lo in range(0, len(some), rows):
                part = some[lo: lo + rows]
                if len(part) <= 8:
                    alone += part
                    continue
                bare, *found = self._search_block([texts[k] for k in part], size)
                alone += [part[k] for k in np.flatnonzero(bare)]
                yield [part[k] for k in np.flatnonzero(~bare)], *found
        if alone:
            found = [self.n_best(texts[k], self.n) for k in alone]
            score, sizes = np.full((len(alone), self.n), -np.inf), np.zeros((len(alone), self.n), np.int64)
            for k, choices in enumerate(found):
                score[k, :len(choices)] = [s for s, _ in choices]
                sizes[k, :len(choices)] = [len(ids) for _, ids in choices]
            yield alone, score, sizes, np.array([i for choices in found for _, ids in choices for i in ids], np.int32)

    def _search_block(self, texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of the cuts have a character that is no piece; scores, sizes and ids of the choices of the others."""
        n = len(texts)
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = chars.reshape(n, size).astype(np.uint64) + np.uint64(1)
        edge = np.full((n, size + 1, size), -np.inf)  # by end and start
        piece = np.zeros((n, size + 1, size), np.int32)
        bare = np.zeros(n, bool)
        for start in range(size):
            code = np.zeros(n, np.uint64)
            for end in range(start + 1, min(size, start + self.longest) + 1):
                code = code * _BASE + chars[:, end - 1]
                some = np.flatnonzero(self.occurs[code & np.uint64(len(self.occurs) - 1)])
                at = np.minimum(np.searchsorted(self.piece_hash, code[some]), len(self.piece_hash) - 1)
                same = self.piece_hash[at] == code[some]
                hit, at = some[same], at[same]
                if end == start + 1:
                    known = np.zeros(n, bool)
                    known[hit] = True
                    bare |= ~known
                edge[hit, end, start], piece[hit, end, start] = self.piece_score[at], self.piece_id[at]
        if bare.any():
            edge, piece = edge[~bare], piece[~bare]
        best = np.zeros((len(edge), size + 1))
        for end in range(1, size + 1):
            best[:, end] = (best[:, :end] + edge[:, end, :end]).max(axis=1)
        # the edges of a place side by side: places have few, lattices many places
        finite = np.isfinite(edge)
        row, end, start = np.nonzero(finite)
        degree = finite.sum(axis=2)
        nth = np.arange(len(row)) - (np.cumsum(degree) - degree.ravel())[row * (size + 1) + end]
        width = max(1, int(degree.max(initial=1)))
        begin, gain = np.zeros((*degree.shape, width), np.int8), np.full((*degree.shape, width), -np.inf)
        begin[row, end, nth], gain[row, end, nth] = start, edge[row, end, start]
        limit = float(1 << (60 - size))
        loss = np.where(np.isfinite(gain), best[np.arange(len(best))[:, None, None], begin] + gain - best[:, :, None], 0)
        if (best == np.floor(best)).all() and (loss == np.floor(loss)).all() and np.abs(best).max(initial=0) < limit and -loss.min(initial=0) * size < limit:
            score, starts = self._search_whole(begin, np.where(np.isfinite(gain), loss, -limit * 4), best[:, -1], size)
        else:
            score, starts = self._search_back(begin, gain, best, size)
        # the starts of a choice's pieces are the bits set; a piece ends where the next begins
        bits = (starts[:, :, None] >> np.arange(size)) & 1 > 0
        ends, after = np.zeros(bits.shape, np.int64), np.full(starts.shape, size)
        for k in range(size - 1, -1, -1):
            ends[:, :, k] = after
            after = np.where(bits[:, :, k], k, after)
        row, choice, start = np.nonzero(bits)
        return bare, score, bits.sum(axis=2), piece[row, ends[row, choice, start], start]

    def _search_whole(self, begin: np.ndarray, loss: np.ndarray, best: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """``_search_back`` where all scores are whole: total and starts of a way are one number, in the order of the heap.

        ``loss`` is how much the total falls when a way takes an edge, far below all others where there is none.
        """
        n, count, width = len(loss), self.n, loss.shape[2]
        score, starts = np.full((n, count), -np.inf), np.zeros((n, count), np.int64)
        step = (loss.astype(np.int64) << size) + (np.int64(1) << begin.astype(np.int64))
        step, begin = step.reshape(-1, width), begin.reshape(-1, width)
        none, mask = np.int64(-1 << 61), np.int64((1 << size) - 1)
        row, found = np.arange(n), np.zeros(n, np.int64)  # cuts still searched and their finished choices
        slots = count + 4 * width
        key, place, used = np.full((n, slots), 2 * none), np.zeros((n, slots), np.int8), 1
        key[:, 0], place[:, 0] = best.astype(np.int64) << size, size
        while len(row):
            if used + width > slots:
                # the rest of a way is known exactly, so the first n ways of the heap lead to n segmentations: others are not needed
                first = np.argpartition(key[:, :used], -count, axis=1)[:, -count:]
                key[:, :count], place[:, :count] = np.take_along_axis(key, first, axis=1), np.take_along_axis(place, first, axis=1)
                used = count
            top = key[:, :used].argmax(axis=1) + np.arange(len(row)) * slots
            now, at = key.ravel()[top], place.ravel()[top].astype(np.int64)
            left = now > none
            done = np.flatnonzero(left & (at == 0))
            if len(done):
                score[row[done], found[done]], starts[row[done], found[done]] = now[done] >> size, now[done] & mask
                found[done] += 1
            edges = row * (size + 1) + at
            new, where = now[:, None] + step.take(edges, axis=0), begin.take(edges, axis=0)
            new[done] = 2 * none
            new[new <= none] = 2 * none
            # the first edge takes the slot that came free
            key.ravel()[top], place.ravel()[top] = new[:, 0], where[:, 0]
            key[:, used: used + width - 1], place[:, used: used + width - 1] = new[:, 1:], where[:, 1:]
            used += width - 1
            going = left & (found < count)
            if going.sum() < 0.8 * len(row):
                row, found, key, place = row[going], found[going], key[going], place[going]
            elif not going.all():
                key[~going] = 2 * none
        return score, starts

    def _search_back(self, begin: np.ndarray, gain: np.ndarray, best: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The search of ``n_best`` on many lattices at once: every step takes the top of every cut's heap.

        ``begin`` and ``gain`` are the edges into each place, -inf where there is none. Returns the scores of the choices
        and the starts of their pieces as bits.
        """
        n, count, width = len(gain), self.n, gain.shape[2]
        score, starts = np.full((n, count), -np.inf), np.zeros((n, count), np.int64)
        row, found = np.arange(n), np.zeros(n, np.int64)  # cuts still searched and their finished choices
        slots = count + 4 * width
        total, behind = np.full((n, slots), -np.inf), np.zeros((n, slots))
        way, place = np.zeros((n, slots), np.int64), np.full((n, slots), size, np.int8)
        total[:, 0] = 0
        visits, used = np.zeros((n, size + 1), np.int64), 1
        while len(row):
            if used + width > slots:
                # the rest of a way is known exactly, so the first n ways of the heap lead to n segmentations: others are not needed
                open_ = total[:, :used]
                first_ways = np.lexsort((way[:, :used], open_), axis=1)
                for x in (total, behind, way, place):
                    x[:, :count] = np.take_along_axis(x[:, :used], first_ways[:, -count:], axis=1)
                used = count
            own = np.arange(len(row))
            open_ = total[:, :used]
            pick = np.where(open_ == open_.max(axis=1)[:, None], way[:, :used], -1).argmax(axis=1)
            left = open_[own, pick] > -np.inf
            at, so_far, taken = place[own, pick].astype(np.int64), behind[own, pick], way[own, pick]
            visits[own, at] += 1
            useful = left & (visits[own, at] <= count)
            done = useful & (at == 0)
            score[row[done], found[done]], starts[row[done], found[done]] = so_far[done], taken[done]
            found[done] += 1
            first = begin[row, at]
            through = so_far[:, None] + gain[row, at]
            # nothing goes into a place that n better ways went through
            shut = ~(useful & ~done)[:, None] | (visits[own[:, None], first] >= count) | (through == -np.inf)
            whole, ways = best[row[:, None], first] + through, taken[:, None] | (np.int64(1) << first.astype(np.int64))
            whole[shut] = -np.inf
            # the first edge takes the slot that came free
            total[own, pick], behind[own, pick], way[own, pick], place[own, pick] = whole[:, 0], through[:, 0], ways[:, 0], first[:, 0]
            new = slice(used, used + width - 1)
            total[:, new], behind[:, new], way[:, new], place[:, new] = whole[:, 1:], through[:, 1:], ways[:, 1:], first[:, 1:]
            used += width - 1
            going = left & (found < count)
            if going.sum() < 0.8 * len(row):
                row, found, visits = row[going], found[going], visits[going]
                total, behind, way, place = total[going], behind[going], way[going], place[going]
            elif not going.all():
                total[~going] = -np.inf
        return score, starts

    # -- texts ---------------------------------------------------------------------------

    def _clear(self) -> None:
        """Forget all cuts (place, and for each choice ids in a pool and score) and the cuts of words."""
        self.place: dict[str, int] = {}
        self.word: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        shape = 1 << 14, self.n
        self.start, self.size, self.score = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape)
        self.loss = np.zeros(1 << 14)
        self.word_start, self.word_size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.word_cuts, self.word_used = np.zeros(1 << 16, np.int64), 0

    def cuts(self, text: str) -> list[str]:
        """Parts of a text (spaces as MARK) between characters that no piece holds side by side."""
        out, start, pairs = [], 0, self.pairs
        for k in range(1, len(text)):
            if text[k - 1: k + 1] not in pairs:
                out.append(text[start:k])
                start = k
        out.append(text[start:])
        return out

    def _cuts_of_words(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """``cuts`` of many words (spaces as they are), one after the other, and how many each has."""
        joined = "".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer(joined.replace(" ", MARK).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        pair = chars[:-1] << np.uint64(32) | chars[1:]
        at = np.minimum(np.searchsorted(self.pair_codes, pair), len(self.pair_codes) - 1)
        parted = np.concatenate([[True], self.pair_codes[at] != pair])
        begins = np.cumsum(size) - size
        parted[begins] = True
        cut = np.flatnonzero(parted)
        ends = [*cut[1:].tolist(), len(joined)]
        return [joined[a:b] for a, b in zip(cut.tolist(), ends)], np.diff([*np.searchsorted(cut, begins).tolist(), len(cut)])

    def words(self, text: str) -> list[str]:
        """Runs of spaces with the characters after them, the text's own MARKs apart; a space comes in front."""
        if MARK in text:
            out = []
            for k, part in enumerate(text.split(MARK)):
                out += ([MARK] if k else []) + WORDS.findall(part if k else " " + part)
            return out
        return WORDS.findall(" " + text) if self.spaced else [" " + text]

    def _keep_cuts(self, new: list[str]) -> None:
        """Search new cuts and keep what was found. A cut that is the text's own MARK goes as bytes and so comes back."""
        first, last = len(self.place), len(self.place) + len(new)
        for name in ("start", "size", "score", "loss"):
            setattr(self, name, _grown(getattr(self, name), last))
        plain = [c for c in new if c != MARK]
        self.place.update(zip(plain, range(first, last)))
        if len(plain) < len(new):
            self.place[MARK] = last - 1
            ids = np.array([self.of_byte[b] for b in MARK.encode()], np.int32)
            only = np.arange(self.n)[None] == 0
            self._keep_choices(np.array([last - 1]), np.where(only, self.unknown * 3, -np.inf), only * len(ids), ids)
        for some, score, size, ids in self.search_all([c.replace(" ", MARK) for c in plain]):
            self._keep_choices(first + np.array(some, np.int64), score, size, ids)

    def _keep_choices(self, at: np.ndarray, score: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Keep what ``search_all`` found for the cuts at some places."""
        self.pool = _grown(self.pool, self.used + len(ids))
        self.pool[self.used: self.used + len(ids)] = ids
        self.start[at] = self.used + (np.cumsum(size) - size.ravel()).reshape(size.shape)
        self.size[at], self.score[at] = size, score
        self.loss[at] = score[:, 0] - score[:, 1] if self.n > 1 else np.inf
        self.used += len(ids)

    def _keep_words(self, new: list[str]) -> None:
        parts, size = self._cuts_of_words(new)
        unknown = list(dict.fromkeys(c for c in parts if c not in self.place))
        if unknown:
            self._keep_cuts(unknown)
        first, last = len(self.word), len(self.word) + len(new)
        flat = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
        self.word_start, self.word_size = _grown(self.word_start, last), _grown(self.word_size, last)
        self.word_cuts = _grown(self.word_cuts, self.word_used + len(flat))
        self.word_cuts[self.word_used: self.word_used + len(flat)] = flat
        self.word_size[first:last], self.word_start[first:last] = size, self.word_used + np.cumsum(size) - size
        self.word_used += len(flat)
        self.word.update(zip(new, range(first, last)))

    def cuts_of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cuts of all texts in a row, and where each text's begin (one more entry than texts)."""
        if len(self.place) > CACHE_CUTS or len(self.word) > CACHE_CUTS:
            self._clear()
        if self.spaced:
            # one space at a time parts words; texts with more in a row, at an edge, or with a MARK are rare
            odd = pc.match_substring_regex(texts, f"^ |  | $|^$|{MARK}").to_numpy(zero_copy_only=False)
        else:
            odd = np.ones(len(texts), bool)
        even = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        coded = pc.list_flatten(even).dictionary_encode()
        row = np.flatnonzero(~odd)[pc.list_parent_indices(even).to_numpy(zero_copy_only=False)]
        listed = [" " + w for w in coded.dictionary.to_numpy(zero_copy_only=False)]
        apart = [self.words(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        get = self.word.get
        new = [w for w in dict.fromkeys([*listed, *(w for a in apart for w in a)]) if get(w) is None]
        if new:
            self._keep_words(new)
        code = np.fromiter(map(get, listed), np.int64, len(listed))[coded.indices.to_numpy(zero_copy_only=False)]
        rows = np.concatenate([row, np.repeat(np.flatnonzero(odd), [len(a) for a in apart])]).astype(np.int64)
        code = np.concatenate([code, np.fromiter((get(w) for a in apart for w in a), np.int64)])
        order = np.argsort(rows, kind="stable")
        rows, code = rows[order], code[order]
        at = _gather(self.word_cuts, self.word_start[code], self.word_size[code])
        counts = np.bincount(rows, self.word_size[code], minlength=len(texts)).astype(np.int64)
        return at, np.concatenate([[0], np.cumsum(counts)])

    def ids_at(self, at: np.ndarray, ways: Sequence[dict[int, int]] = ({},)) -> list[np.ndarray]:
        """The ids of segmentations: the best choice of each cut but for the changed ones of each way."""
        size = self.size[at, 0]
        best, ends = _gather(self.pool, self.start[at, 0], size), np.cumsum(size)
        out = []
        for changed in ways:
            parts, done = [], 0
            for k in sorted(changed):
                start = self.start[at[k], changed[k]]
                parts += [best[done: ends[k] - size[k]], self.pool[start: start + self.size[at[k], changed[k]]]]
                done = ends[k]
            out.append(np.concatenate([*parts, best[done:]]) if parts else best)
        return out

    def scores(self, at: np.ndarray) -> tuple[list[float], list[dict[int, int]]]:
        """The scores of the N best segmentations of a text's cuts, and which cuts differ from their best choice.

        Only the N - 1 cuts whose second choice costs least can differ.
        """
        best, lost = float(self.score[at, 0].sum()), self.loss[at]
        few = np.argpartition(lost, self.n - 2)[: self.n - 1] if 0 < self.n - 1 < len(lost) else np.arange(len(lost))
        few = np.sort(few[np.isfinite(lost[few])]) if self.n > 1 else few[:0]
        options = [(s[0] - s[np.isfinite(s)]).tolist() for s in self.score[at[few]]]
        ways = _cheapest(options, self.n)
        return [best - loss for loss, _ in ways], [{int(k): c for k, c in zip(few, chosen) if c} for _, chosen in ways]

    def encode(self, text: str) -> tuple[np.ndarray, list[float], list[np.ndarray]]:
        """Best ids, the N best scores, and the ids of each of the N best segmentations of one text."""
        at, _ = self.cuts_of_all(pa.array([text], pa.string()))
        values, changed = self.scores(at)
        return self.ids_at(at)[0], values, self.ids_at(at, changed)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: bytes as they are, MARKs as spaces, without the space in front."""
        found = self.bytes_array.take(pa.array(ids, pa.int32()))
        raw = found.buffers()[2].to_pybytes()[: pc.sum(pc.binary_length(found)).as_py()] if len(found) else b""
        return raw[1:].decode("utf-8", "surrogatepass") if raw[:1] == b" " else raw.decode("utf-8", "surrogatepass")


def _grown(x: np.ndarray, need: int) -> np.ndarray:
    return x if need <= len(x) else np.concatenate([x, np.zeros((max(need - len(x), len(x)), *x.shape[1:]), x.dtype)])


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``start`` to ``start + size`` of the pool, one after the other."""
    ends = np.cumsum(size)
    return pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _hash_text(text: str) -> int:
    code = 0
    for c in text:
        code = (code * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return code


def _cheapest(options: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n cheapest ways to take one option of each list (each sorted, first 0): cost and choice."""
    start = (0,) * len(options)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        cost, chosen = heapq.heappop(heap)
        out.append((cost, chosen))
        for k, c in enumerate(chosen):
            if c + 1 < len(options[k]):
                step = chosen[:k] + (c + 1,) + chosen[k + 1:]
                if step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (cost - options[k][c] + options[k][c + 1], step))
    return out


@lru_cache(maxsize=1)
def model_of(path: str, n: int) -> PieceModel:
    """One model per Python worker; its cuts live on between tasks."""
    return PieceModel(path, n)


SUMMARY = [
    StructField("n_pieces", IntegerType()), StructField("ids_crc32", LongType()),
    StructField("nbest_scores", ArrayType(DoubleType())), StructField("round_trip", BooleanType()),
]
IDS = StructField("nbest_ids", ArrayType(ArrayType(IntegerType())))


def encode_slice(codec: PieceModel, texts: pa.Array, with_ids: bool) -> list[pa.Array]:
    """The columns of ``encode_texts`` for some texts."""
    at, starts = codec.cuts_of_all(texts)
    size, crc, scores, same, ids = [], [], [], [], []
    for text, lo, hi in zip(texts.to_pylist(), starts, starts[1:]):
        own = at[lo:hi]
        values, changed = codec.scores(own)
        ways = codec.ids_at(own, changed)
        size.append(len(ways[0]))
        crc.append(zlib.crc32(ways[0].astype("<u4").tobytes()))
        scores.append(values)
        same.append(all(codec.decode(way) == text for way in ways))
        if with_ids:
            ids.append(ways)
    out = [
        pa.array(size, pa.int32()), pa.array(crc, pa.int64()), pa.array(scores, pa.list_(pa.float64())),
        pa.array(same, pa.bool_())]
    return [*out, _nested(ids)] if with_ids else out


def _nested(rows: list[list[np.ndarray]]) -> pa.Array:
    """Lists of lists of ids."""
    flat = [way for ways in rows for way in ways]
    ends, row_ends = np.cumsum([0, *map(len, flat)]), np.cumsum([0, *map(len, rows)])
    inner = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0), pa.int32()))
    return pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), inner)


def encode_texts(
    docs: DataFrame, model: str, text: str = "text", n: int = N_BEST, keep: Sequence[str] | None = None, with_ids: bool = True
) -> DataFrame:
    """Every row with its best segmentation's size and checksum, the N best scores and (``with_ids``) their ids.

    round_trip says that decoding the whole text's ids gives the text back, for each of the N best. Scores fall from first
    to last; a text with fewer segmentations has fewer. A NULL text counts as empty: the model's space in front is all that
    it holds. Rows depend on nothing but their text; equal texts have equal results. Columns of
    these names in the input are replaced.
    """
    def make():
        codec = model_of(model, n)
        return lambda texts: encode_slice(codec, texts, with_ids)

    return map_text(docs, text, [*SUMMARY, *([IDS] if with_ids else [])], make, keep)


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """Every row with the text of its ids (array of int; NULL ids: NULL). A column of that name is replaced."""
    kept = [c for c in rows.columns if c.lower() != name.lower()]
    source = rows.select(*[f"`{c}`" for c in kept], *([] if ids in kept else [f"`{ids}`"]))
    schema = StructType([*(rows.schema[c] for c in kept), StructField(name, StringType())])

    def run(batches):
        codec = model_of(model, N_BEST)
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, name])

    return map_batches(source, run, schema)
